"""The join of index blocks and query groups: nothing of it goes to the driver, only queries are replicated."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from skillgrid.llm import bit_sliced


def _brute(rows: list[tuple], k: int) -> list[tuple]:
    ints = {i: [math.floor(1024 * Fraction(x)) for x in v] for i, v in rows}
    out = []
    for q in (i for i in ints if i % 100 == 0):
        found = sorted((-sum(a * b for a, b in zip(ints[q], w, strict=True)), i) for i, w in ints.items() if i != q)
        out += [(q, r + 1, i, -s if abs(s) < 1 << 63 else None) for r, (s, i) in enumerate(found[:k])]
    return sorted(out, key=lambda r: r[:2])


@pytest.mark.parametrize("scale", [1.0, 90.0, 1e5, 1e9])
def test_neither_blocks_nor_queries_are_broadcast(spark, scale):
    # The scales take 2 and 4 bytes a component, and Python integers beside them.
    rng = random.Random(17)
    rows = [(i, [rng.uniform(-1, 1) * (scale if i % 2 else 1) for _ in range(4)]) for i in range(700)]
    rows += [(701 + i, [scale, -scale, 0.0, 0.5]) for i in range(30)] + [(800, [-scale, 1.0, 1.0, scale])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = bit_sliced.top_k(df, df.where("vec_id % 100 = 0"), 10, 60, 3)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == _brute(rows, 10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    joins = plan.count("SortMergeJoin")
    assert plan.count("Generate explode") == joins  # one side of each


def test_narrow_integers_come_back():
    for low, high in ((-(1 << 15), (1 << 15) - 1), (-(1 << 15) - 1, 0), (0, 1 << 15), (-(1 << 31), (1 << 31) - 1), (0, 1 << 31), (-(1 << 62), 1)):
        v = np.array([[low, 0, high], [1, -1, low]], np.int64)
        packed = bit_sliced._narrow(v)
        assert (bit_sliced._wide(packed, 2, 3) == v).all()
    assert len(bit_sliced._narrow(np.full((5, 4), 32767, np.int64))) == 40


def test_index_is_read_a_few_blocks_at_a_time(spark):
    vectors = spark.createDataFrame([(i, 2, [i, -i]) for i in range(400)], "vec_id long, dim int, v array<long>")
    index = bit_sliced.index(vectors.coalesce(1), 100)
    groups = [m.row_group(g).num_rows for f in index.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for g in range(m.num_row_groups)]
    assert sum(groups) == index.count() > 50 and max(groups) <= 4
