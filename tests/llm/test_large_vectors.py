"""The bit-sliced search over components whose products fit no long."""

from __future__ import annotations

import math
import random
from fractions import Fraction

from skillgrid.llm import bit_sliced


def test_large_components_ask_and_are_found(spark):
    rng = random.Random(11)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(300)]
    rows += [(300 + i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([6, 7, 12, 100, 307]) for _ in range(4)]) for i in range(120)]
    rows += [(600, [float(1 << 20), 0.0, 0.0, 0.0]), (601, [float(1 << 20), 0.0, 0.0, 0.0])]
    ints = {i: [math.floor(1024 * Fraction(x)) for x in v] for i, v in rows}
    want = []
    for q in (i for i in ints if i % 100 == 0):
        found = sorted((-sum(a * b for a, b in zip(ints[q], w, strict=True)), i) for i, w in ints.items() if i != q)
        want += [(q, r + 1, i, -s if abs(s) < 1 << 63 else None) for r, (s, i) in enumerate(found[:10])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = bit_sliced.top_k(df, df.where("vec_id % 100 = 0"), 10, 50, 2)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])
