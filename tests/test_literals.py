"""Literals found in one pass over a text: the bits of plain searches."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest

from skillgrid.functions import literals
from skillgrid.operators import extract

ADS = "id string, publication_month timestamp_ntz, headline string, description_text string"


@pytest.mark.parametrize("piece", [1 << 21, 16])
def test_literal_bits_equal_plain_search(monkeypatch, piece):
    monkeypatch.setattr(literals, "PIECE", piece)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcé ") for _ in range(rng.randint(0, 60))).encode() for _ in range(200)] + [b"", b"ab\xff\xfecab", b"abc" * 500, b""]
    wanted = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(3, 7))) for _ in range(70)})
    bits = {w.encode(): [1 << k % 64 if k // 64 == n else 0 for n in range(2)] for k, w in enumerate(wanted)}
    got = literals.LiteralSet(bits).search(texts, 2)
    want = [[sum(b[n] for w, b in bits.items() if w in t) for n in range(2)] for t in texts]
    assert np.array_equal(got, np.array(want, np.uint64)) and got.any()


def test_alias_bits_do_not_search_anchor_by_anchor(spark):
    ads = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), "python", None)], ADS)
    plan = extract.with_alias_bits(ads)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("contains(") < 20
