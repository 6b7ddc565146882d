"""Periodic runs against a quadratic search, and the query against the contract in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from skillgrid.llm import periodic_runs

from .helpers import DOCS, awkward_docs, prose, with_clashes


def brute_lyndon(s):
    out = []
    for i in range(len(s)):
        lengths = [k for k in range(1, len(s) - i + 1) if all(s[i : i + k] < s[j : i + k] for j in range(i + 1, i + k))]
        out.append(max(lengths))
    return out


def brute_runs(s):
    """Every maximal stretch of smallest period q and at least max(6, 4q) words, each q on its own."""
    out = set()
    codes = np.unique(np.array(s, dtype=object), return_inverse=True)[1] if len(s) else np.zeros(0, int)
    for q in range(1, len(s) // 4 + 1):
        same = np.concatenate(([0], codes[q:] == codes[:-q], [0])).astype(int)
        edge = np.diff(same)
        for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if j - i + q < max(6, 4 * q):
                continue
            w = list(s[i : i + q])
            if not any(q % d == 0 and w == w[:d] * (q // d) for d in range(1, q)):
                out.add((i, j - i + q, q))
    return sorted(out)


def contract_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


sequences = st.one_of(
    st.lists(st.integers(0, 3), min_size=1, max_size=40),
    st.builds(lambda a, b, k, c: a + b * k + c, st.lists(st.integers(0, 2), max_size=8), st.lists(st.integers(0, 2), min_size=1, max_size=7),
              st.integers(3, 9), st.lists(st.integers(0, 2), max_size=8)),
    st.builds(lambda a, b, j, k: (a * j + b) * k, st.lists(st.integers(0, 1), min_size=1, max_size=3), st.lists(st.integers(0, 1), max_size=3), st.integers(1, 6), st.integers(1, 6)),
)


@settings(max_examples=150, deadline=None)
@given(sequences)
def test_groups_are_the_longest_lyndon_prefixes(s):
    lyndon, group = periodic_runs.lyndon_groups(s)
    assert lyndon == brute_lyndon(s)
    prefixes = [tuple(s[i : i + k]) for i, k in enumerate(lyndon)]
    assert len(set(zip(group, prefixes, strict=True))) == len(set(group)) == len(set(prefixes))


@settings(max_examples=200, deadline=None)
@given(sequences)
def test_runs_equal_quadratic_search(s):
    assert periodic_runs.runs_of(np.array(s)) == brute_runs(s)


def test_long_periods_and_many_parts():
    rng = random.Random(3)
    cycle = [rng.randrange(40) for _ in range(150)]
    s = [rng.randrange(400) for _ in range(600)] + cycle * 5 + cycle[:23] + [rng.randrange(400) for _ in range(600)] + [7, 8] * 9 + [7]
    assert periodic_runs.runs_of(np.array(s)) == brute_runs(s)
    assert periodic_runs.runs_of(np.zeros(50_000, int)) == [(0, 50_000, 1)]


def test_rows_equal_the_contract(spark):
    rng = random.Random(8)
    rows = awkward_docs(rng)
    rows += [(1000 + i, prose(rng, rng.randint(1, 60)), "en", "a", 1) for i in range(150)]
    rows += [
        (2000, "a " * 5, "en", "a", 1), (2001, "a " * 6, "en", "a", 1), (2002, "a b " * 4, "en", "a", 1), (2003, "a b " * 3 + "a", "en", "a", 1),
        (2004, "x y z " * 4 + "x y z w " * 4, None, None, 1), (2005, "a b\t \x0bq\x0c" * 9, "en", "a", 1), (2006, "a a a b " * 8, "en", "a", 1),
        (2007, ("a b " * 4 + "c d " * 4) * 5, "en", "a", 1), (None, "t u " * 10, "en", "a", 1), (None, None, "en", "a", 1), (2001, "a " * 6, "en", "a", 1),
    ]
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 10
    got = periodic_runs.hidden_runs(with_clashes(spark.createDataFrame(rows, DOCS)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    want = [contract_row(r[0], r[1]) for r in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert any(w[1] > 1 for w in want) and any(w[1] == 0 for w in want)


def test_empty_table(spark):
    assert periodic_runs.hidden_runs(spark.createDataFrame([], DOCS)).collect() == []
