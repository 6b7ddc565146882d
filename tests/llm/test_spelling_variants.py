"""Spelling variants against a brute-force version of the contract."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from skillgrid.llm import spelling_variants as sv
from skillgrid.llm.common import materialize

from .helpers import DOCS, awkward_docs, with_clashes

LOWER = str.maketrans(sv.UPPER, sv.UPPER.lower())


def brute_counts(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def brute(counts):
    """Words are near if one with a place left out is the other, or both with the same place left out are alike."""
    near, holes = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            shorter = w[:k] + w[k + 1 :]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
            holes[w[:k], w[k + 1 :]].add(w)
    for alike in holes.values():
        for w in alike:
            near[w] |= alike - {w}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 5 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéÀß×") for _ in range(rng.randint(6, 12))) for _ in range(25)] + ["Zebras" * 3, "aaaaaaa", "abababab"]
    pool = []
    for s in stems:
        weight = rng.choice([1, 4, 20])
        pool += [s] * weight * 5
        for _ in range(rng.randint(1, 6)):
            k, c = rng.randrange(len(s)), rng.choice("abcdeéÀß×z")
            v = rng.choice([s[:k] + s[k + 1 :], s[:k] + c + s[k:], s[:k] + c + s[k + 1 :], s.upper()])
            pool += [v] * rng.choice([1, 5, 6, weight])
    rng.shuffle(pool)
    rows = [(i, rng.choice([" ", ", ", "1", "Ā", "\n"]).join(pool[i * 9 : i * 9 + 9]), "en", "a", 1) for i in range(len(pool) // 9 + 1)]
    # Counts that fall by five and more give chains of forms.
    chain = ["chainword"] * 700 + ["chainwordx"] * 120 + ["chainwordxy"] * 20 + ["chaynwordxy"] * 6
    return rows + [(10_000 + i, " ".join(chain[i * 20 : i * 20 + 20]), None, None, None) for i in range(len(chain) // 20 + 1)]


@pytest.mark.parametrize(("seed", "filter_bytes"), [(1, sv.FILTER_BYTES), (2, 32)])
def test_variants_equal_brute_force(spark, seed, filter_bytes):
    rows = corpus(seed)
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    vocab = materialize(sv.vocabulary(sv.words_of(docs)), "test-vocabulary")
    got = sv.with_roots(sv.forms(vocab, filter_bytes)).select("word", "form", "root", "n", "n_near", "form_n")
    want = brute(brute_counts(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert any(w[2] not in (w[0], w[1]) for w in want) and any(w[4] > 2 for w in want)


def test_query_on_awkward_documents(spark):
    rng = random.Random(4)
    rows = awkward_docs(rng) * 3 + [(900 + i, "wörter Wörter " + "x" * 3000 + " " + "x" * 2999 + "y", "de", "a", 1) for i in range(6)]
    rows += [(None, None, None, None, None), (None, "nothing_else nothingelse " * 5, None, None, None)]
    got = sv.spelling_variants(with_clashes(spark.createDataFrame(rows, DOCS)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert [t for _, t in got.dtypes] == ["string"] * 3 + ["bigint"] * 3
    assert sorted(map(tuple, got.collect()), key=repr) == brute(brute_counts(rows))


def test_given_documents_and_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(brute_counts(rows))
    assert sorted(map(tuple, sv.spelling_variants(docs).collect()), key=repr) == want and len(want) > 100
    assert sv.spelling_variants(docs.limit(0)).collect() == []


def test_neighbours_are_all_deletions_and_larger_replacements():
    words = ["abcabc", "aabbcc", "zzzzzz", "q" * 70]
    filters = sv.BloomFilters({k: 1 for k in range(1, 66)}).fill(np.arange(65), np.full((65, sv.LANES), 0xFFFFFFFF, np.uint32))
    letters = {k: np.array([ord(c) for c in "abcz"], np.uint64) for k in range(1, 66)}
    got = defaultdict(list)
    for number, place, point in sv.neighbours(words, filters, letters):
        for i, k, c in zip(number.tolist(), place.tolist(), point.tolist(), strict=True):
            got[words[i]].append(words[i][:k] + (chr(c) if c else "") + words[i][k + 1 :])
    for w in words:
        want = {w[:k] + w[k + 1 :] for k in range(len(w))} | {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in "abcz" if c > w[k]}
        assert sorted(got[w]) == sorted(want)
