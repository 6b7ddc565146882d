"""The regex join over a taxonomy relation: the unrolled form's rows, awkward aliases, no nested loops."""

from __future__ import annotations

import random

import numpy as np
import pytest

from skillgrid.functions.taxonomy import taxonomy_frame
from skillgrid.operators import anchor_join, extract
from skillgrid.session import materialize

ADS = "id string, publication_month timestamp_ntz, headline string, description_text string"


def _ads(spark, rows, name="anchor-ads"):
    import datetime as dt

    full = [(r[0], dt.datetime(2024, 1 + i % 12, 1), r[1], r[2]) for i, r in enumerate(rows)]
    return materialize(spark.createDataFrame(full, ADS), name)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


TEXTS = [
    ("1", "Senior Python developer", "C# and C++, T-SQL; R, Go"), ("1", "python", None), ("2", None, None), ("3", "", ""),
    (None, "MASKININLÄRNING", "java script ſql Kubernetes"), ("4", "Node.js", "Power BI " * 3000 + " aws"), ("5", "årust rust", "x" * 100),
    ("6", "pyth", "on"), ("7", "scala", "c"), ("8", ".net", "🙂 docker"), ("9", "k8s", "\x00 git"),
]


@pytest.mark.parametrize("dialect", ["re2", "python"])
def test_fixed_taxonomy_gives_the_unrolled_rows(spark, dialect):
    rng = random.Random(1)
    words = "python java c# c++ sql r go node.js power bi azure docker ML ai excel git linux react scala spark".split()
    rows = TEXTS + [(str(rng.randrange(80)), " ".join(rng.choices(words, k=3)), " ".join(rng.choices(words + ["the", "and", "xpython", "sqlx"], k=20))) for _ in range(150)]
    ads = _ads(spark, rows)
    want = _rows(extract.regex_skill_matches(ads, dialect=dialect))
    assert _rows(anchor_join.regex_skill_matches(ads, taxonomy_frame(spark, dialect=dialect), dialect)) == want and len(want) > 300


def test_aliases_without_anchor_short_doubled_and_null(spark):
    taxonomy = {"a": [r"\ba\b|\bb\b", "x*"], "c": ["c"], "long": [r"a very long alias of more than twelve bytes\b"], "é": ["é", "ÅÄ"], "twin": [r"\bq[0-9]+\b", "q[0-9]"]}
    rows = [("1", "a", "zz"), ("2", "zz", "xx b"), ("3", "C", None), ("4", "É", "åä Q77"), ("5", "A very LONG alias of more than twelve bytes", "no"), ("6", None, "zz q5x")]
    ads = _ads(spark, rows, "anchor-bare")
    relation = taxonomy_frame(spark, taxonomy)
    extra = spark.createDataFrame([("n", None, "zz"), (None, 0, "zz"), ("n", 1, None)], "skill string, pattern_order int, pattern string")
    got = _rows(anchor_join.regex_skill_matches(ads, relation.unionByName(extra)))
    assert got == _rows(extract.regex_skill_matches(ads, taxonomy))
    assert {r[2] for r in got} == {"a", "c", "long", "é", "twin"}
    assert anchor_join.regex_skill_matches(ads, relation.limit(0)).collect() == []
    assert anchor_join.regex_skill_matches(_ads(spark, rows, "anchor-none").limit(0), relation).collect() == []


def test_grams_of_texts_equal_plain_search(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcé ") for _ in range(rng.randint(0, 90))) for _ in range(40)] + ["ab" * 400]
    wanted = {w: {"".join(rng.choice("abc") for _ in range(w)).encode() for _ in range(3)} for w in anchor_join.WIDTHS}
    hash_of = {anchor_join.gram_hashes(np.frombuffer(g, np.uint8).astype(np.uint64), len(g))[0]: g for gs in wanted.values() for g in gs}
    table = np.zeros(anchor_join.BITS // 64, np.uint64)
    for h in hash_of:
        bit = int(h) >> (64 - 25)
        table[bit >> 6] |= np.uint64(1) << np.uint64(bit & 63)
    for piece in (1 << 20, 64):
        monkeypatch.setattr(anchor_join, "PIECE", piece)
        got = {(int(i), hash_of[g]) for numbers, grams in anchor_join.text_grams(texts, table, list(anchor_join.WIDTHS)) for i, g in zip(numbers, grams, strict=True) if g in hash_of}
        want = {(i, g) for i, t in enumerate(texts) for g in hash_of.values() if g in t.encode()}
        assert want <= got  # a gram over a text's end may add some


def test_plan_has_no_nested_loop_and_prunes_columns(spark):
    ads = _ads(spark, TEXTS, "anchor-plan")
    plan = anchor_join.found_matches(ads, taxonomy_frame(spark))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_word_taxonomy_matches_whole_words(spark):
    docs = spark.createDataFrame([(1, "Abcdefgh ijklmnop"), (2, "abcdefgh qrstuvwx"), (3, "qrstuvwx abcdefghz"), (4, None)], "d long, t string")
    got = sorted(map(tuple, anchor_join.word_taxonomy(docs, "d", "t").collect()))
    assert got == [("words_ab", 0, r"\babcdefgh\b"), ("words_qr", 0, r"\bqrstuvwx\b")]
