"""Regexes that run only near an alias's key: the rows of searches in whole texts."""

from __future__ import annotations

import datetime as dt

import pytest

from skillgrid.functions.regex import match_reach, to_java
from skillgrid.functions.taxonomy import taxonomy_frame
from skillgrid.operators import anchor_join, extract
from skillgrid.session import materialize

ADS = "id string, publication_month timestamp_ntz, headline string, description_text string"


def test_match_reach_is_a_bound_or_unknown():
    assert match_reach(r"\bpython\b") >= 6 and match_reach(r"c\+\+") >= 3 and match_reach(r"[ab]\s?x") >= 3
    for open_end in ("ab*", "a+b", "(ab)c", "a{2}b", "^ab", "ab$", "ab|c", r"ab\Z", r"\1ab"):
        assert match_reach(open_end) is None


def test_boundary_before_a_literal_is_the_general_boundary(spark):
    patterns = [r"\bab\b", r"\bk8\b", r"\bsq?l\b", r"\ba?b\b", r"\b\.net\b", r"\b1x\b", r"\bé\b"]
    texts = ["ab", "xab ab", "éab", "_ab", "K8", "xK8", "ſql", "aſql", "b", "ab.net", ".net", "1x 21x", "é", "aé", "", "İab", "😀ab"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for dialect, word in (("re2", r"\w"), ("python", r"[\p{L}\p{N}_]")):
        plain = f"(?:(?<={word})(?!{word})|(?<!{word})(?={word}))"
        for p in patterns:
            # A group hides the character behind the boundary.
            general = to_java(p.replace(r"\b", r"\b(?:)"), dialect)
            assert plain in general
            assert [r[0] for r in df.select(df.t.rlike(to_java(p, dialect))).collect()] == [r[0] for r in df.select(df.t.rlike(general)).collect()]


@pytest.mark.parametrize("dialect", ["re2", "python"])
def test_regexes_near_their_keys_give_the_unrolled_rows(spark, dialect):
    taxonomy = {
        "word": [r"\bgolang\b", r"\bxgolang\b"], "net": [r"\basp\.net\b", r"\.net"], "opt": [r"node\.?js", r"\bpower ?bi\b"],
        "open": [r"data.*base", r"(re)?act\b"], "any": [r"b.g.data"], "short": [r"\bq\b"], "umlaut": ["åäö"],
    }
    filler = "lorem ipsum golangx dolor 🙂 sit amet é " * 400
    heads = ["golang", "xgolang golang", "İ golang", "golangx", "ASP.NET", "nodejs node.js", "data and\nbase database", "Power BI", "BIG-DATA b gbdata", "q", "ÅÄÖ", "reacting act"]
    rows = []
    for i, h in enumerate(heads):
        rows += [(f"{i}a", h, None), (f"{i}b", None, filler + h), (f"{i}c", h, filler), (f"{i}d", "İ" + filler, h + " " + filler + h), (f"{i}e", "x" + h + "_", h + "é")]
    full = [(a, dt.datetime(2024, 1 + k % 12, 1), b, c) for k, (a, b, c) in enumerate(rows)]
    ads = materialize(spark.createDataFrame(full, ADS), "near-ads")
    want = sorted(map(tuple, extract.regex_skill_matches(ads, taxonomy, dialect).collect()))
    found = anchor_join.regex_skill_matches(ads, taxonomy_frame(spark, taxonomy, dialect=dialect), dialect)
    assert sorted(map(tuple, found.collect())) == want and len({r[2] for r in want}) == 7
    assert "regexp_extract(if" in found._jdf.queryExecution().optimizedPlan().toString().lower()
