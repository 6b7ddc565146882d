"""Regex dialect translation: Spark (Java) must find what RE2 / Python ``re`` find."""

from __future__ import annotations

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from skillgrid.functions.regex import literal_anchor, to_java
from skillgrid.functions.taxonomy import RE2_PATTERN_OVERRIDES, TECH_SKILLS, pattern_rows
from skillgrid.operators import extract


def _surface(pattern: str) -> str:
    """A plain text the alias should match (one concrete reading of it)."""
    p = pattern
    for head in (r"\b", r"(?<!\w)"):
        p = p.removeprefix(head)
    for tail in (r"\b", r"(?!\w)"):
        p = p.removesuffix(tail)
    p = p.replace(r"[-\s]?", "-").replace(r"[\-\s]?", " ").replace(r"\s?", " ")
    p = p.replace(r"\.?", ".").replace(r"\.", ".").replace(r"\+", "+")
    return p


def _texts() -> list[str]:
    """Positives, near misses and adversarial neighbours for every alias."""
    texts = []
    for _skill, patterns in TECH_SKILLS.items():
        for pattern in patterns:
            word = _surface(pattern)
            texts += [
                f"We use {word} daily",
                f"{word.upper()}!",
                f"x{word}y",
                f"å{word}",
                f"{word}ö rest",
                f"({word})",
                f"{word}_x",
                f"über {word} ",
                f"{word}\n",
                f"{word[:-1]}",
            ]
    rng = random.Random(7)
    pieces = ["python", "Spark", "C#", "c++", ".NET", "asp.net", "node.js", "NodeJS", "T-SQL",
              "Power BI", "powerbi", "MASKININLÄRNING", "dataingenjör", "ſpark", "K8s",
              "java script", "Azure Data Factory", "r-programmering", "scikit learn", "ai models",
              " ", "\x0b", "\t", "_", "å", "ö", ",", " ", "İ", "ı", "x", "9"]
    for _ in range(400):
        texts.append("".join(rng.choice(pieces) + rng.choice(["", " ", ""]) for _ in range(rng.randint(1, 6))))
    return texts


@pytest.fixture(scope="module")
def texts_df(spark):
    rows = [(i, t) for i, t in enumerate(_texts())]
    return spark.createDataFrame(rows, "i long, t string").repartition(8), rows


def _spark_hits(texts_df, dialect: str) -> set[tuple[int, str, int]]:
    df, _ = texts_df
    exprs = [
        F.when(F.col("t").rlike(to_java(p, dialect)), F.lit(f"{s}|{o}")) for s, o, p in pattern_rows(dialect=dialect)
    ]
    out = df.select("i", F.explode(F.array_compact(F.array(*exprs))).alias("h")).collect()
    return {(r.i, r.h.split("|")[0], int(r.h.split("|")[1])) for r in out}


def test_re2_dialect_matches_duckdb(texts_df):
    _, rows = texts_df
    con = duckdb.connect()
    con.execute("create table t as select * from (values " + ",".join(
        "(" + str(i) + ", " + "'" + t.replace("'", "''") + "')" for i, t in rows) + ") v(i, t)")
    expected = set()
    for s, o, p in pattern_rows(dialect="re2"):
        for (i,) in con.execute("select i from t where regexp_matches(t, ?, 'i')", [p]).fetchall():
            expected.add((i, s, o))
    assert _spark_hits(texts_df, "re2") == expected


def test_python_dialect_matches_python_re(texts_df):
    _, rows = texts_df
    expected = {
        (i, s, o)
        for i, t in rows
        for s, o, p in pattern_rows(dialect="python")
        if re.search(p, t, flags=re.IGNORECASE)
    }
    assert _spark_hits(texts_df, "python") == expected


def test_anchor_is_contained_in_every_match():
    for _s, _o, p in pattern_rows(dialect="re2") + pattern_rows(dialect="python"):
        anchor = literal_anchor(p)
        assert anchor, p
        word = _surface(p)
        assert anchor in word.lower(), (p, anchor, word)


@pytest.mark.parametrize(
    "pattern,anchor",
    [
        (r"\bnode\.?js\b", "node"),
        (r"\bpower\s?bi\b", "power"),
        (r"\bscikit[\-\s]?learn\b", "scikit"),
        (r"(^|[^[:alnum:]_])c#([^[:alnum:]_]|$)", "c#"),
        (r"\bpl/sql\b", "pl/sql"),
        (r"a|b", None),
        (r"ab+c", "ab"),
    ],
)
def test_literal_anchor(pattern, anchor):
    assert literal_anchor(pattern) == anchor


def test_overrides_only_touch_lookaround_aliases():
    all_patterns = {p for ps in TECH_SKILLS.values() for p in ps}
    assert set(RE2_PATTERN_OVERRIDES) <= all_patterns
    assert all("(?<!" in p for p in RE2_PATTERN_OVERRIDES)


def test_prefilter_changes_nothing(spark, texts_df):
    df, _ = texts_df
    ads = df.select(
        F.col("i").cast("string").alias("id"),
        F.lit(None).cast("timestamp_ntz").alias("publication_month"),
        F.col("t").alias("headline"),
        F.lit(None).cast("string").alias("description_text"),
    )
    a = extract.regex_skill_matches(ads, prefilter=True).collect()
    b = extract.regex_skill_matches(ads, prefilter=False).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert len(a) > 500


def test_full_matches_equal_duckdb_on_adversarial_texts(spark, texts_df):
    """Whole D1 rows (match text with trim, snippet) against the SQL formulation."""
    from skillgrid.plans.oracle import PATTERNS_CTE

    _, rows = texts_df
    extra = ["a C# b", "x Python　", "  SQL  ", "C#\x0b", "Go programming  "]
    rows = rows + [(len(rows) + i, t) for i, t in enumerate(extra)]
    ads_rows = [(str(i), t, f"desc {t} \t\n {t}") for i, t in rows]
    ads = spark.createDataFrame(ads_rows, "id string, headline string, description_text string").select(
        "id", F.lit(None).cast("timestamp_ntz").alias("publication_month"), "headline", "description_text"
    )
    got = {
        (r.id, r.skill): (r.matched_text, r.description_snippet)
        for r in extract.regex_skill_matches(ads).collect()
    }
    con = duckdb.connect()
    con.execute("create table ads(id varchar, headline varchar, description_text varchar)")
    con.executemany("insert into ads values (?, ?, ?)", ads_rows)
    sql = f"""with {PATTERNS_CTE}
    select id, skill, matched_text, description_snippet from (
      select a.id, p.skill,
        trim(regexp_extract(a.s, p.pattern, 0, 'i')) as matched_text,
        left(regexp_replace(coalesce(a.description_text, ''), '\\s+', ' ', 'g'), 400) as description_snippet,
        row_number() over (partition by a.id, p.skill order by p.pattern_order) as rk
      from (select *, coalesce(headline, '') || ' ' || coalesce(description_text, '') as s from ads) a
      join patterns p on regexp_matches(a.s, p.pattern, 'i')
    ) where rk = 1"""
    want = {(i, s): (m, d) for i, s, m, d in con.execute(sql).fetchall()}
    assert got == want
    assert len(want) > 1000
