"""Extraction semantics: alias order, overlaps, match text, snippet, dedupe, labels."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from skillgrid.functions.taxonomy import TECH_SKILLS
from skillgrid.operators import extract
from skillgrid.session import materialize

M1 = dt.datetime(2024, 1, 1)
M2 = dt.datetime(2024, 2, 1)
ADS_SCHEMA = "id string, publication_month timestamp_ntz, headline string, description_text string"


def _ads(spark, rows):
    return spark.createDataFrame(rows, ADS_SCHEMA)


def _matches(spark, rows, **kw):
    out = extract.regex_skill_matches(_ads(spark, rows), **kw).collect()
    return {(r.id, r.skill): r for r in out}


def test_first_alias_wins_and_overlaps(spark):
    m = _matches(
        spark,
        [
            ("1", M1, "Apache Spark engineer", None),
            ("2", M1, "Azure Data Factory", None),
            ("3", M1, "java script", None),
            ("4", M1, "T-SQL", None),
            ("5", M1, "asp.net", None),
        ],
    )
    assert m[("1", "spark")].matched_text == "Spark"
    assert {k for k in m if k[0] == "2"} == {("2", "azure"), ("2", "azure_data_factory")}
    assert {k for k in m if k[0] == "3"} == {("3", "java"), ("3", "javascript")}
    assert m[("4", "sql")].matched_text == "SQL"
    assert m[("5", "dotnet")].matched_text == "asp.net"


def test_lookaround_overrides_consume_neighbour(spark):
    m = _matches(spark, [("1", M1, "x C#, y", None), ("2", M1, "C++", None)])
    assert m[("1", "csharp")].matched_text == "C#,"
    assert m[("2", "cpp")].matched_text == "C++"


def test_match_trim_strips_space_separators_only(spark):
    m = _matches(spark, [("1", M1, "a C# b", None), ("2", M1, "C#\t", None)])
    assert m[("1", "csharp")].matched_text == "C#"
    assert m[("2", "csharp")].matched_text == "C#\t"


def test_search_text_and_snippet(spark):
    long_desc = "Python  \n\t developer " + "x" * 600
    m = _matches(
        spark,
        [
            ("1", M1, None, long_desc),
            ("2", M1, "Rust", None),
            ("3", M1, "py", "thon"),  # the space between parts prevents a match
        ],
    )
    snippet = m[("1", "python")].description_snippet
    assert snippet.startswith("Python developer xx") and len(snippet) == 400
    assert m[("1", "python")].headline is None
    assert m[("2", "rust")].description_snippet == ""
    assert not any(k[0] == "3" for k in m)


def test_duplicate_ids_keep_one_row_per_skill(spark):
    rows = [
        ("7", M2, "Python", None),
        ("7", M1, "python and sql", None),
        ("7", M1, "Python", "sql"),
    ]
    m = _matches(spark, rows)
    assert set(m) == {("7", "python"), ("7", "sql")}
    # lowest pattern_order, then earliest month, then headline
    assert m[("7", "python")].publication_month == M1
    assert m[("7", "python")].headline == "Python"
    raw = extract.regex_skill_matches(_ads(spark, rows), dedupe_ids=False).count()
    assert raw == 5


def test_hot_id_dedupes_without_collecting(spark):
    # one id holding most rows: the min(struct) aggregate collapses it map-side
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit(M1).cast("timestamp_ntz").alias("publication_month"),
        F.lit("Python and Docker").alias("headline"),
        F.lit(None).cast("string").alias("description_text"),
    )
    out = extract.regex_skill_matches(df)
    assert out.where(F.col("id") == "hot").count() == 2
    assert out.count() == 2 * (20000 - 6667 + 1)


def test_regex_skills_shape(spark):
    m = extract.regex_skill_matches(_ads(spark, [("1", M1, "Python", None)]))
    rs = extract.regex_skills(m).collect()
    assert [tuple(r) for r in rs] == [("1", M1, "python", "regex")]


def test_ams_skills_union_all_semantics(spark):
    schema = (
        "id string, publication_month timestamp_ntz, "
        "must_have_skills array<struct<label:string>>, nice_to_have_skills array<struct<label:string>>"
    )
    ads = spark.createDataFrame(
        [
            ("1", M1, [{"label": "SQL"}, {"label": None}], None),
            ("2", M1, None, [{"label": "Java"}]),
            ("3", M1, [{"label": "Go"}], [{"label": "Go"}]),
            ("4", M1, [], []),
        ],
        schema,
    )
    rows = sorted((r.id, r.skill, r.skill_source) for r in extract.ams_skills(ads).collect())
    assert rows == [("1", "SQL", "ams"), ("2", "Java", "ams"), ("3", "Go", "ams"), ("3", "Go", "ams")]


def _python_reference(text):
    """Per-text extraction by brute force with Python re (the D3 contract)."""
    if not text:
        return []
    found = []
    for skill, patterns in TECH_SKILLS.items():
        for pattern in patterns:
            m = re.search(pattern, text, flags=re.IGNORECASE)
            if m:
                found.append((skill, m.group(0)))
                break
    return sorted(found)


def test_per_text_extraction_matches_python_re(spark):
    texts = [
        None,
        "",
        "Senior Python developer med C#, .NET och Power BI",
        "årust ärust rust",
        "MASKININLÄRNING & språkbehandling",
        "node.js NodeJS node js",
        "Apache Spark, PySpark, Databricks",
        "scikit-learn sklearn py torch",
        "C++/C# (asp.net)",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", extract.skill_matches_column("t").alias("m")).collect()
    for r in got:
        assert [(x.skill, x.matched_text) for x in r.m] == _python_reference(texts[r.i]), texts[r.i]


def test_job_skill_lists_and_job_skills(spark):
    ads = spark.createDataFrame(
        [("1", M1, "Python", "and rust"), ("2", M1, None, None), ("3", M1, "årust", None)],
        "id string, publication_date timestamp_ntz, headline string, description__text string",
    )
    lists = {r.id: r.skills for r in extract.job_skill_lists(ads).collect()}
    assert lists == {"1": ["python", "rust"], "2": [], "3": []}
    skills = sorted((r.id, r.skill) for r in extract.job_skills(extract.job_skill_lists(ads)).collect())
    assert skills == [("1", "python"), ("1", "rust")]


def test_dedupe_plan_does_not_depend_on_repeated_ids(spark):
    """One row per (id, skill), and the same plan with no, few and only repeated ids."""
    few = [
        ("7", M2, "Python", None),
        ("7", M1, "python and sql", None),
        ("8", M1, "Rust", "Docker"),
        (None, M1, "Go programming", None),
        (None, M2, "golang", None),
        ("9", M2, "C# and C++", None),
    ]
    shapes = set()
    for rows in (few, few[2:4] + few[5:], few[:2] * 40):
        ads = materialize(_ads(spark, rows), "dedupe_plan")
        found = extract.regex_skill_matches(ads)
        keys = [(r.id, r.skill) for r in found.collect()]
        assert len(keys) == len(set(keys))
        plan = extract.regex_skill_matches(ads)._jdf.queryExecution().executedPlan().toString()
        shapes.add(tuple(re.findall(r"\b(\w*(?:Exchange|Join|Aggregate|Scan))\b", plan)))
    assert len(shapes) == 1
    assert sorted(r.id or "" for r in extract.duplicate_ids(_ads(spark, few)).collect()) == ["", "7"]


def test_text_scan_of_large_splittable_files_is_not_shuffled(spark):
    """Four splittable files on eight slots: the text stays where it is read."""
    rows = [(str(i), M1, "Python", "text " * 50) for i in range(400)]
    ads = materialize(_ads(spark, rows).repartition(4), "four_files")
    for df in (extract.found_skill_matches(ads), extract.job_skill_lists(
        ads.select("id", F.col("publication_month").alias("publication_date"), "headline", F.col("description_text").alias("description__text"))
    )):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_shadowed_aliases_are_never_reported(spark):
    """An alias whose every match is also matched by an earlier alias of the
    same skill can never be the reported one."""
    m = _matches(
        spark,
        [
            ("1", M1, "Apache Spark", None),
            ("2", M1, "apache airflow", None),
            ("3", M1, "Google Cloud Platform", None),
            ("4", M1, "Power BI Desktop", None),
            ("5", M1, "large language models", None),
        ],
    )
    found = extract.regex_skill_matches(
        _ads(spark, [("1", M1, "Apache Spark", None)]), dedupe_ids=False
    ).collect()
    assert [r.matched_text for r in found] == ["Spark"]
    assert m[("1", "spark")].matched_text == "Spark"
    assert m[("2", "airflow")].matched_text == "airflow"
    assert m[("3", "gcp")].matched_text == "Google Cloud"
    assert m[("4", "power_bi")].matched_text == "Power BI"
    # the singular alias needs a boundary after "model", so the plural alias reports
    assert m[("5", "llm")].matched_text == "large language models"


def test_invariants_on_driver_tables(spark):
    from skillgrid.plans.warehouse import SkillWarehouse

    from .conftest import SF_SMALL

    wh = SkillWarehouse(spark, SF_SMALL, materialize_stages=False)
    dup = wh.regex_matches().groupBy("id", "skill").count().where("count > 1").count()
    assert dup == 0
    bounds = wh.trends().where("share_of_ads < 0 or share_of_ads > 1").count()
    assert bounds == 0 and wh.trends().count() > 0
    assert wh.geography().where("share_of_ads < 0 or share_of_ads > 1").count() == 0


def test_snippet_from_head_equals_full_snippet(spark):
    from skillgrid.functions import text as tx

    texts = [None, "", "a  b", "x" * 5000, " " * 4500 + "tail words", "word " * 1000,
             "\t\n".join(["ab"] * 3000), " " * 3999 + "y" * 600]
    df = spark.createDataFrame([(t,) for t in texts], "d string").withColumn("h", tx.snippet_head(F.col("d")))
    got = df.select(
        tx.snippet(F.col("d")).alias("full"), tx.snippet_from_head(F.col("h"), F.col("d")).alias("fast")
    ).collect()
    assert all(r.full == r.fast for r in got)
