"""Builds that publish whole or not at all, and data tests counted while writing."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from skillgrid.operators import qa
from skillgrid.plans import build
from skillgrid.sources import archives, sinks

from .test_ingestion import _ad, _write_zip


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _zip(raw, year, ads, more=()):
    raw.mkdir(exist_ok=True)
    _write_zip(raw / f"{year}.jsonl.zip", {f"{year}.jsonl": [*(json.dumps(a) for a in ads), *more]})


def test_failing_test_leaves_every_table(spark, tmp_dir):
    raw, wh = tmp_dir / "raw", str(tmp_dir / "wh")
    _zip(raw, 2022, [_ad(i, 2022, "struct") for i in range(3)])
    _zip(raw, 2024, [_ad(i, 2024, "list") for i in range(3, 6)])
    report = build.run(spark, str(raw), wh)
    assert {r.failures for r in report.collect()} == {0} and report.count() == 26
    names = ["mart_dashboard_skill_trends", "historical_regex_skills", "ams_skill_catalogue"]
    before = {n: _rows(spark.read.parquet(f"{wh}/{n}")) for n in names}
    ads = _rows(archives.read_ads_table(spark, f"{wh}/historical_job_ads"))
    _zip(raw, 2024, [_ad(9, 2024, "list", "Rust")], ["{bad json"])
    for append in (True, False):
        with pytest.raises(AssertionError, match="historical_job_ads"):
            build.run(spark, str(raw), wh, years=[2024] if append else None, append=append)
        assert {n: _rows(spark.read.parquet(f"{wh}/{n}")) for n in names} == before
        assert _rows(archives.read_ads_table(spark, f"{wh}/historical_job_ads")) == ads
    # the report names the failure, counted over the new ads and those that stay
    found = {(r.table_name, r.column_name): r.failures for r in spark.read.parquet(f"{wh}/data_test_report").collect() if r.failures}
    assert found == {("historical_job_ads", "id"): 1, ("historical_job_ads", "publication_month"): 1}
    build.run(spark, str(raw), wh, years=[2024], append=True, fail_on_test=False)
    after = archives.read_ads_table(spark, f"{wh}/historical_job_ads")
    assert sorted((r.source_archive[:4], r.id or "") for r in after.collect()) == [("2022", "0"), ("2022", "1"), ("2022", "2"), ("2024", ""), ("2024", "9")]
    assert {r.skill for r in spark.read.parquet(f"{wh}/historical_regex_skills").collect()} == {"python", "sql", "rust"}
    assert not [p for p in (tmp_dir / "wh").iterdir() if p.name.startswith(("_staged", "_retired"))]


def test_appended_build_counts_the_ads_that_stay(spark, tmp_dir):
    raw, wh = tmp_dir / "raw", str(tmp_dir / "wh")
    _zip(raw, 2022, [_ad(i, 2022, "struct") for i in range(3)], ["{bad", "{worse"])
    build.run(spark, str(raw), wh, fail_on_test=False)
    _zip(raw, 2024, [_ad(7, 2024, "list")], ["{bad"])
    report = build.run(spark, str(raw), wh, years=[2024], append=True, fail_on_test=False)
    assert {r.failures for r in report.collect() if r.table_name == "historical_job_ads"} == {3}


def test_observed_counts_equal_the_report(spark, tmp_dir):
    month = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    base = spark.range(50).withColumn("publication_month", F.when(F.col("id") % 9 > 0, month))
    tables = {
        "historical_job_ads": base.withColumn("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("string"))),
        "historical_job_skills": base.withColumn("skill_source", F.when(F.col("id") < 40, "ams").otherwise(F.concat(F.lit("x"), F.col("id") % 3))),
        "historical_regex_skills": base.withColumns({"skill": F.lit(None).cast("string"), "skill_source": F.lit("regex")}),
        "monthly_skill_counts": base.limit(0).withColumns({"skill": F.lit("a"), "mentions": F.lit(1)}),
        "mart_dashboard_skill_trends": base.withColumns({"skill": F.lit("a"), "mentions": F.lit(1), "ads": F.lit(2), "share_of_ads": F.col("id") / 20 - 0.2}),
        "mart_skill_geography": base.withColumns({"skill": F.lit("a"), "municipality": F.lit("m"), "municipality_code": F.lit("c"), "region": F.lit("r"),
                                                  "mentions": F.lit(1), "ads": F.lit(2), "share_of_ads": F.lit(0.5)}),
    }
    tests, written = qa.ObservedTests(), {}
    for name, df in tables.items():
        if name != "mart_skill_geography":  # one is not watched
            sinks.write_table(tests.watch(name, df), str(tmp_dir / name))
            written[name] = spark.read.parquet(str(tmp_dir / name))
    want = _rows(qa.quality_report(tables))
    assert _rows(tests.report({**tables, **written})) == want
    assert sum(r[3] for r in want) > 30 and ("monthly_skill_counts", "not_empty", None, 1) in want


def test_table_is_rewritten_from_its_own_rows_and_survives_a_failure(spark, tmp_dir):
    path = str(tmp_dir / "t")
    sinks.write_table(spark.range(10), path)
    sinks.write_table(spark.read.parquet(path).where("id > 4"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [5, 6, 7, 8, 9]
    with pytest.raises(Exception, match="lost"):
        sinks.write_table(spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_dir.iterdir()] == ["t"]
