"""End-to-end warehouse build over job-ad archives (the batch pipeline).

    python -m skillgrid.plans.build --raw RAW_DIR --warehouse OUT_DIR [--years 2024 2025] [--append]

Steps, each writing one Parquet table under the warehouse folder:

1. ``historical_job_ads``: archives -> flattened ads, partitioned by archive
   (full rebuild, or replace-by-archive with ``--append``).
2. ``historical_job_skills`` (provided labels) and ``historical_regex_skill_matches``
   -> ``historical_regex_skills`` (taxonomy regexes).
3. ``historical_regex_skill_qa_summary`` and ``historical_regex_skill_samples``.
4. ``all_historical_job_skills``, ``monthly_skill_counts``,
   ``mart_dashboard_skill_trends``, ``mart_skill_geography``.
5. ``ams_skill_catalogue`` and its CSV; with ``--live``, ``job_skill_lists`` and
   ``job_skills`` from landed search responses.
6. The data tests, counted while the tables are written. A failing test raises
   unless ``fail_on_test=False``, and nothing of the build is published.

All tables are written aside; the ads' new version and the others' successors
take their places when the tests have passed.

The session is the submitter's: master, memory and partition numbers are left
to ``spark-submit``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from skillgrid.operators import extract, marts, qa
from skillgrid.sources import archives, live
from skillgrid.sources.sinks import StagedTables, export_csv, write_table


def require_table(spark: SparkSession, path: str, hint: str) -> DataFrame:
    """Read a warehouse table, or fail with an instruction when it is missing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        raise RuntimeError(f"{path} does not exist. {hint}") from exc


def require_ads(spark: SparkSession, warehouse_dir: str, hint: str) -> DataFrame:
    """The newest version of the ads table, or an instruction when there is none."""
    path = _table(warehouse_dir, "historical_job_ads")
    try:
        return archives.read_ads_table(spark, path)
    except FileNotFoundError as exc:
        raise RuntimeError(f"{path} does not exist. {hint}") from exc


def _table(warehouse_dir: str, name: str) -> str:
    return f"{warehouse_dir.rstrip('/')}/{name}"


def _write(df: DataFrame, warehouse_dir: str, name: str) -> DataFrame:
    path = _table(warehouse_dir, name)
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def build_skills(spark: SparkSession, warehouse_dir: str) -> dict[str, DataFrame]:
    """Steps 2-5 from an existing ads table."""
    ads = require_ads(spark, warehouse_dir, "Load archives first (step 1).")
    staged = StagedTables(spark, warehouse_dir)
    stage_skills(ads, staged)
    return _published(spark, warehouse_dir, staged, ads)


def _published(spark: SparkSession, warehouse_dir: str, staged: StagedTables, ads: DataFrame) -> dict[str, DataFrame]:
    """Publishes the staged tables and the catalogue's CSV; returns all tables."""
    staged.publish()
    t = {n: spark.read.parquet(_table(warehouse_dir, n)) for n in staged.names}
    # One row per label: a small table, exported as one file.
    export_csv(t["ams_skill_catalogue"].orderBy(F.desc("ads"), "skill"), _table(warehouse_dir, "ams_skill_catalogue_csv"), single_file=True)
    return {"historical_job_ads": ads, **t}


def stage_skills(ads: DataFrame, staged: StagedTables, tests: qa.ObservedTests | None = None) -> dict[str, DataFrame]:
    """Steps 2-5, written aside; ``tests`` watches the tables as they are written."""

    def write(df: DataFrame, name: str) -> DataFrame:
        return staged.write(tests.watch(name, df) if tests else df, name)

    t: dict[str, DataFrame] = {"historical_job_ads": ads}
    t["historical_job_skills"] = write(extract.ams_skills(ads), "historical_job_skills")
    matches = write(extract.regex_skill_matches(ads), "historical_regex_skill_matches")
    dup_ids = write(extract.duplicate_ids(ads), "duplicate_ad_ids")
    t["historical_regex_skill_matches"] = matches
    t["historical_regex_skills"] = write(extract.regex_skills(matches), "historical_regex_skills")
    t["historical_regex_skill_qa_summary"] = write(qa.qa_summary(matches, one_row_per_id_skill=True), "historical_regex_skill_qa_summary")
    t["historical_regex_skill_samples"] = write(qa.skill_samples(matches), "historical_regex_skill_samples")
    t["all_historical_job_skills"] = write(
        marts.all_skills(t["historical_job_skills"], t["historical_regex_skills"]), "all_historical_job_skills")
    counts = write(marts.monthly_skill_counts(t["historical_regex_skills"], one_row_per_id_skill=True), "monthly_skill_counts")
    t["monthly_skill_counts"] = counts
    stg = marts.stg_ads(ads)
    t["mart_dashboard_skill_trends"] = write(marts.skill_trends(counts, stg, dup_ids), "mart_dashboard_skill_trends")
    t["mart_skill_geography"] = write(
        marts.skill_geography(t["historical_regex_skills"], stg, one_row_per_id_skill=True, dup_ids=dup_ids), "mart_skill_geography")
    t["ams_skill_catalogue"] = write(marts.ams_catalogue(t["historical_job_skills"]), "ams_skill_catalogue")
    return t


def build_live_sample(spark: SparkSession, landed: str, warehouse_dir: str, limit: int | None = None) -> dict[str, DataFrame]:
    """``job_ads``, ``job_skill_lists`` and ``job_skills`` from landed search responses."""
    ads = _write(live.landed_hits(spark, landed, limit), warehouse_dir, "job_ads")
    lists = _write(extract.job_skill_lists(ads), warehouse_dir, "job_skill_lists")
    return {"job_ads": ads, "job_skill_lists": lists, "job_skills": _write(extract.job_skills(lists), warehouse_dir, "job_skills")}


def run(
    spark: SparkSession,
    raw_dir: str,
    warehouse_dir: str,
    years: list[int] | None = None,
    append: bool = False,
    fail_on_test: bool = True,
) -> DataFrame:
    """Build every table; return the data-test report.

    With ``fail_on_test``, a failing test leaves every table as it was; the
    report tells what failed.
    """
    path = _table(warehouse_dir, "historical_job_ads")
    if append:
        archives.check_readable(spark, path)
    tests, staged = qa.ObservedTests(), StagedTables(spark, warehouse_dir)
    load = archives.stage_archives(spark, raw_dir, path, years, lambda ads: tests.watch("historical_job_ads", ads))
    try:
        ads = load.view(whole=not append).select(*archives.ADS_COLUMNS)
        tables = stage_skills(ads, staged, tests)
        # Of the ads, those of archives that stay were counted by no job of this build: two columns are read.
        kept = load.others(whole=not append)
        found = tests.report(tables, {"historical_job_ads": kept} if kept is not None else None)
        report = _write(found, warehouse_dir, "data_test_report")
        failed = [tuple(r) for r in report.where(F.col("failures") > 0).collect()]  # at most one row per declared test
        if failed and fail_on_test:
            raise AssertionError(f"data tests failed: {failed}")
    except BaseException:
        load.discard()
        staged.discard()
        raise
    load.publish(whole=not append)
    _published(spark, warehouse_dir, staged, archives.read_ads_table(spark, path))
    return report


def reports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The console reports of the build steps, as DataFrames."""
    from skillgrid.functions import constants as fixed
    from skillgrid.operators import explore

    ads = tables["historical_job_ads"]
    return {
        "archive validation": marts.archive_validation(ads),
        "load totals": marts.load_totals(ads),
        "top provided labels": explore.top_by_rows(tables["historical_job_skills"], fixed.LABEL_TOP),
        "top regex skills": explore.top_by_rows(tables["historical_regex_skills"], fixed.REGEX_TOP),
        "regex QA summary": qa.qa_top(tables["historical_regex_skill_qa_summary"], fixed.QA_TOP),
        "skill sources": marts.skill_sources(tables["all_historical_job_skills"]),
        "monthly skill counts, newest": explore.newest_first(tables["monthly_skill_counts"], fixed.MONTHLY_SAMPLE),
        "top skills by monthly mentions": explore.top_skills(tables["monthly_skill_counts"], fixed.MONTHLY_TOP),
    }


def main() -> None:
    from skillgrid.session import job_session

    parser = argparse.ArgumentParser(description="Build the skill warehouse from job-ad archives.")
    parser.add_argument("--raw", required=True, help="folder of YYYY*.jsonl.zip archives")
    parser.add_argument("--warehouse", required=True, help="output folder for the tables")
    parser.add_argument("--years", type=int, nargs="+")
    parser.add_argument("--append", action="store_true", help="keep the archives that are not loaded now")
    parser.add_argument("--live", help="folder of landed search responses")
    args = parser.parse_args()
    spark = job_session()
    report = run(spark, args.raw, args.warehouse, args.years, args.append, fail_on_test=False)
    if args.live:
        build_live_sample(spark, args.live, args.warehouse)
    for title, df in reports(build_skills_tables(spark, args.warehouse)).items():
        print(f"== {title}")
        df.show(100, truncate=False)
    print("== data tests")
    report.show(30, truncate=False)


def build_skills_tables(spark: SparkSession, warehouse_dir: str) -> dict[str, DataFrame]:
    """The written tables of a built warehouse, by name."""
    names = [
        "historical_job_skills",
        "historical_regex_skills",
        "historical_regex_skill_qa_summary",
        "all_historical_job_skills",
        "monthly_skill_counts",
    ]
    hint = "Build the warehouse first."
    ads = {"historical_job_ads": require_ads(spark, warehouse_dir, hint)}
    return {**ads, **{n: require_table(spark, _table(warehouse_dir, n), hint) for n in names}}


if __name__ == "__main__":
    main()
