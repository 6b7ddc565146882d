"""Named queries over an input folder: ``name -> (spark, sf_dir) -> DataFrame``.

Each query runs over the whole given tables (through the stand-in ads
binding); none samples, caps or filters rows to stay cheap. Limits appear
only where the top-k is the feature. Exploration parameters (date window,
selected skills, metric, top-n) play the role of the dashboard's widgets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgrid.functions.constants import CATALOGUE_TOP, LABEL_TOP, MONTHLY_SAMPLE, MONTHLY_TOP, REGEX_TOP
from skillgrid.operators import distinct_bitmaps, explore, extract, incremental_marts, marts, qa
from skillgrid.plans.warehouse import warehouse
from skillgrid.sources import archives

Query = Callable[[SparkSession, str], DataFrame]

# Exploration parameters (the dashboard's sidebar). A mid-month start drops
# that month, as the date filter compares month starts.
WINDOW_START = "2023-03-15"
WINDOW_END = "2024-10-31"
SELECTED_SKILLS = ["python", "sql", "csharp", "dotnet", "rust", "power_bi"]
METRIC = "share_of_ads"
TOP_N = 10
# Archive replacement scenario: one archive reloaded, one reloaded empty.
RELOADED_ARCHIVE = "src3"
EMPTIED_ARCHIVE = "src7"
RELOADED_SINCE = "2023-09-01"
# Overlapping windows of months for distinct counts.
DISTINCT_WINDOWS = [
    ("2023", "2023-01-01", "2023-12-01"),
    ("2024", "2024-01-01", "2024-12-01"),
    ("last spring", "2024-03-01", "2024-05-01"),
    ("all", "2023-01-01", "2024-12-01"),
]


def _wh(spark: SparkSession, sf_dir: str):
    return warehouse(spark, sf_dir)


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.filter_months(_wh(spark, sf_dir).trends(), WINDOW_START, WINDOW_END)


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.filter_skills(_filtered(spark, sf_dir), SELECTED_SKILLS)


def _geo_summary(spark: SparkSession, sf_dir: str, top_n: int | None) -> DataFrame:
    return explore.geo_summary(
        _wh(spark, sf_dir).geography(), WINDOW_START, WINDOW_END, SELECTED_SKILLS, METRIC, top_n
    )


def _broken(mart: DataFrame) -> DataFrame:
    return mart.withColumn("share_of_ads", F.col("share_of_ads") * 3 - 0.25)


QUERIES: dict[str, Query] = {
    # step 1: extraction -> marts
    "regex_matches": lambda s, d: _wh(s, d).regex_matches(),
    "regex_matches_indexed": lambda s, d: _wh(s, d).indexed_matches(),
    "word_matches": lambda s, d: _wh(s, d).word_matches(),
    "regex_skills": lambda s, d: _wh(s, d).regex_skills(),
    "monthly_counts": lambda s, d: _wh(s, d).monthly_counts(),
    "trends": lambda s, d: _wh(s, d).trends(),
    # step 2: provided labels, lineage, catalogue, live sample
    "ams_skills": lambda s, d: _wh(s, d).ams_skills(),
    "all_skills": lambda s, d: _wh(s, d).all_skills(),
    "skill_sources": lambda s, d: marts.skill_sources(_wh(s, d).all_skills()),
    "ams_catalogue": lambda s, d: _wh(s, d).ams_catalogue(),
    "job_skill_lists": lambda s, d: _wh(s, d).job_skill_lists(),
    "job_skills": lambda s, d: _wh(s, d).job_skills(),
    "skill_matches": lambda s, d: extract.skill_matches(_wh(s, d).marked_ads()),
    # printed top-k reports of the build steps
    "regex_top_skills": lambda s, d: explore.top_by_rows(_wh(s, d).regex_skills(), REGEX_TOP),
    "ams_top_skills": lambda s, d: explore.top_by_rows(_wh(s, d).ams_skills(), LABEL_TOP),
    "ams_catalogue_top": lambda s, d: _wh(s, d)
    .ams_catalogue()
    .orderBy("ads", "skill", ascending=[False, True])
    .limit(CATALOGUE_TOP),
    "monthly_sample": lambda s, d: explore.newest_first(_wh(s, d).monthly_counts(), MONTHLY_SAMPLE),
    # step 3: geography
    "ad_locations": lambda s, d: marts.ad_locations(_wh(s, d).stg_ads()),
    # ads is NULL for a NULL municipality code; as a double it compares alike in every client
    "geography": lambda s, d: _wh(s, d).geography().withColumn("ads", F.col("ads").cast("double")),
    # step 4: QA and data tests
    "qa_summary": lambda s, d: qa.qa_summary(_wh(s, d).regex_matches(), one_row_per_id_skill=True),
    "qa_top": lambda s, d: qa.qa_top(qa.qa_summary(_wh(s, d).regex_matches(), one_row_per_id_skill=True)),
    "samples": lambda s, d: qa.skill_samples(_wh(s, d).regex_matches()),
    "quality_report": lambda s, d: qa.quality_report(_wh(s, d).test_tables()),
    "quality_report_observed": lambda s, d: _wh(s, d).observed_report(),
    "share_violations": lambda s, d: qa.share_violations(_wh(s, d).trends(), _wh(s, d).geography()),
    "not_empty_check": lambda s, d: qa.not_empty_check(_wh(s, d).monthly_counts()),
    # the same tests over marts broken on purpose (shares moved out of bounds, no rows)
    "share_violations_broken": lambda s, d: qa.share_violations(_broken(_wh(s, d).trends()), _broken(_wh(s, d).geography())),
    "not_empty_check_broken": lambda s, d: qa.not_empty_check(_wh(s, d).monthly_counts().where("mentions < 0")),
    # step 5: exploration
    "trend_filter": _selected,
    "skill_totals": lambda s, d: explore.skill_totals(_wh(s, d).trends()),
    "top_skills": lambda s, d: explore.top_skills(_wh(s, d).monthly_counts(), MONTHLY_TOP),
    "top_n_month": lambda s, d: explore.top_n_month(_filtered(s, d), METRIC, TOP_N),
    "growth": lambda s, d: explore.growth(_filtered(s, d), METRIC, TOP_N, ascending=False),
    "decline": lambda s, d: explore.growth(_filtered(s, d), METRIC, TOP_N, ascending=True),
    "trend_pivot": lambda s, d: explore.trend_pivot(_selected(s, d), SELECTED_SKILLS, METRIC),
    "geo_summary": lambda s, d: _geo_summary(s, d, TOP_N),
    "map_points": lambda s, d: explore.map_points(_geo_summary(s, d, None), METRIC),
    "kpis": lambda s, d: explore.kpis(_filtered(s, d), METRIC),
    "months": lambda s, d: explore.months(_wh(s, d).trends()),
    "detail_table": lambda s, d: explore.detail_table(_filtered(s, d), METRIC),
    # step 6: ingestion
    "stg_ads": lambda s, d: _wh(s, d).stg_ads(),
    "flatten_ads": lambda s, d: archives.flatten_ads(
        archives.parse_ad_lines(archives.raw_lines_from_ads(_wh(s, d).ads()))
    ),
    "archive_validation": lambda s, d: marts.archive_validation(_wh(s, d).ads()),
    "load_totals": lambda s, d: marts.load_totals(_wh(s, d).ads()),
    "replace_partition": lambda s, d: _wh(s, d).replace_partition_demo(
        RELOADED_ARCHIVE, EMPTIED_ARCHIVE
    ),
    # distinct ads over windows and regions, from bitmaps
    "window_distincts": lambda s, d: distinct_bitmaps.window_distincts(
        _wh(s, d).cell_bitmaps(), s.createDataFrame(DISTINCT_WINDOWS, "window string, first_month string, last_month string"), ["region", "skill"]
    ),
    "region_distincts": lambda s, d: distinct_bitmaps.distinct_ads(_wh(s, d).cell_bitmaps(), ["region", "municipality"]),
    "incremental_trends": lambda s, d: incremental_marts.skill_trends(
        _wh(s, d).incremental_marts(RELOADED_ARCHIVE, RELOADED_SINCE)
    ),
    "incremental_geography": lambda s, d: incremental_marts.skill_geography(
        _wh(s, d).incremental_marts(RELOADED_ARCHIVE, RELOADED_SINCE)
    ).withColumn("ads", F.col("ads").cast("double")),
    "archive_versions": lambda s, d: _wh(s, d).archive_versions_demo(
        RELOADED_ARCHIVE, EMPTIED_ARCHIVE, RELOADED_SINCE
    ),
}
