"""The dashboard's questions over a built warehouse, as DataFrames.

    python -m skillgrid.plans.report --warehouse OUT_DIR [--start 2024-01-01] [--end 2024-12-31]
        [--skills python sql] [--metric share_of_ads|mentions] [--top-n 10] [--month 2024-06-01]

Reads ``mart_dashboard_skill_trends`` and ``mart_skill_geography`` written by
``skillgrid.plans.build`` and answers what the original dashboard shows:
KPIs, trend pivot, top-N of a month, growth and decline, geography summary
and map points, and the detail table. Defaults follow the dashboard: the
whole date range, the five skills with the most mentions, share of ads, top 10.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgrid.operators import explore
from skillgrid.plans.build import require_table

DEFAULT_SKILLS = 5  # the dashboard preselects this many top skills


def default_skills(trends: DataFrame, k: int = DEFAULT_SKILLS) -> list[str]:
    """The ``k`` skills with the most mentions (a bounded, k-row collect)."""
    return [r.skill for r in explore.skill_totals(trends).limit(k).collect()]


def date_bounds(trends: DataFrame) -> tuple[str, str]:
    """First and last month as ISO dates (one aggregate row)."""
    row = trends.agg(
        F.to_date(F.min("publication_month")).alias("lo"), F.to_date(F.max("publication_month")).alias("hi")
    ).first()
    return row.lo.isoformat(), row.hi.isoformat()


def dashboard(
    trends: DataFrame,
    geography: DataFrame,
    start: str | None = None,
    end: str | None = None,
    skills: list[str] | None = None,
    metric: str = "share_of_ads",
    top_n: int = 10,
    month: str | None = None,
) -> dict[str, DataFrame]:
    """Every dashboard view for one choice of filters."""
    if start is None or end is None:
        lo, hi = date_bounds(trends)
        start, end = start or lo, end or hi
    skills = default_skills(trends) if skills is None else skills
    filtered = explore.filter_months(trends, start, end)
    selected = explore.filter_skills(filtered, skills)
    summary = explore.geo_summary(geography, start, end, skills, metric)
    return {
        "kpis": explore.kpis(filtered, metric),
        "trend_pivot": explore.trend_pivot(selected, skills, metric),
        "top_n_month": explore.top_n_month(filtered, metric, top_n, month),
        "growth": explore.growth(filtered, metric, top_n, ascending=False),
        "decline": explore.growth(filtered, metric, top_n, ascending=True),
        "geo_summary": summary.limit(top_n),
        "map_points": explore.map_points(summary, metric),
        "detail_table": explore.detail_table(filtered, metric),
    }


def from_warehouse(spark: SparkSession, warehouse_dir: str, **params) -> dict[str, DataFrame]:
    root = warehouse_dir.rstrip("/")
    hint = "Build the warehouse first (python -m skillgrid.plans.build)."
    trends = require_table(spark, f"{root}/mart_dashboard_skill_trends", hint)
    geography = require_table(spark, f"{root}/mart_skill_geography", hint)
    return dashboard(trends, geography, **params)


def main() -> None:
    from skillgrid.session import job_session

    parser = argparse.ArgumentParser(description="Skill-demand views over a built warehouse.")
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--start")
    parser.add_argument("--end")
    parser.add_argument("--skills", nargs="+")
    parser.add_argument("--metric", default="share_of_ads", choices=explore.METRICS)
    parser.add_argument("--top-n", type=int, default=10)
    parser.add_argument("--month")
    parser.add_argument("--rows", type=int, default=20, help="rows shown per view")
    args = parser.parse_args()
    spark = job_session()
    views = from_warehouse(
        spark,
        args.warehouse,
        start=args.start,
        end=args.end,
        skills=args.skills,
        metric=args.metric,
        top_n=args.top_n,
        month=args.month,
    )
    for name, df in views.items():
        print(f"== {name}")
        df.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
