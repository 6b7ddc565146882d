"""Exploration queries over the trend and geography marts.

These are the questions the original dashboard answers in pandas, as lazy
DataFrame functions. "First/last/latest month" rows come from a left-semi
join on the month with a one-row aggregate (bounded by construction), never
from a value collected to the driver. Every top-k sorts by the metric and then ``skill``
(or the location keys) so that ties are deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgrid.functions.constants import RADIUS_BASE, RADIUS_SPAN
from skillgrid.operators.joins import attach_one_row

METRICS = ("share_of_ads", "mentions")
GEO_KEYS = ["municipality", "municipality_code", "region", "longitude", "latitude"]


def _metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    return metric


def _as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def filter_months(df: DataFrame, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Months whose first day lies in [start, end] (a mid-month start drops that month)."""
    day = F.to_date("publication_month")
    return df.where(day.between(F.lit(_as_date(start)), F.lit(_as_date(end))))


def filter_skills(df: DataFrame, skills: list[str]) -> DataFrame:
    """Membership filter; an empty selection keeps no rows."""
    if not skills:
        return df.where(F.lit(False))
    return df.where(F.col("skill").isin(*skills))


def trend_filter(trends: DataFrame, start, end, skills: list[str]) -> DataFrame:
    return filter_skills(filter_months(trends, start, end), skills)


def months(trends: DataFrame) -> DataFrame:
    """Distinct months, ascending."""
    return trends.select("publication_month").distinct().orderBy("publication_month")


def skill_totals(trends: DataFrame) -> DataFrame:
    """Total mentions per skill, descending."""
    return (
        trends.groupBy("skill")
        .agg(F.sum("mentions").cast("long").alias("mentions"))
        .orderBy(F.desc("mentions"), F.asc("skill"))
    )


def top_skills(monthly_counts: DataFrame, k: int = 30) -> DataFrame:
    """Top ``k`` skills by summed monthly mentions."""
    return (
        monthly_counts.groupBy("skill")
        .agg(F.sum("mentions").cast("long").alias("mentions"))
        .orderBy(F.desc("mentions"), F.asc("skill"))
        .limit(k)
    )


def top_by_rows(skills: DataFrame, k: int) -> DataFrame:
    """Top ``k`` skills by row count (mentions), ties by skill."""
    return (
        skills.groupBy("skill")
        .agg(F.count("*").alias("mentions"))
        .orderBy(F.desc("mentions"), F.asc("skill"))
        .limit(k)
    )


def newest_first(monthly_counts: DataFrame, k: int = 20) -> DataFrame:
    """First ``k`` rows by month descending, then mentions descending."""
    return monthly_counts.orderBy(
        F.desc("publication_month"), F.desc("mentions"), F.asc("skill")
    ).limit(k)


def rows_at_month(df: DataFrame, which: str = "max", month=None) -> DataFrame:
    """Rows of the first ("min"), last ("max") or a given month, without a collect."""
    if month is not None:
        return df.where(F.to_date("publication_month") == F.lit(_as_date(month)))
    bound = df.agg(getattr(F, which)("publication_month").alias("publication_month"))
    # a left-semi equi-join on the month with a one-row (broadcast) side
    return df.join(F.broadcast(bound), "publication_month", "left_semi")


def top_n_month(filtered: DataFrame, metric: str = "share_of_ads", n: int = 10, month=None) -> DataFrame:
    """Top ``n`` skills of one month (default: the latest) by ``metric``."""
    m = _metric(metric)
    return (
        rows_at_month(filtered, "max", month)
        .orderBy(F.desc(m), F.asc("skill"))
        .limit(n)
        .select("skill", "mentions", "share_of_ads")
    )


def growth(filtered: DataFrame, metric: str = "share_of_ads", top_n: int = 10, ascending: bool = False) -> DataFrame:
    """Absolute change last month minus first month, per skill present at both ends."""
    m = _metric(metric)
    first = rows_at_month(filtered, "min").select("skill", F.col(m).alias("first_value"))
    last = rows_at_month(filtered, "max").select("skill", F.col(m).alias("last_value"))
    change = first.join(last, "skill", "inner").withColumn(
        "change", F.col("last_value") - F.col("first_value")
    )
    order = F.asc("change") if ascending else F.desc("change")
    return change.orderBy(order, F.asc("skill")).limit(top_n).select(
        "skill", "first_value", "last_value", "change"
    )


def trend_pivot(selected: DataFrame, skills: list[str], metric: str = "share_of_ads") -> DataFrame:
    """Month x skill table of ``sum(metric)``, months in order; a missing cell is NULL."""
    m = _metric(metric)
    return selected.groupBy("publication_month").pivot("skill", list(skills)).agg(F.sum(m)).orderBy("publication_month")


def kpis(filtered: DataFrame, metric: str = "share_of_ads") -> DataFrame:
    """One row: skills, months, ads in the latest month, top skill of the latest month.

    The top skill is the largest metric, ties to the smallest skill name.
    """
    m = _metric(metric)
    # One aggregate, no join: the struct orderings pick the latest month's
    # largest ads, and its largest metric with the smallest skill name.
    newest = -F.unix_micros(F.col("publication_month").cast("timestamp"))
    latest = F.max(F.struct("publication_month", "ads"))
    top = F.min(F.struct(newest.alias("t"), (-F.col(m)).alias("v"), F.col("skill")))
    return filtered.agg(
        F.count_distinct("skill").alias("skills"),
        F.count_distinct("publication_month").alias("months"),
        latest.getField("publication_month").alias("latest_month"),
        latest.getField("ads").alias("latest_ads"),
        top.getField("skill").alias("top_skill"),
    )


def detail_table(filtered: DataFrame, metric: str = "share_of_ads") -> DataFrame:
    """All filtered rows, newest month first, then by metric."""
    m = _metric(metric)
    return filtered.orderBy(F.desc("publication_month"), F.desc(m), F.asc("skill"))


def geo_summary(
    geography: DataFrame,
    start,
    end,
    skills: list[str],
    metric: str = "share_of_ads",
    top_n: int | None = None,
) -> DataFrame:
    """Per location (grouped by centroid, as the map does): sum of mentions,
    max of ads, unweighted mean of monthly shares. Rows with a NULL key are
    dropped first. Sorted by ``metric``; ``top_n`` keeps the table head.
    """
    m = _metric(metric)
    geo = filter_skills(filter_months(geography, start, end), skills).dropna(subset=GEO_KEYS)
    summary = geo.groupBy(*GEO_KEYS).agg(
        F.sum("mentions").cast("long").alias("mentions"),
        F.max("ads").alias("ads"),
        F.avg("share_of_ads").alias("share_of_ads"),
    )
    # The mean's last bits depend on the order of summation: ties are judged without them.
    ordered = summary.orderBy(F.round(F.col(m), 10).desc(), *[F.asc_nulls_last(k) for k in GEO_KEYS])
    return ordered.limit(top_n) if top_n else ordered


def map_points(summary: DataFrame, metric: str = "share_of_ads") -> DataFrame:
    """Bubble radius per location: base + metric / max(metric) * span.

    No rows when the largest value is not positive.
    """
    m = _metric(metric)
    with_max = attach_one_row(summary, summary.agg(F.max(m).alias("_max")))
    return (
        with_max.where(F.col("_max") > 0)
        .select(
            *GEO_KEYS,
            "mentions",
            "ads",
            "share_of_ads",
            (F.lit(RADIUS_BASE) + F.col(m) / F.col("_max") * F.lit(RADIUS_SPAN)).alias("radius"),
            F.round(F.col("share_of_ads") * 100, 2).alias("share_pct"),
        )
    )
