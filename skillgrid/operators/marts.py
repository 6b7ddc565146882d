"""Marts and reports over ads and skill tables.

All distinct counts are exact. Small pre-aggregates (per month, per month and
municipality) are joined as plain joins: AQE measures the materialised side
at runtime and broadcasts it when small, else keeps a shuffle join, so no
side is broadcast without a proven size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgrid.functions.constants import (
    LATITUDE_BOUNDS,
    LONGITUDE_BOUNDS,
    UNKNOWN_REGION,
    UNKNOWN_REGION_CODE,
)

STG_COLUMNS = [
    "id",
    "publication_date",
    "publication_month",
    "headline",
    "description_text",
    "occupation",
    "occupation_group",
    "occupation_field",
    "municipality",
    "municipality_code",
    "region",
    "region_code",
    "postcode",
    "city",
    "longitude",
    "latitude",
    "source_archive",
    "source_year",
]


def stg_ads(ads: DataFrame) -> DataFrame:
    """Staging projection: the ad columns without the two label arrays."""
    return ads.select(*STG_COLUMNS)


def share(numerator: str, denominator: str):
    """numerator / denominator as double; NULL when the denominator is 0."""
    return F.col(numerator).cast("double") / F.nullif(F.col(denominator), F.lit(0))


def distinct_ads(df: DataFrame, keys: list[str], alias: str, dup_ids: DataFrame | None = None) -> DataFrame:
    """``count(distinct id)`` per ``keys``, over rows that are one per ad row.

    Given the ids that occur on more than one ad row (``dup_ids``), every
    other id is a single row, so its count is a row count; only flagged rows
    need the distinct count. One aggregate: unflagged rows collapse map-side
    instead of shuffling every (group, id) pair. The flagging join is planned
    by Spark from the size of ``dup_ids`` in bytes. Without ``dup_ids`` it is
    the plain exact distinct count. NULL ids are not counted.
    """
    if dup_ids is None:
        return df.groupBy(*keys).agg(F.count_distinct("id").alias(alias))
    flags = dup_ids.select(F.col("id").alias("_dup_id"), F.lit(True).alias("_dup"))
    flagged = df.join(flags, df["id"].eqNullSafe(flags["_dup_id"]), "left")
    dup = F.col("_dup").isNotNull()
    single = F.count(F.when(~dup & F.col("id").isNotNull(), F.lit(1)))
    repeated = F.count_distinct(F.when(dup, F.col("id")))
    return flagged.groupBy(*keys).agg((single + repeated).alias(alias))


def monthly_ads(ads: DataFrame, dup_ids: DataFrame | None = None) -> DataFrame:
    """Distinct ads per publication month."""
    return distinct_ads(ads, ["publication_month"], "ads", dup_ids)


def distinct_ids(one_row_per_id_skill: bool):
    """``count(distinct id)``, or ``count(id)`` where rows are known to be unique per
    (id, skill) within each group: then the two are equal (neither counts a NULL
    id), and the count needs only map-side partial sums instead of a shuffle of
    every (group, id) pair."""
    return F.count("id") if one_row_per_id_skill else F.count_distinct("id")


def monthly_skill_counts(regex_skills: DataFrame, one_row_per_id_skill: bool = False) -> DataFrame:
    """``monthly_skill_counts``: distinct ads mentioning each skill per month.

    Pass ``one_row_per_id_skill`` for the deduplicated regex skills (one row
    per (id, skill) globally), where a row count is the distinct-id count.
    """
    return regex_skills.groupBy("publication_month", "skill").agg(
        distinct_ids(one_row_per_id_skill).alias("mentions")
    )


def skill_trends(
    monthly_counts: DataFrame, ads: DataFrame, dup_ids: DataFrame | None = None
) -> DataFrame:
    """``mart_dashboard_skill_trends``: mentions, ads and share of ads per month."""
    per_month = monthly_ads(ads, dup_ids)
    return monthly_counts.join(per_month, "publication_month", "inner").select(
        "publication_month",
        "skill",
        "mentions",
        "ads",
        share("mentions", "ads").alias("share_of_ads"),
    )


def ad_locations(
    ads: DataFrame,
    lon_bounds: tuple[float, float] = LONGITUDE_BOUNDS,
    lat_bounds: tuple[float, float] = LATITUDE_BOUNDS,
) -> DataFrame:
    """Ads with a municipality and coordinates inside the bounds."""
    return ads.where(
        F.col("municipality").isNotNull()
        & F.col("longitude").between(*lon_bounds)
        & F.col("latitude").between(*lat_bounds)
    ).select(
        "id",
        "publication_month",
        "municipality",
        "municipality_code",
        F.coalesce(F.col("region"), F.lit(UNKNOWN_REGION)).alias("region"),
        F.coalesce(F.col("region_code"), F.lit(UNKNOWN_REGION_CODE)).alias("region_code"),
        "longitude",
        "latitude",
    )


def skill_geography(
    regex_skills: DataFrame,
    ads: DataFrame,
    lon_bounds: tuple[float, float] = LONGITUDE_BOUNDS,
    lat_bounds: tuple[float, float] = LATITUDE_BOUNDS,
    one_row_per_id_skill: bool = False,
    dup_ids: DataFrame | None = None,
) -> DataFrame:
    """``mart_skill_geography``: skill demand per month and municipality.

    The denominator is distinct ads per (month, municipality_code) *after*
    the coordinate filter. In the SQL model skills join located ads on
    (id, month), so an id repeated inside a month multiplies rows, and the
    centroid is the mean over those pairs. Here located ads are first reduced
    to one row per (id, month, location) with a row count and coordinate
    sums; the centroid is sum / count over the joined rows, which is the same
    mean, and a repeated id contributes one row per location, not one per copy,
    so no key emits all pairs. With skills unique per (id, skill), joined rows
    are unique per (id, month, skill, location), and mentions is a row count.

    The denominator is counted over the located rows themselves (narrow, and
    without an id-level shuffle when ``dup_ids`` is given) and joined after the
    aggregate: month and code are among its keys, so no joined pair is ever
    shuffled on a hot municipality.
    """
    loc_keys = ["municipality", "municipality_code", "region", "region_code"]
    located = ad_locations(ads, lon_bounds, lat_bounds)
    per_ad = located.groupBy("id", "publication_month", *loc_keys).agg(
        F.count("*").alias("n"),
        F.sum("longitude").alias("lon_sum"),
        F.sum("latitude").alias("lat_sum"),
    )
    location_ads = distinct_ads(located, ["publication_month", "municipality_code"], "ads", dup_ids)
    skills = regex_skills.select("id", "publication_month", "skill")
    keys = ["publication_month", "skill", *loc_keys]
    mentions = (
        skills.join(per_ad, ["id", "publication_month"], "inner")
        .groupBy(*keys)
        .agg(
            (F.sum("lon_sum") / F.sum("n")).alias("longitude"),
            (F.sum("lat_sum") / F.sum("n")).alias("latitude"),
            distinct_ids(one_row_per_id_skill).alias("mentions"),
        )
    )
    return mentions.join(location_ads, ["publication_month", "municipality_code"], "left").select(
        *keys, "longitude", "latitude", "mentions", "ads", share("mentions", "ads").alias("share_of_ads")
    )


def all_skills(ams: DataFrame, regex: DataFrame) -> DataFrame:
    """Both skill sources, UNION ALL."""
    cols = ["id", "publication_month", "skill", "skill_source"]
    return ams.select(*cols).unionByName(regex.select(*cols))


def skill_sources(all_skill_rows: DataFrame) -> DataFrame:
    """Rows per skill source."""
    return all_skill_rows.groupBy("skill_source").agg(F.count("*").alias("rows"))


def ams_catalogue(ams: DataFrame) -> DataFrame:
    """Distinct ads and mentions per provided label."""
    return ams.groupBy("skill").agg(
        F.count_distinct("id").alias("ads"), F.count("*").alias("mentions")
    )


def archive_validation(ads: DataFrame) -> DataFrame:
    """Per-archive load report: rows, distinct ads, first/last publication date."""
    return ads.groupBy("source_archive").agg(
        F.count("*").alias("rows"),
        F.min("publication_date").alias("first_publication_date"),
        F.max("publication_date").alias("last_publication_date"),
        F.count_distinct("id").alias("distinct_ads"),
    )


def load_totals(ads: DataFrame) -> DataFrame:
    """Whole-table load report: one row (D16 totals)."""
    return ads.agg(
        F.count("*").alias("rows"),
        F.count_distinct("id").alias("distinct_ads"),
        F.min("publication_date").alias("first_publication_date"),
        F.max("publication_date").alias("last_publication_date"),
    )
