"""Exact distinct ads that can be added up again: bitmaps per month, municipality and skill.

``count(distinct id)`` per month does not sum over months, since an id may be
in several. Here every id gets a number, and each (month, place, skill) holds
its ids as bitmaps of 32,768 bits; the distinct ads of any window of months and
any set of regions, municipalities or skills are the bits of the OR-ed bitmaps.
No ad is read again and no id is shuffled.

Ids are numbered in the order of their place and month, so the ids of one cell
lie together: a cell has few bitmaps, whatever the number of ads. The numbers
come from range-partitioned, sorted partitions, each with a range of its own;
nothing is ranked in one task. NULL ids are not counted, as in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgrid.session import materialize

CELL = ["publication_month", "region", "region_code", "municipality", "municipality_code", "skill"]


def located_skills(regex_skills: DataFrame, locations: DataFrame) -> DataFrame:
    """(id, cell) of every skill of every located ad, joined on id and month as the geography mart does."""
    keys = ["id", "publication_month"]
    return regex_skills.select(*keys, "skill").join(locations, keys).select("id", *CELL).where(F.col("id").isNotNull())


def id_numbers(pairs: DataFrame) -> DataFrame:
    """(id, number): ids in the order of their first place and month; written, so that numbers do not change."""
    first = F.min(F.struct("municipality_code", "municipality", "publication_month")).alias("at")
    placed = pairs.groupBy("id").agg(first)
    order = ["at", "id"]
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(dealt.select("id", F.monotonically_increasing_id().alias("number")), "id-numbers")


def cell_bitmaps(pairs: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """(cell, bucket, bits): the ids of each cell, one row per 32,768 numbers that it has any of."""
    numbered = pairs.join(id_numbers(pairs) if numbers is None else numbers, "id")
    bucket, position = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    rows = numbered.select(*CELL, bucket.alias("bucket"), position.alias("position"))
    return rows.groupBy(*CELL, "bucket").agg(F.bitmap_construct_agg("position").alias("bits"))


def distinct_ads(bitmaps: DataFrame, by: list[str | Column], alias: str = "ads") -> DataFrame:
    """Distinct ads per ``by`` (names or aliased columns) of the cells that the caller has filtered."""
    keys = [F.col(b) if isinstance(b, str) else b for b in by]
    held = bitmaps.select(*keys, F.col("bucket"), F.col("bits"))
    names = [c for c in held.columns if c not in ("bucket", "bits")]
    merged = held.groupBy(*names, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias(alias))


def window_distincts(bitmaps: DataFrame, windows: DataFrame, by: list[str]) -> DataFrame:
    """Distinct ads per (window, ``by``) for overlapping windows (window, first_month, last_month).

    Cells are summed up to months first; a month's bitmaps then go to each
    window that holds it. The windows are parameters: their months are listed
    and joined on equality.
    """
    step = F.expr("sequence(cast(first_month as date), cast(last_month as date), interval 1 month)")
    held = windows.select("window", F.explode(step).alias("day")).select("window", F.col("day").cast("timestamp_ntz").alias("publication_month"))
    keys = [*by, "publication_month"]
    monthly = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return distinct_ads(monthly.join(held, "publication_month"), ["window", *by])
