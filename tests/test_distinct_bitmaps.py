"""Distinct ads from bitmaps equal count(distinct) over any window and set of places."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from skillgrid.operators import distinct_bitmaps as db


def _pairs(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        place = rng.choice([("A", "1", "a", "11"), ("A", "1", "b", "12"), ("B", "2", "c", None), ("Unknown", "unknown", "d", "14")])
        rows.append((rng.choice(["hot", *map(str, range(300))]), dt.datetime(2024, rng.randint(1, 6), 1), *place, rng.choice("xyz")))
    return spark.createDataFrame(rows, "id string, publication_month timestamp_ntz, region string, region_code string, municipality string, municipality_code string, skill string")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_any_window_and_region_set(spark):
    pairs = _pairs(spark, 3000, 1)
    bitmaps = db.cell_bitmaps(pairs)
    for where in ("true", "publication_month >= '2024-03-01'", "region in ('A', 'Unknown') and skill <> 'x'", "municipality_code is null", "false"):
        for by in ([], ["skill"], ["region", "municipality"], ["publication_month"]):
            want = pairs.where(where).groupBy(*by).agg(F.count_distinct("id").alias("ads")) if by else None
            if want is not None:
                assert _rows(db.distinct_ads(bitmaps.where(where), by)) == _rows(want)
            elif where != "false":
                assert db.distinct_ads(bitmaps.where(where), [F.lit(1).alias("all")]).first().ads == pairs.where(where).select("id").distinct().count()


def test_ids_of_a_cell_lie_together(spark):
    pairs = spark.range(200_000).select(
        F.col("id").cast("string").alias("id"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("publication_month"), F.lit("r").alias("region"),
        F.lit("1").alias("region_code"), (F.col("id") % 20).cast("string").alias("municipality"), (F.col("id") % 20).cast("string").alias("municipality_code"), F.lit("s").alias("skill"))
    bitmaps = db.cell_bitmaps(pairs)
    assert bitmaps.count() <= 20 * 4  # 10,000 ids a cell: one or two buckets and a partition's edge
    assert db.distinct_ads(bitmaps, ["skill"]).first().ads == 200_000


def test_overlapping_windows(spark):
    pairs = _pairs(spark, 2000, 2)
    windows = spark.createDataFrame([("a", "2024-01-01", "2024-04-01"), ("b", "2024-03-01", "2024-06-01"), ("none", "2020-01-01", "2020-02-01")], "window string, first_month string, last_month string")
    got = db.window_distincts(db.cell_bitmaps(pairs), windows, ["region"])
    inside = pairs.join(windows, F.col("publication_month").between(F.col("first_month").cast("timestamp_ntz"), F.col("last_month").cast("timestamp_ntz")))
    assert _rows(got) == _rows(inside.groupBy("window", "region").agg(F.count_distinct("id").alias("ads")))


def test_null_ids_and_empty_input(spark):
    skills = spark.createDataFrame([(None, dt.datetime(2024, 1, 1), "x"), ("1", dt.datetime(2024, 1, 1), "x")], "id string, publication_month timestamp_ntz, skill string")
    places = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), "m", "c", "r", "rc", 1.0, 2.0)], "id string, publication_month timestamp_ntz, municipality string, municipality_code string, region string, region_code string, longitude double, latitude double")
    pairs = db.located_skills(skills, places)
    assert [tuple(r) for r in db.distinct_ads(db.cell_bitmaps(pairs), ["region"]).collect()] == [("r", 1)]
    assert db.distinct_ads(db.cell_bitmaps(pairs.limit(0)), ["region"]).collect() == []
