"""Exploration queries: date window, membership, growth, pivot, KPIs, geo summary, map."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skillgrid.operators import explore

M = [dt.datetime(2024, m, 1) for m in (1, 2, 3)]
SCHEMA = "publication_month timestamp_ntz, skill string, mentions long, ads long, share_of_ads double"


def _trends(spark):
    rows = [
        (M[0], "python", 10, 100, 0.10),
        (M[0], "sql", 5, 100, 0.05),
        (M[0], "gone", 9, 100, 0.09),
        (M[1], "python", 20, 100, 0.20),
        (M[2], "python", 30, 100, 0.30),
        (M[2], "sql", 1, 100, 0.01),
        (M[2], "rust", 30, 100, 0.30),
        (M[2], "new", 3, 100, 0.03),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_window_and_membership(spark):
    t = _trends(spark)
    assert explore.filter_months(t, "2024-01-15", "2024-03-01").select("publication_month").distinct().count() == 2
    assert explore.filter_months(t, "2024-01-01", "2024-01-31").count() == 3
    assert explore.filter_skills(t, []).count() == 0
    assert explore.trend_filter(t, "2024-01-01", "2024-12-31", ["sql"]).count() == 2


def test_growth_and_decline(spark):
    t = _trends(spark)
    up = [(r.skill, r.change) for r in explore.growth(t, "mentions", 10).collect()]
    assert up == [("python", 20), ("sql", -4)]  # skills missing at an end vanish
    down = [r.skill for r in explore.growth(t, "mentions", 1, ascending=True).collect()]
    assert down == ["sql"]


def test_top_n_month_ties_and_kpis(spark):
    t = _trends(spark)
    top = [r.skill for r in explore.top_n_month(t, "mentions", 2).collect()]
    assert top == ["python", "rust"]  # tie on 30 broken by skill
    k = explore.kpis(t, "share_of_ads").collect()[0]
    assert (k.skills, k.months, k.latest_ads, k.top_skill) == (5, 3, 100, "python")


def test_pivot_missing_cell_is_null(spark):
    p = {r.publication_month: r for r in explore.trend_pivot(_trends(spark), ["python", "sql"], "mentions").collect()}
    assert p[M[1]]["sql"] is None and p[M[2]]["python"] == 30


def test_totals_months_detail(spark):
    t = _trends(spark)
    assert [r.skill for r in explore.skill_totals(t).collect()][:2] == ["python", "rust"]
    assert [r.publication_month for r in explore.months(t).collect()] == M
    first = explore.detail_table(t, "mentions").first()
    assert (first.publication_month, first.skill) == (M[2], "python")
    assert [r.skill for r in explore.top_skills(t, 1).collect()] == ["python"]


def _geo(spark):
    rows = [
        (M[0], "python", "Lund", "1", "S", 13.0, 55.5, 2, 4, 0.5),
        (M[1], "python", "Lund", "1", "S", 13.0, 55.5, 1, 4, 0.25),
        (M[1], "python", "Umeå", "2", "V", 20.0, 63.5, 1, 1, 1.0),
        (M[1], "python", None, "3", "V", 20.0, 63.5, 1, 1, 1.0),
    ]
    return spark.createDataFrame(
        rows,
        "publication_month timestamp_ntz, skill string, municipality string, municipality_code string, "
        "region string, longitude double, latitude double, mentions long, ads long, share_of_ads double",
    )


def test_geo_summary_and_map(spark):
    s = {r.municipality: r for r in explore.geo_summary(_geo(spark), "2024-01-01", "2024-12-31", ["python"]).collect()}
    assert set(s) == {"Lund", "Umeå"}  # NULL key dropped
    assert (s["Lund"].mentions, s["Lund"].ads, s["Lund"].share_of_ads) == (3, 4, 0.375)
    pts = {r.municipality: r.radius for r in explore.map_points(
        explore.geo_summary(_geo(spark), "2024-01-01", "2024-12-31", ["python"]), "share_of_ads").collect()}
    assert pts["Umeå"] == 3000 + 35000 and pts["Lund"] == 3000 + 0.375 * 35000
    zero = explore.geo_summary(_geo(spark), "2024-01-01", "2024-12-31", ["python"]).withColumn("mentions", F.lit(0))
    assert explore.map_points(zero, "mentions").count() == 0
