"""Archive ingestion: zip reading, both schema shapes, malformed lines, replace-by-archive."""

from __future__ import annotations

import datetime as dt
import json
import zipfile
from pathlib import Path

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from skillgrid.operators import extract, marts
from skillgrid.sources import archives, live, sinks
from skillgrid.streaming.incremental import start_archive_stream


def _ad(i: int, year: int, occupation_shape: str, headline: str = "Python developer") -> dict:
    occ = {"label": f"occ{i}"}
    return {
        "id": str(i),
        "publication_date": f"{year}-03-0{1 + i % 9}T10:00:00",
        "headline": headline,
        "description": {"text": f"Ad {i} with SQL"},
        "occupation": occ if occupation_shape == "struct" else [occ, {"label": "second"}],
        "occupation_group": {"label": "grp"} if occupation_shape == "struct" else [{"label": "grp"}],
        "occupation_field": {"label": "fld"} if occupation_shape == "struct" else [],
        "must_have": {"skills": [{"label": "Python", "weight": 1}, {"label": None}]},
        "nice_to_have": {"skills": []},
        "workplace_address": {
            "municipality": "Lund",
            "municipality_code": "1281",
            "region": "Skåne",
            "region_code": 12,
            "postcode": "22100",
            "city": "Lund",
            "coordinates": [13.25, 55.75] if i % 2 else None,
        },
    }


def _write_zip(path: Path, members: dict[str, list[str]]) -> None:
    with zipfile.ZipFile(path, "w") as z:
        for name, lines in members.items():
            z.writestr(name, "\n".join(lines) + "\n")


@pytest.fixture()
def raw_dir(tmp_dir):
    raw = tmp_dir / "raw"
    raw.mkdir()
    y22 = [json.dumps(_ad(i, 2022, "struct")) for i in range(1, 4)] + ["{bad json"]
    y24 = [json.dumps(_ad(i, 2024, "list")) for i in range(3, 6)]  # id 3 in both archives
    _write_zip(raw / "2022.jsonl.zip", {"2022.jsonl": y22})
    _write_zip(raw / "2024.jsonl.zip", {"data/2024.jsonl": y24})
    return raw


def test_discovery_errors(spark, raw_dir, tmp_dir):
    assert [Path(p).name for p in archives.archive_paths(spark, raw_dir)] == ["2022.jsonl.zip", "2024.jsonl.zip"]
    assert len(archives.archive_paths(spark, raw_dir, [2024])) == 1
    with pytest.raises(FileNotFoundError, match=r"\[2023\]"):
        archives.archive_paths(spark, raw_dir, [2023, 2024])
    empty = tmp_dir / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        archives.archive_paths(spark, empty)


def test_full_load_both_shapes(spark, raw_dir, tmp_dir):
    table = str(tmp_dir / "ads")
    ads = archives.load_archives(spark, str(raw_dir), table)
    rows = ads.collect()
    assert len(rows) == 7  # 3 + malformed + 3
    by = {(r.id, r.source_archive): r for r in rows}
    r22 = by[("1", "2022.jsonl.zip")]
    assert (r22.occupation, r22.occupation_group, r22.occupation_field) == ("occ1", "grp", "fld")
    assert r22.publication_date == dt.datetime(2022, 3, 2, 10) and r22.publication_month == dt.datetime(2022, 3, 1)
    assert (r22.longitude, r22.latitude, r22.region_code) == (13.25, 55.75, "12")
    r24 = by[("4", "2024.jsonl.zip")]
    assert (r24.occupation, r24.occupation_field, r24.longitude) == ("occ4", None, None)
    assert r24.source_year == 2024 and r24.description_text == "Ad 4 with SQL"
    bad = [r for r in rows if r.id is None]
    assert len(bad) == 1 and bad[0].source_archive == "2022.jsonl.zip" and bad[0].headline is None
    assert archives.rejects(ads).count() == 1
    totals = marts.load_totals(ads).collect()[0]
    assert (totals.rows, totals.distinct_ads) == (7, 5)
    labels = sorted(r.skill for r in extract.ams_skills(ads).collect())
    assert labels == ["Python"] * 6


def test_two_members_fail(spark, tmp_dir):
    raw = tmp_dir / "raw2"
    raw.mkdir()
    _write_zip(raw / "2023.jsonl.zip", {"a.jsonl": ["{}"], "b.jsonl": ["{}"]})
    with pytest.raises(PythonException, match="must hold one .jsonl member"):
        archives.read_archive_lines(spark, archives.archive_paths(spark, raw)).collect()


def test_replace_by_archive_is_idempotent(spark, raw_dir, tmp_dir):
    table = str(tmp_dir / "ads")
    archives.load_archives(spark, str(raw_dir), table)
    # the 2024 archive is re-delivered with one ad and a new headline
    _write_zip(raw_dir / "2024.jsonl.zip", {"2024.jsonl": [json.dumps(_ad(9, 2024, "list", "Rust"))]})
    for _ in range(2):
        ads = archives.load_archives(spark, str(raw_dir), table, years=[2024], append=True)
        got = sorted((r.source_archive, r.id) for r in ads.where(F.col("id").isNotNull()).collect())
        assert got == [("2022.jsonl.zip", "1"), ("2022.jsonl.zip", "2"), ("2022.jsonl.zip", "3"), ("2024.jsonl.zip", "9")]
    # an archive reloaded empty loses its rows
    _write_zip(raw_dir / "2024.jsonl.zip", {"2024.jsonl": []})
    ads = archives.load_archives(spark, str(raw_dir), table, years=[2024], append=True)
    assert ads.where(F.col("source_archive") == "2024.jsonl.zip").count() == 0
    assert ads.count() == 4


def test_csv_export(spark, tmp_dir):
    df = spark.createDataFrame([("python", 2, 3), ("sql", 1, 1)], "skill string, ads long, mentions long")
    out = str(tmp_dir / "catalogue")
    sinks.export_csv(df.orderBy(F.desc("ads")), out, single_file=True)
    parts = sorted(Path(out).glob("part-*.csv"))
    assert len(parts) == 1
    assert parts[0].read_text().splitlines() == ["skill,ads,mentions", "python,2,3", "sql,1,1"]


def test_live_sample_flatten_and_skill_lists(spark, tmp_dir):
    landing = tmp_dir / "responses"
    landing.mkdir()
    hits = [
        {"id": "a1", "publication_date": "2024-05-01T00:00:00", "headline": "Python & Docker",
         "description": {"text": "Kubernetes, k8s"}},
        {"id": "a2", "publication_date": "2024-05-02T00:00:00", "headline": None, "description": {"text": None}},
        {"id": "a3", "publication_date": "2024-05-03T00:00:00", "headline": "x", "description": {"text": "y"}},
    ]
    (landing / "r1.json").write_text(json.dumps({"total": 3, "hits": hits}))
    ads = live.landed_hits(spark, str(landing))
    assert {"id", "headline", "description__text", "publication_date"} <= set(ads.columns)
    lists = {r.id: r.skills for r in extract.job_skill_lists(ads).collect()}
    assert lists == {"a1": ["docker", "kubernetes", "python"], "a2": [], "a3": []}
    (landing / "r0.json").write_text(json.dumps({"hits": [hits[0] | {"id": f"b{i}"} for i in range(150)]}))
    assert live.landed_hits(spark, str(landing)).count() == 153  # nothing is dropped unless asked for
    assert [r.id for r in live.landed_hits(spark, str(landing), limit=152).collect()][-2:] == ["a1", "a2"]


def test_archive_stream_available_now(spark, tmp_dir):
    landing, table = tmp_dir / "landing", str(tmp_dir / "stream_ads")
    landing.mkdir()
    (landing / "2023.jsonl").write_text("\n".join(json.dumps(_ad(i, 2023, "list")) for i in range(3)) + "\n")
    ckpt = str(tmp_dir / "ckpt")
    start_archive_stream(spark, str(landing), table, checkpoint=ckpt).awaitTermination(120)
    first = archives.read_ads_table(spark, table).collect()
    assert sorted(r.id for r in first) == ["0", "1", "2"]
    assert {(r.source_archive, r.source_year) for r in first} == {("2023.jsonl.zip", 2023)}
    (landing / "2024.jsonl").write_text(json.dumps(_ad(7, 2024, "struct")) + "\n")
    start_archive_stream(spark, str(landing), table, checkpoint=ckpt).awaitTermination(120)
    second = archives.read_ads_table(spark, table)
    assert sorted(r.id for r in second.collect()) == ["0", "1", "2", "7"]


def test_stream_takes_a_new_delivery_for_the_old_one(spark, tmp_dir):
    landing, table, ckpt = tmp_dir / "landing", str(tmp_dir / "stream_ads"), str(tmp_dir / "ckpt")
    for delivery, ids in (("d1", [1, 2]), ("d2", [3])):
        (landing / delivery).mkdir(parents=True)
        (landing / delivery / "2023.jsonl").write_text("\n".join(json.dumps(_ad(i, 2023, "list")) for i in ids) + "\n \n")
    start_archive_stream(spark, f"{landing}/*", table, checkpoint=ckpt).awaitTermination(120)
    assert [r.id for r in archives.read_ads_table(spark, table).collect()] == ["3"]
    (landing / "d3").mkdir()
    (landing / "d3" / "2023.jsonl").write_text(json.dumps(_ad(4, 2023, "list")) + "\n")
    start_archive_stream(spark, f"{landing}/*", table, checkpoint=ckpt).awaitTermination(120)
    assert [r.id for r in archives.read_ads_table(spark, table).collect()] == ["4"]
    # the batch load of the same year replaces it, too
    raw = tmp_dir / "raw_year"
    raw.mkdir()
    _write_zip(raw / "2023.jsonl.zip", {"2023.jsonl": [json.dumps(_ad(5, 2023, "list"))]})
    ads = archives.load_archives(spark, str(raw), table, append=True)
    assert [r.id for r in ads.collect()] == ["5"]


def test_append_to_a_damaged_table_raises_and_loses_nothing(spark, raw_dir, tmp_dir):
    table = tmp_dir / "ads"
    archives.load_archives(spark, str(raw_dir), str(table))
    files = {p: p.read_bytes() for p in sorted(table.rglob("part-*.parquet"))}
    victim = next(p for p in files if "2022" in str(p))
    victim.write_bytes(b"damaged")
    for crc in table.rglob(".part-*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="(?i)parquet"):
        archives.load_archives(spark, str(raw_dir), str(table), years=[2024], append=True)
    victim.write_bytes(files[victim])
    assert {p: p.read_bytes() for p in sorted(table.rglob("part-*.parquet"))} == files


def test_one_task_per_archive(spark, tmp_dir):
    raw = tmp_dir / "many"
    raw.mkdir()
    for year in range(2001, 2013):
        _write_zip(raw / f"{year}.jsonl.zip", {"x.jsonl": [json.dumps(_ad(1, year, "list"))]})
    lines = archives.read_archive_lines(spark, archives.archive_paths(spark, raw))
    per_task = lines.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("source_archive").alias("n")).collect()
    assert len(per_task) == 12 and {r.n for r in per_task} == {1}


def test_dates_with_zones_and_blank_lines(spark, tmp_dir):
    dates = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05+0200", "2024-01-02T03:04:05.5+02:00", "2024-01-02T03:04:05", "2024-01-02", "soon", None]
    lines = [json.dumps({"id": str(i), "publication_date": d}) for i, d in enumerate(dates)]
    path = tmp_dir / "2024.jsonl"
    path.write_text("\n\n".join(lines) + "\n \t \n")
    raw = archives.read_jsonl_lines(spark, str(path), "2024.jsonl.zip", 2024)
    got = {r.id: r.publication_date for r in archives.parse_ad_lines(raw).collect()}
    day = dt.datetime(2024, 1, 2)
    at = lambda h, us=0: day.replace(hour=h, minute=4, second=5, microsecond=us)
    assert got == {"0": at(3), "1": at(1), "2": at(1, 500_000), "3": at(3), "4": day, "5": None, "6": None}
    assert archives.unreadable_dates(raw).count() == 1


def test_build_end_to_end(spark, raw_dir, tmp_dir):
    from skillgrid.plans import build

    wh = str(tmp_dir / "warehouse")
    with pytest.raises(RuntimeError, match="Load archives first"):
        build.build_skills(spark, wh)
    # the malformed line gives an all-NULL ad, which the not_null tests report
    with pytest.raises(AssertionError, match="historical_job_ads"):
        build.run(spark, str(raw_dir), wh)
    report = build.run(spark, str(raw_dir), wh, fail_on_test=False)
    failures = {(r.table_name, r.column_name): r.failures for r in report.collect() if r.failures}
    assert failures == {("historical_job_ads", "id"): 1, ("historical_job_ads", "publication_month"): 1}
    trends = spark.read.parquet(f"{wh}/mart_dashboard_skill_trends")
    got = {(r.publication_month.year, r.skill): r.mentions for r in trends.collect()}
    # id 3 is in both archives: one row per (id, skill) survives, at its earliest month
    assert got[(2022, "python")] == 3 and got[(2022, "sql")] == 3
    assert got[(2024, "python")] == 2 and got[(2024, "sql")] == 2


def test_dashboard_views_over_built_warehouse(spark, raw_dir, tmp_dir):
    from skillgrid.plans import build, report

    wh = str(tmp_dir / "warehouse")
    build.run(spark, str(raw_dir), wh, fail_on_test=False)
    views = report.from_warehouse(spark, wh, metric="mentions", top_n=5)
    assert set(views) == {
        "kpis", "trend_pivot", "top_n_month", "growth", "decline", "geo_summary", "map_points", "detail_table"
    }
    k = views["kpis"].first()
    assert (k.skills, k.months) == (2, 2)  # python and sql, March 2022 and March 2024
    assert sorted(views["trend_pivot"].columns) == ["publication_month", "python", "sql"]
    assert {r.skill for r in views["growth"].collect()} == {"python", "sql"}
    with pytest.raises(RuntimeError, match="Build the warehouse first"):
        report.from_warehouse(spark, str(tmp_dir / "missing"))


def test_plain_jsonl_is_a_splittable_scan(spark, tmp_dir):
    path = tmp_dir / "2025.jsonl"
    path.write_text("\n".join(json.dumps(_ad(i, 2025, "list")) for i in range(50)) + "\n{bad json\n")
    lines = archives.read_jsonl_lines(spark, str(path), "2025.jsonl", 2025)
    ads = archives.flatten_ads(archives.parse_ad_lines(lines))
    rows = ads.collect()
    assert len(rows) == 51 and sum(r.id is None for r in rows) == 1
    assert {r.source_archive for r in rows} == {"2025.jsonl"} and {r.source_year for r in rows} == {2025}
    assert "FileScan text" in ads._jdf.queryExecution().executedPlan().toString()


def test_build_reports(spark, raw_dir, tmp_dir):
    from skillgrid.plans import build

    wh = str(tmp_dir / "warehouse")
    build.run(spark, str(raw_dir), wh, fail_on_test=False)
    views = build.reports(build.build_skills_tables(spark, wh))
    got = {k: v.count() for k, v in views.items()}
    assert got["archive validation"] == 2 and got["load totals"] == 1 and got["skill sources"] == 2
    top = [(r.skill, r.mentions) for r in views["top regex skills"].collect()]
    assert top == [("python", 5), ("sql", 5)]  # ids 1-5; id 3 is in both archives, kept once
