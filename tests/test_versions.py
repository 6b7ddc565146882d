"""Versioned tables: nothing is lost by damaged archives, ended jobs, concurrent readers and writers."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from skillgrid.sources import archives
from skillgrid.sources.versions import VersionedTable, _part_of, part_folder
from skillgrid.streaming.incremental import start_archive_stream

from .test_ingestion import _ad, _write_zip


def _zip(raw, year, ids):
    _write_zip(raw / f"{year}.jsonl.zip", {f"{year}.jsonl": [json.dumps(_ad(i, year, "list")) for i in ids]})


def _ids(df):
    return sorted((r.source_archive[:4], r.id) for r in df.select("source_archive", "id").collect())


@pytest.fixture()
def loaded(spark, tmp_dir):
    raw, table = tmp_dir / "raw", str(tmp_dir / "ads")
    raw.mkdir()
    _zip(raw, 2022, range(3))
    _zip(raw, 2024, range(10, 15))
    archives.load_archives(spark, str(raw), table)
    return raw, table


@pytest.mark.parametrize("append", [True, False])
def test_damaged_archive_loses_nothing(spark, loaded, append):
    raw, table = loaded
    before = _ids(archives.read_ads_table(spark, table))
    good = (raw / "2024.jsonl.zip").read_bytes()
    _zip(raw, 2022, [7])  # a sound new delivery beside the damaged one
    for damaged in (good[: len(good) // 2], b"no zip", good[:60] + bytes(40) + good[100:]):
        (raw / "2024.jsonl.zip").write_bytes(damaged)
        with pytest.raises(Exception, match="(?i)zip|crc|decompress|error"):
            archives.load_archives(spark, str(raw), table, append=append)
        assert _ids(archives.read_ads_table(spark, table)) == before
    assert archives.ads_table(spark, table).versions() == [1]
    (raw / "2024.jsonl.zip").write_bytes(good)
    archives.load_archives(spark, str(raw), table, append=append)
    assert _ids(archives.read_ads_table(spark, table)) == [("2022", "7"), *[("2024", str(i)) for i in range(10, 15)]]


def test_a_failing_batch_of_the_stream_loses_nothing(spark, tmp_dir, monkeypatch):
    landing, table, ckpt = tmp_dir / "landing", str(tmp_dir / "ads"), str(tmp_dir / "ckpt")
    landing.mkdir()
    (landing / "2023.jsonl").write_text(json.dumps(_ad(1, 2023, "list")) + "\n")
    start_archive_stream(spark, str(landing), table, checkpoint=ckpt).awaitTermination(120)
    (landing / "2024.jsonl").write_text(json.dumps(_ad(2, 2024, "list")) + "\n")
    monkeypatch.setattr(archives, "flatten_ads", lambda parsed: parsed.select(F.raise_error(F.lit("lost executor")).alias("id")))
    with pytest.raises(Exception, match="(?i)stream|lost"):
        start_archive_stream(spark, str(landing), table, checkpoint=ckpt).awaitTermination(120)
    assert _ids(archives.read_ads_table(spark, table)) == [("2023", "1")]
    monkeypatch.undo()
    start_archive_stream(spark, str(landing), table, checkpoint=ckpt).awaitTermination(120)
    assert _ids(archives.read_ads_table(spark, table)) == [("2023", "1"), ("2024", "2")]


def test_replayed_batch_publishes_nothing_new(spark, loaded):
    _, table = loaded
    ads = archives.read_ads_table(spark, table).where("source_archive like '2022%'")
    archives.replace_archives(ads, table, {"stream": "4"})
    versions = archives.ads_table(spark, table).versions()
    archives.replace_archives(ads, table, {"stream": "4"})
    assert archives.ads_table(spark, table).versions() == versions
    assert len(_ids(archives.read_ads_table(spark, table))) == 8


def test_ended_job_and_concurrent_reader(spark, loaded):
    raw, table = loaded
    reader = archives.read_ads_table(spark, table)  # resolved now, run later
    _zip(raw, 2024, [99])
    staged = archives.stage_archives(spark, str(raw), table, [2024])
    # The job ends before it publishes: nobody sees its files, but it could still look at the outcome.
    assert len(_ids(archives.read_ads_table(spark, table))) == 8
    assert _ids(staged.view()) == [("2022", "0"), ("2022", "1"), ("2022", "2"), ("2024", "99")]
    assert _ids(staged.rows()) == [("2024", "99")]
    archives.load_archives(spark, str(raw), table, years=[2024], append=True)
    assert len(_ids(reader)) == 8  # the old version's files are still whole
    assert _ids(archives.read_ads_table(spark, table))[-1] == ("2024", "99")
    assert len(_ids(archives.read_ads_table(spark, table, version=1))) == 8
    staged.discard()
    assert len(_ids(archives.read_ads_table(spark, table))) == 4


def test_two_writers_and_lost_race(spark, tmp_dir):
    table = VersionedTable(spark, str(tmp_dir / "t"), "part")
    frame = lambda p, v: spark.createDataFrame([(v, p)], "v int, part string")
    table.stage(frame("a", 1)).publish()
    one, two = table.stage(frame("b", 2)), table.stage(frame("a", 3))
    assert table._put_if_absent("_manifests/000000000001.json", "{}") is False  # taken: never overwritten
    assert (one.publish(), two.publish()) == (2, 3)
    assert sorted(map(tuple, table.read().collect())) == [(2, "b"), (3, "a")]
    history = sorted((r.part, r.version, r.current) for r in table.history().collect())
    assert history == [("a", 1, False), ("a", 3, True), ("b", 2, True)]
    with pytest.raises(ValueError, match="no version 9"):
        table.read(9)


def test_odd_part_names_empty_parts_and_vacuum(spark, tmp_dir):
    names = ["a=b/c%20 d", "ä:*?", "007", "1e3", None, "x"]
    assert [_part_of(part_folder("part", n)) for n in names] == names
    table = VersionedTable(spark, str(tmp_dir / "t"), "part")
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "v int, part string")
    table.stage(rows).publish()
    assert sorted(map(tuple, table.read().collect())) == sorted((i, n) for i, n in enumerate(names))
    table.stage(rows.limit(0), ["x", "new"]).publish()
    assert sorted(r.v for r in table.read().collect()) == [0, 1, 2, 3, 4]
    counts = {(r.part, r.version): (r.rows, r.current) for r in table.part_versions().collect()}
    assert counts[("x", 1)] == (1, False) and counts[("x", 2)] == (0, True) and counts[("new", 2)] == (0, True)
    assert counts[(None, 1)] == (1, True) and counts[("007", 1)] == (1, True)
    table.stage(rows).publish(whole=True)
    lost = table.stage(rows)
    assert table.vacuum(keep=1) == []  # nothing is old enough
    gone = table.vacuum(keep=1, older_than_seconds=0)
    assert len(gone) == 3 and lost.folder in gone and table.versions() == [3]
    assert table.read().count() == 6
    table.stage(rows.limit(0), names).publish(whole=True)
    assert table.read().collect() == [] and table.read().columns == ["v", "part"]


def test_plain_partition_folders_are_taken_over(spark, tmp_dir):
    path = str(tmp_dir / "plain")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "007")], "v int, part string")
    rows.write.partitionBy("part").parquet(path)
    table = VersionedTable(spark, path, "part")
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b"), (3, "007")]
    table.stage(spark.createDataFrame([(9, "b")], "v int, part string")).publish()
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (3, "007"), (9, "b")]
    assert {(r.part, r.version): r.rows for r in table.part_versions().collect()} == {("a", 0): 1, ("007", 0): 1, ("b", 1): 1}
    other = tmp_dir / "other"
    other.mkdir()
    (other / "file.txt").write_text("mine")
    with pytest.raises(ValueError, match="no table"):
        VersionedTable(spark, str(other), "part").stage(rows).publish()
