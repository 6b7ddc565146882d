"""The landing stream: files changed in place, rejected lines, replays."""

from __future__ import annotations

import json
import os

from skillgrid.sources import archives
from skillgrid.streaming import landing as ls

from .test_ingestion import _ad


def _put(folder, name, ads, more=(), at=None):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([*(json.dumps(a) for a in ads), *more, " ", ""]))
    if at:
        os.utime(folder / name, (at, at))


def _state(spark, table, rejects):
    ads = sorted((r.source_archive[:4], r.id or "") for r in archives.read_ads_table(spark, table).collect())
    bad = sorted((r.source_archive[:4], r.line) for r in ls.rejects_table(spark, rejects).read().collect())
    return ads, bad


def test_files_changed_in_place_and_rejects(spark, tmp_dir):
    landing, table, rejects, state = tmp_dir / "landing", str(tmp_dir / "ads"), str(tmp_dir / "rejects"), str(tmp_dir / "state")
    run = lambda: ls.start_landing_stream(spark, str(landing), table, rejects, state).awaitTermination(120)
    _put(landing, "2023.jsonl", [_ad(1, 2023, "list"), _ad(2, 2023, "list")], ["{bad", "[1, 2]", "17"], at=1_700_000_000)
    _put(landing, "2024.jsonl", [_ad(3, 2024, "struct")], at=1_700_000_000)
    run()
    ads, bad = _state(spark, table, rejects)
    assert ads == [("2023", ""), ("2023", ""), ("2023", ""), ("2023", "1"), ("2023", "2"), ("2024", "3")]
    assert bad == [("2023", "17"), ("2023", "[1, 2]"), ("2023", "{bad")]
    versions = archives.ads_table(spark, table).versions()
    run()  # nothing new
    assert archives.ads_table(spark, table).versions() == versions and _state(spark, table, rejects) == (ads, bad)
    # the same path, other content: logged by length and time, its rejects replaced with it
    _put(landing, "2023.jsonl", [_ad(9, 2023, "list")], at=1_700_000_100)
    run()
    assert _state(spark, table, rejects) == ([("2023", "9"), ("2024", "3")], [])
    # the same length, only the time differs
    _put(landing, "2023.jsonl", [_ad(8, 2023, "list")], at=1_700_000_200)
    run()
    assert _state(spark, table, rejects)[0] == [("2023", "8"), ("2024", "3")]


def test_replayed_batch_changes_nothing(spark, tmp_dir):
    landing, table, rejects = tmp_dir / "landing", str(tmp_dir / "ads"), str(tmp_dir / "rejects")
    _put(landing, "2023.jsonl", [_ad(1, 2023, "list")], ["{bad"])
    log = str(tmp_dir / "log")
    assert ls.log_deliveries(spark, str(landing), log) == 1 and ls.log_deliveries(spark, str(landing), log) == 0
    batch, write = spark.read.parquet(log), ls._load(table, rejects, "s")
    write(batch, 0)
    first = _state(spark, table, rejects)
    write(batch, 0)
    assert _state(spark, table, rejects) == first == ([("2023", ""), ("2023", "1")], [("2023", "{bad")])
    assert archives.ads_table(spark, table).versions() == [1] and ls.rejects_table(spark, rejects).versions() == [1]


def test_newest_delivery_of_an_archive_counts(spark, tmp_dir):
    table, rejects, state = str(tmp_dir / "ads"), str(tmp_dir / "rejects"), str(tmp_dir / "state")
    for delivery, ident, at in (("d1", 1, 1_700_000_300), ("d2", 2, 1_700_000_100)):
        (tmp_dir / "landing").mkdir(exist_ok=True)
        _put(tmp_dir / "landing" / delivery, "2023.jsonl", [_ad(ident, 2023, "list")], at=at)
    ls.start_landing_stream(spark, f"{tmp_dir}/landing/*", table, rejects, state).awaitTermination(120)
    assert _state(spark, table, rejects) == ([("2023", "1")], [])
