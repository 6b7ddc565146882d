"""Stages follow their input; marts read the compact tables; the build writes every table."""

from __future__ import annotations

import json
import shutil

from skillgrid.plans import build
from skillgrid.plans.registry import QUERIES

from .conftest import SF_SMALL
from .test_ingestion import _ad, _write_zip


def test_changed_input_gives_changed_results_in_one_session(spark, tmp_dir):
    sf = tmp_dir / "sf"
    sf.mkdir()
    for table in ("documents", "nation", "region"):
        shutil.copyfile(f"{SF_SMALL}/{table}.parquet", sf / f"{table}.parquet")
    before = QUERIES["regex_skills"](spark, str(sf)).count()
    rows = QUERIES["load_totals"](spark, str(sf)).first().rows
    fewer = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 20")
    fewer.coalesce(1).write.mode("overwrite").parquet(str(sf / "documents.parquet.new"))
    part = next((sf / "documents.parquet.new").glob("part-*.parquet"))
    shutil.copyfile(part, sf / "documents.parquet")
    after = QUERIES["regex_skills"](spark, str(sf)).count()
    assert 0 < after < before
    assert QUERIES["load_totals"](spark, str(sf)).first().rows < rows


def test_marts_do_not_read_headlines_or_snippets(spark):
    for name in ("monthly_counts", "trends", "geography"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "headline" not in plan and "description" not in plan


def test_build_writes_catalogue_csv_and_live_tables(spark, tmp_dir):
    raw, landed, wh = tmp_dir / "raw", tmp_dir / "landed", str(tmp_dir / "wh")
    raw.mkdir()
    landed.mkdir()
    _write_zip(raw / "2024.jsonl.zip", {"2024.jsonl": [json.dumps(_ad(i, 2024, "list")) for i in range(5)]})
    (landed / "r.json").write_text(json.dumps({"hits": [
        {"id": "a", "publication_date": "2024-05-01T00:00:00", "headline": "Python", "description": {"text": "sql"}}]}))
    build.run(spark, str(raw), wh)
    live = build.build_live_sample(spark, str(landed), wh)
    assert sorted(r.skill for r in live["job_skills"].collect()) == ["python", "sql"]
    catalogue = spark.read.parquet(f"{wh}/ams_skill_catalogue").collect()
    assert [(r.skill, r.ads, r.mentions) for r in catalogue] == [("Python", 5, 5)]
    (csv,) = (tmp_dir / "wh" / "ams_skill_catalogue_csv").glob("part-*.csv")
    assert csv.read_text().splitlines() == ["skill,ads,mentions", "Python,5,5"]
