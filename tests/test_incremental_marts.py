"""Marts after replaced archives equal a full rebuild, also for ids in several archives."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skillgrid.operators import extract, marts
from skillgrid.operators import incremental_marts as im

from .conftest import SF_SMALL

ADS = (
    "id string, publication_month timestamp_ntz, headline string, description_text string, municipality string, municipality_code string, "
    "region string, region_code string, longitude double, latitude double, source_archive string"
)


def _ads(rng, archive, n):
    out = []
    for _ in range(n):
        place = rng.choice([("Lund", "1281", "Skåne", "12", 13.25, 55.75), ("Umeå", None, None, None, 20.5, 63.75), ("Nowhere", "9", "x", "y", 99.0, 10.0), (None,) * 6])
        month = rng.choice([None, dt.datetime(2023, 1, 1), dt.datetime(2023, 2, 1), dt.datetime(2024, 7, 1)])
        head = " ".join(rng.sample(["Python", "python", "py", "sql", "T-SQL", "Rust", "aws", "nothing", "Scala"], 3))
        out.append((rng.choice([None, *map(str, range(12))]), month, head, rng.choice([None, "SQL", ""]), *place, archive))
    return out


def _rows(df):
    return sorted((tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def _check(spark, made, ads):
    """The incremental marts equal those of the plain operators over all ads."""
    matches = extract.regex_skill_matches(ads)
    skills = extract.regex_skills(matches)
    counts = marts.monthly_skill_counts(skills, one_row_per_id_skill=True)
    trends = marts.skill_trends(counts, ads)
    geography = marts.skill_geography(skills, ads, one_row_per_id_skill=True)
    states = made.marts()
    assert _rows(im.best_matches(made.states())) == _rows(matches)
    assert _rows(im.monthly_skill_counts(states)) == _rows(counts)
    assert _rows(im.skill_trends(states)) == _rows(trends)
    assert _rows(im.skill_geography(states).select(*geography.columns)) == _rows(geography)


@pytest.mark.parametrize("seed", [1, 2])
def test_replaced_added_and_emptied_archives(spark, tmp_dir, seed):
    rng = random.Random(seed)
    held = {a: _ads(rng, a, 25) for a in ("a", "b", "c")}
    frame = lambda rows: spark.createDataFrame(rows, ADS)
    made = im.IncrementalMarts(spark, str(tmp_dir / "marts"))
    made.build(frame([r for rows in held.values() for r in rows]))
    _check(spark, made, frame([r for rows in held.values() for r in rows]))
    for archive, n in (("b", 30), ("d", 10), ("a", 0)):
        held[archive] = _ads(rng, archive, n)
        made.replace(frame(held[archive]), archive)
        _check(spark, made, frame([r for rows in held.values() for r in rows]))


def test_marts_behind_the_states_are_summed_anew(spark, tmp_dir):
    rng = random.Random(5)
    frame = lambda rows: spark.createDataFrame(rows, ADS)
    a, b, c = (_ads(rng, x, 20) for x in "abc")
    made = im.IncrementalMarts(spark, str(tmp_dir / "marts"))
    made.build(frame(a + b))
    # a job that ends between the states' publication and the marts'
    for name, df in im.archive_states(frame(c)).items():
        made.tables[name].stage(df, ["c"]).publish()
    newer = _ads(rng, "b", 15)
    made.replace(frame(newer), "b")
    _check(spark, made, frame(a + newer + c))


def test_only_the_new_archive_is_read_as_text(spark, tmp_dir):
    rng = random.Random(6)
    made = im.IncrementalMarts(spark, str(tmp_dir / "marts"))
    made.build(spark.createDataFrame(_ads(rng, "a", 9) + _ads(rng, "b", 9), ADS))
    before = made.states()
    ids = before["months"].where("source_archive = 'a'").select("id").distinct()
    plan = im.updated(made.marts(), im.contributions(im.of_ids(before, ids)), im.contributions(im.of_ids(before, ids)))
    text = " ".join(df._jdf.queryExecution().toString() for df in plan.values())
    assert "description_text" not in text and "BroadcastNestedLoop" not in text


def test_given_tables(spark, tmp_dir):
    from skillgrid.plans.warehouse import warehouse

    ads = warehouse(spark, SF_SMALL).ads()
    made = im.IncrementalMarts(spark, str(tmp_dir / "marts"))
    made.build(ads)
    newer = ads.where("source_archive = 'src3'").withColumn("headline", F.lit("Rust and Go"))
    made.replace(newer, "src3")
    _check(spark, made, ads.where("source_archive <> 'src3'").unionByName(newer))


def test_contributions_carry_no_texts(spark, tmp_dir):
    frame = spark.createDataFrame(_ads(random.Random(7), "a", 20), ADS)
    made = im.IncrementalMarts(spark, str(tmp_dir / "marts"))
    made.build(frame)
    for df in im.contributions(made.states()).values():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "best.headline" not in plan and "description_snippet" not in plan.split("Relation")[0]
