"""Alias bits stored with the ads: all extractions find the rows that they find without."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skillgrid.functions.regex import literal_anchor
from skillgrid.functions.taxonomy import pattern_rows
from skillgrid.operators import extract

from .test_regex_dialects import _texts

ADS = "id string, publication_date timestamp_ntz, publication_month timestamp_ntz, headline string, description_text string"


@pytest.fixture(scope="module")
def ads(spark):
    day = dt.datetime(2024, 5, 1)
    texts = _texts()
    rows = [(str(i), day, day, t if i % 3 else None, texts[-i] if i % 2 else None) for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None), ("e", day, day, "", ""), ("long", day, day, "x " * 50_000 + "scala", "İı ſpark"), ("1", day, day, "python", "python")]
    return spark.createDataFrame(rows, ADS).repartition(8)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("dialect", ["re2", "python"])
def test_every_extraction_is_unchanged(ads, dialect):
    marked = extract.with_alias_bits(ads)
    assert marked.columns == [*ads.columns, *extract.ALIAS_BITS]
    assert _rows(extract.found_skill_matches(marked, dialect=dialect)) == _rows(extract.found_skill_matches(ads, dialect=dialect))
    assert _rows(extract.skill_matches(marked, dialect=dialect)) == _rows(extract.skill_matches(ads, dialect=dialect))
    lists = lambda df: _rows(extract.job_skill_lists(df, dialect=dialect, description_col="description_text"))
    assert lists(marked) == lists(ads)


def test_own_taxonomy_does_not_use_the_bits(ads):
    taxonomy = {"zzz": ["zzz"], "day": [r"\bdaily\b"]}
    marked = extract.with_alias_bits(ads)
    assert _rows(extract.found_skill_matches(marked, taxonomy)) == _rows(extract.found_skill_matches(ads, taxonomy)) != []


def test_bits_are_the_anchors_found(ads):
    anchors = [[literal_anchor(p) for _, _, p in pattern_rows(None, d)] for d in ("re2", "python")]
    folded = extract.with_search_columns(extract.with_alias_bits(ads), "headline", "description_text", "python")
    for r in folded.where("id in ('5', '700', '1200', 'long', 'e') or id is null").collect():
        bits = (r.alias_bits_0 & (1 << 64) - 1) | (r.alias_bits_1 & (1 << 64) - 1) << 64
        want = sum(1 << i for i, pair in enumerate(zip(*anchors, strict=True)) if any(a is None or a in r._folded for a in pair))
        assert bits == want


def test_extraction_over_bits_has_no_substring_scan(ads):
    marked = extract.with_alias_bits(ads)
    marked.write.mode("overwrite").format("noop").save()
    read = ads.withColumns({c: F.lit(0).cast("long") for c in extract.ALIAS_BITS})
    plan = extract.found_skill_matches(read)._jdf.queryExecution().analyzed().toString()
    assert "Contains(" not in plan and "contains(" not in plan.lower()
    assert extract.found_skill_matches(read).collect() == []
