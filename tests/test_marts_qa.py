"""Marts (trends, geography, reports) and the data-test suite on good and broken data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skillgrid.operators import marts, qa

M1 = dt.datetime(2024, 1, 1)
M2 = dt.datetime(2024, 2, 1)
ADS = (
    "id string, publication_date timestamp_ntz, publication_month timestamp_ntz, municipality string, "
    "municipality_code string, region string, region_code string, longitude double, latitude double, "
    "source_archive string"
)


def _ads(spark):
    rows = [
        ("1", M1, M1, "Lund", "1281", "Skåne", "12", 13.25, 55.75, "a"),
        ("2", M1, M1, "Lund", "1281", None, None, 13.25, 55.75, "a"),
        ("3", M1, M1, "Oslo", "0301", "X", "9", 10.75, 59.5, "a"),  # inside bounds
        ("4", M1, M1, "Far", "9999", "Y", "8", 30.0, 60.0, "b"),  # outside bounds
        ("5", M1, M1, None, "1281", "Skåne", "12", 13.25, 55.75, "b"),  # no municipality
        ("6", M2, M2, "Lund", None, "Skåne", "12", 13.25, 55.75, "b"),  # NULL code
        ("6", M2, M2, "Lund", None, "Skåne", "12", 13.25, 55.75, "c"),  # same id, other archive
    ]
    return spark.createDataFrame(rows, ADS)


def _skills(spark):
    rows = [("1", M1, "python"), ("2", M1, "python"), ("3", M1, "python"), ("4", M1, "python"),
            ("5", M1, "sql"), ("6", M2, "python")]
    return spark.createDataFrame(rows, "id string, publication_month timestamp_ntz, skill string").withColumn(
        "skill_source", F.lit("regex")
    )


def test_trends_share_of_ads(spark):
    counts = marts.monthly_skill_counts(_skills(spark))
    rows = {(r.publication_month, r.skill): r for r in marts.skill_trends(counts, _ads(spark)).collect()}
    assert rows[(M1, "python")].mentions == 4 and rows[(M1, "python")].ads == 5
    assert rows[(M1, "python")].share_of_ads == 4 / 5
    assert rows[(M2, "python")].ads == 1  # distinct ids, not rows


def test_geography_denominator_after_filter(spark):
    geo = {
        (r.publication_month, r.skill, r.municipality, r.municipality_code): r
        for r in marts.skill_geography(_skills(spark), _ads(spark)).collect()
    }
    # ads 1 and 2 are located in Lund/1281 (regions Skåne and NULL -> 'Unknown'),
    # so two groups, each 1 mention over a denominator of 2 located ads;
    # ad 5 has no municipality and is filtered out before the denominator.
    lund = sorted(
        (r.region, r.region_code, r.mentions, r.ads, r.share_of_ads)
        for r in marts.skill_geography(_skills(spark), _ads(spark)).collect()
        if r.municipality == "Lund" and r.municipality_code == "1281"
    )
    assert lund == [("Skåne", "12", 1, 2, 0.5), ("Unknown", "unknown", 1, 2, 0.5)]
    assert not any(k[2] == "Far" for k in geo)
    null_code = geo[(M2, "python", "Lund", None)]
    # left join on a NULL code finds no denominator; id 6 repeats in the month
    assert null_code.ads is None and null_code.share_of_ads is None and null_code.mentions == 1


def test_reports(spark):
    ads = _ads(spark)
    v = {r.source_archive: r for r in marts.archive_validation(ads).collect()}
    assert (v["b"].rows, v["b"].distinct_ads) == (3, 3)
    t = marts.load_totals(ads).collect()[0]
    assert (t.rows, t.distinct_ads, t.first_publication_date, t.last_publication_date) == (7, 6, M1, M2)
    ams = _skills(spark).withColumn("skill_source", F.lit("ams"))
    both = marts.all_skills(ams, _skills(spark))
    assert {r.skill_source: r.rows for r in marts.skill_sources(both).collect()} == {"ams": 6, "regex": 6}
    cat = {r.skill: (r.ads, r.mentions) for r in marts.ams_catalogue(ams).collect()}
    assert cat == {"python": (5, 5), "sql": (1, 1)}


def _trends(spark, shares):
    rows = [(M1, f"s{i}", 1, 2, s) for i, s in enumerate(shares)]
    return spark.createDataFrame(
        rows, "publication_month timestamp_ntz, skill string, mentions long, ads long, share_of_ads double"
    )


def _geo(spark, shares):
    return _trends(spark, shares).withColumn("municipality", F.lit("m")).withColumn(
        "municipality_code", F.lit("1")
    ).withColumn("region", F.lit("r"))


def test_share_violations_on_broken_marts(spark):
    assert qa.share_violations(_trends(spark, [0.5]), _geo(spark, [1.0])).count() == 0
    bad = qa.share_violations(_trends(spark, [1.5, -0.1, 0.2]), _geo(spark, [2.0]))
    assert sorted(r.mart for r in bad.collect()) == [
        "mart_dashboard_skill_trends",
        "mart_dashboard_skill_trends",
        "mart_skill_geography",
    ]


def test_not_empty_check(spark):
    assert qa.not_empty_check(_trends(spark, [0.1])).count() == 0
    empty = _trends(spark, [0.1]).where(F.lit(False))
    assert [r.failure for r in qa.not_empty_check(empty).collect()] == [1]


def test_quality_report_counts_failures(spark):
    good_ads = _ads(spark).withColumn("publication_month", F.col("publication_month"))
    skills = _skills(spark)
    ams = skills.withColumn("skill_source", F.when(F.col("id") == "1", "bogus").otherwise("ams"))
    broken_trends = _trends(spark, [1.5, None])
    tables = {
        "historical_job_ads": good_ads.unionByName(good_ads.limit(1).withColumn("id", F.lit(None).cast("string"))),
        "historical_job_skills": ams,
        "historical_regex_skills": skills,
        "monthly_skill_counts": marts.monthly_skill_counts(skills).where(F.lit(False)),
        "mart_dashboard_skill_trends": broken_trends,
        "mart_skill_geography": _geo(spark, [0.5]),
    }
    report = {(r.table_name, r.test_name, r.column_name): r.failures for r in qa.quality_report(tables).collect()}
    assert len(report) == 26
    assert report[("historical_job_ads", "not_null", "id")] == 1
    assert report[("historical_job_skills", "accepted_values", "skill_source")] == 1
    assert report[("monthly_skill_counts", "not_empty", None)] == 1
    assert report[("mart_dashboard_skill_trends", "share_bounds", "share_of_ads")] == 1
    assert report[("mart_dashboard_skill_trends", "not_null", "share_of_ads")] == 1
    assert report[("mart_skill_geography", "share_bounds", "share_of_ads")] == 0


def test_samples_keep_newest_twenty(spark):
    rows = [(str(i), dt.datetime(2024, 1 + i % 12, 1), "python", "Python", "h", "d") for i in range(60)]
    matches = spark.createDataFrame(
        rows,
        "id string, publication_month timestamp_ntz, skill string, matched_text string, "
        "headline string, description_snippet string",
    )
    got = qa.skill_samples(matches).collect()
    assert len(got) == 20
    # 5 rows per month: the newest 20 are Dec, Nov, Oct and Sep
    assert min(r.publication_month for r in got) == dt.datetime(2024, 9, 1)
    summary = qa.qa_summary(matches).collect()[0]
    assert (summary.ads, summary.matches, summary.matched_terms) == (60, 60, 1)


def test_geography_repeated_id_keeps_pair_semantics(spark):
    """An id repeated inside a month with two locations: the centroid is the
    mean over (skill, located ad) pairs, as the SQL join computes it."""
    rows = [
        ("9", M1, M1, "Lund", "1281", "Skåne", "12", 13.0, 56.0, "a"),
        ("9", M1, M1, "Lund", "1281", "Skåne", "12", 13.0, 56.0, "b"),
        ("9", M1, M1, "Lund", "1281", "Skåne", "12", 14.0, 57.0, "c"),
        ("8", M1, M1, "Lund", "1281", "Skåne", "12", 16.0, 60.0, "c"),
    ]
    ads = spark.createDataFrame(rows, ADS)
    skills = spark.createDataFrame(
        [("9", M1, "python"), ("8", M1, "python")], "id string, publication_month timestamp_ntz, skill string"
    )
    from skillgrid.operators import extract

    (g,) = marts.skill_geography(skills, ads).collect()
    # pairs: id 9 x 3 located rows + id 8 x 1 -> mean lon (13+13+14+16)/4
    assert (g.longitude, g.latitude, g.mentions, g.ads, g.share_of_ads) == (14.0, 57.25, 2, 2, 1.0)
    (f,) = marts.skill_geography(skills, ads, one_row_per_id_skill=True, dup_ids=extract.duplicate_ids(ads)).collect()
    assert tuple(f) == tuple(g)


def test_row_count_equals_distinct_ids_for_deduplicated_skills(spark):
    from skillgrid.operators import extract

    rows = [("7", M2, "Python", None), ("7", M1, "python, sql", None), ("8", M1, "SQL", None), ("9", M1, "Rust", "sql")]
    ads = spark.createDataFrame(rows, "id string, publication_month timestamp_ntz, headline string, description_text string")
    rs = extract.regex_skills(extract.regex_skill_matches(ads))
    exact = sorted(map(tuple, marts.monthly_skill_counts(rs).collect()))
    fast = sorted(map(tuple, marts.monthly_skill_counts(rs, one_row_per_id_skill=True).collect()))
    assert exact == fast
    loc = _ads(spark).union(spark.createDataFrame(
        [("9", M1, M1, "Lund", "1281", "Skåne", "12", 13.25, 55.75, "z")], ADS))
    g1 = sorted(map(tuple, marts.skill_geography(rs, loc).collect()), key=repr)
    g2 = sorted(map(tuple, marts.skill_geography(rs, loc, one_row_per_id_skill=True).collect()), key=repr)
    assert g1 == g2


def test_distinct_ads_with_duplicate_flags_equals_count_distinct(spark):
    from skillgrid.operators import extract

    rows = [("1", M1), ("2", M1), ("2", M1), ("2", M2), ("3", M2), (None, M1), (None, M2), (None, M2), ("4", M2)]
    for sample in (rows, [r for r in rows if r[0] is not None] + [(None, M1)]):
        ads = spark.createDataFrame(sample, "id string, publication_month timestamp_ntz")
        dups = extract.duplicate_ids(ads)
        exact = sorted(map(tuple, marts.distinct_ads(ads, ["publication_month"], "ads").collect()))
        fast = sorted(map(tuple, marts.distinct_ads(ads, ["publication_month"], "ads", dups).collect()))
        assert exact == fast


def test_null_ids_are_not_counted(spark):
    """Two ads that mention Python, one without an id: one ad, a share of 1."""
    from skillgrid.operators import extract

    schema = "id string, publication_month timestamp_ntz, headline string, description_text string"
    ads = spark.createDataFrame([("1", M1, "Python", None), (None, M1, "Python", None), (None, M2, "Rust", None)], schema)
    matches = extract.regex_skill_matches(ads)
    skills = extract.regex_skills(matches)
    for fast in (False, True):
        counts = marts.monthly_skill_counts(skills, one_row_per_id_skill=fast)
        assert {(r.publication_month, r.skill): r.mentions for r in counts.collect()} == {(M1, "python"): 1, (M2, "rust"): 0}
        dups = extract.duplicate_ids(ads) if fast else None
        trends = {(r.publication_month, r.skill): r for r in marts.skill_trends(counts, ads, dups).collect()}
        assert (trends[(M1, "python")].ads, trends[(M1, "python")].share_of_ads) == (1, 1.0)
        assert (trends[(M2, "rust")].ads, trends[(M2, "rust")].share_of_ads) == (0, None)
        qa_rows = {r.skill: (r.ads, r.matches) for r in qa.qa_summary(matches, one_row_per_id_skill=fast).collect()}
        assert qa_rows == {"python": (1, 2), "rust": (0, 1)}


def test_geography_joins_denominators_after_the_aggregate(spark):
    from skillgrid.operators import extract

    ads = _ads(spark)
    geo = marts.skill_geography(_skills(spark), ads, one_row_per_id_skill=True, dup_ids=extract.duplicate_ids(ads))
    assert sorted(map(tuple, geo.collect()), key=repr) == sorted(map(tuple, marts.skill_geography(_skills(spark), ads).collect()), key=repr)
    plan = geo._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first_join = next(line for line in plan if "Join" in line)
    assert "municipality_code" in first_join and "LeftOuter" in first_join
