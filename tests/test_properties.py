"""Property tests: random texts vs the SQL engine, and partitioning / broadcast guards."""

from __future__ import annotations

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skillgrid.operators import extract
from skillgrid.plans.oracle import PATTERNS_CTE
from skillgrid.session import materialize

PIECES = [
    "python", "Spark", "PySpark", "C#", "c++", ".NET", "asp.net", "node.js", "NodeJS", "T-SQL", "pl/sql",
    "Power BI", "powerbi", "MASKININLÄRNING", "dataingenjör", "språkbehandling", "ſpark", "K8s", "k8s",
    "java script", "javascript", "Azure Data Factory", "r-programmering", "scikit learn", "ai models",
    "Go programming", "golang", "rust", "årust", "_", "å", "ö", "İ", "ı", "x", "9", "#", "+", ".",
    " ", "  ", "\t", "\n", "\x0b", "\xa0", "　", ",", "(", ")", "/",
]


def _sql_rows(rows):
    con = duckdb.connect()
    con.execute("create table ads(id varchar, headline varchar, description_text varchar)")
    con.executemany("insert into ads values (?, ?, ?)", rows)
    sql = f"""with {PATTERNS_CTE}
    select id, skill, matched_text from (
      select a.id, p.skill, trim(regexp_extract(a.s, p.pattern, 0, 'i')) as matched_text,
        row_number() over (partition by a.id, p.skill order by p.pattern_order) as rk
      from (select *, coalesce(headline, '') || ' ' || coalesce(description_text, '') as s from ads) a
      join patterns p on regexp_matches(a.s, p.pattern, 'i')
    ) where rk = 1"""
    return set(con.execute(sql).fetchall())


texts = st.lists(st.sampled_from(PIECES), min_size=1, max_size=8).map("".join)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=st.lists(st.tuples(texts, st.one_of(st.none(), texts)), min_size=20, max_size=40))
def test_random_texts_match_sql_engine(spark, batch):
    rows = [(str(i), h, d) for i, (h, d) in enumerate(batch)]
    ads = spark.createDataFrame(rows, "id string, headline string, description_text string").select(
        "id", F.lit(None).cast("timestamp_ntz").alias("publication_month"), "headline", "description_text"
    )
    got = {(r.id, r.skill, r.matched_text) for r in extract.regex_skill_matches(ads).collect()}
    assert got == _sql_rows(rows)


def test_materialize_keeps_types_and_order_with_a_leading_partition_column(spark):
    df = spark.createDataFrame([(True, "a", 1), (False, "b", 2)], "flag boolean, name string, n int")
    back = materialize(df, "leading_partition", partition_by=["flag"])
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
