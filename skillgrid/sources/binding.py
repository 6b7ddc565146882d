"""Stand-in ``historical_job_ads`` built from the given driver tables.

The taxonomy has no hits in the raw ``documents`` prose, so each ad gets a
headline from a list of surface forms (a fixed list, then one text for every
alias of the taxonomy), and the ad's text, with another surface form put into
some of them, becomes its description. Every value is a deterministic function
of ``doc_id`` and of the ad's variant; the coordinates are dyadic fractions so
that averages are exact in any order.

Variant 0 is one ad per document. The others repeat ids the hard ways: variant
1 the same id in another archive, month, headline and location; variant 2 the
same id and month at another location; variant 3 one id shared by a twentieth of
all documents. Some ids and municipality codes are NULL.

The same binding, written for DuckDB, is in ``skillgrid.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgrid.functions.taxonomy import pattern_rows, surface_form
from skillgrid.sources.tables import read_table

# --- Fixed values: fixture headlines (shared with the SQL oracle). ---
FIXED_HEADLINES = [
    "Senior Python developer",
    "C# / .NET",
    "C++, Linux",
    "T-SQL och PostgreSQL",
    "MASKININLÄRNING",
    "Dataingenjör",
    "Power BI",
    "Node.js",
    "java script",
    "Azure Data Factory",
    "årust",
    "kundtjänst",
]
SURFACE_HEADLINES = FIXED_HEADLINES + [surface_form(p) for _, _, p in pattern_rows(dialect="python")]

ADS_COLUMNS = [
    "id",
    "publication_date",
    "publication_month",
    "headline",
    "description_text",
    "occupation",
    "occupation_group",
    "occupation_field",
    "must_have_skills",
    "nice_to_have_skills",
    "municipality",
    "municipality_code",
    "region",
    "region_code",
    "postcode",
    "city",
    "longitude",
    "latitude",
    "source_archive",
    "source_year",
]


INPUTS = ("documents", "nation", "region")  # the tables this is derived from


def _sql_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _ads_exprs() -> list[str]:
    n = len(SURFACE_HEADLINES)
    pub = "timestampadd(DAY, cast((doc_id * 37) % 730 + if(v = 1, 45, 0) as int), timestamp_ntz'2023-01-01 00:00:00')"
    at = "cast((doc_id * 53) % 400 as int)"
    return [
        "case when doc_id % 29 = 5 then null when v = 3 then 'hot' else cast(doc_id as string) end as id",
        f"{pub} as publication_date",
        f"cast(date_trunc('MONTH', {pub}) as timestamp_ntz) as publication_month",
        f"case when doc_id % 11 = 0 then null "
        f"else element_at(headlines, cast(1 + (doc_id + 5 * v) % {n} as int)) end as headline",
        "case when doc_id % 13 = 0 then null when doc_id % 6 = 1 then "
        f"concat(substring(text, 1, {at}), ' ', element_at(headlines, cast(1 + (doc_id * 7 + v) % {n} as int)), ' ', "
        f"substring(text, {at} + 1, 100000000)) else text end as description_text",
        "case when doc_id % 7 = 0 then null else concat('occupation_', lang) end as occupation",
        "concat('group_', source) as occupation_group",
        "concat('field_', cast(doc_id % 4 as string)) as occupation_field",
        "array(named_struct('label', lang), named_struct('label', cast(null as string)), "
        "named_struct('label', concat('label_', cast(doc_id % 130 as string)))) as must_have_skills",
        "case when doc_id % 3 = 0 then array(named_struct('label', source)) "
        "when doc_id % 3 = 1 then null else array(named_struct('label', lang)) end as nice_to_have_skills",
        "case when doc_id % 17 = 0 then null else n_name end as municipality",
        "case when doc_id % 23 = 4 then null else cast(n_nationkey as string) end as municipality_code",
        "case when doc_id % 5 = 0 then null else r_name end as region",
        "case when doc_id % 5 = 0 then null else cast(r_regionkey as string) end as region_code",
        "cast(10000 + (doc_id * 7) % 90000 as string) as postcode",
        "case when doc_id % 19 = 0 then null else n_name end as city",
        "cast(8 + 0.75 * n_nationkey as double) as longitude",
        "cast(54 + 0.6875 * n_nationkey as double) as latitude",
        "case when v = 0 then source else concat('again', cast(v as string)) end as source_archive",
        "2023 + cast((doc_id + v) % 2 as int) as source_year",
    ]


# The variants of a document's ad.
_VARIANTS = (
    "filter(array(0, 1, 2, 3), v -> v = 0 or v = 1 and doc_id % 7 = 2 or v = 2 and doc_id % 10 = 3 or v = 3 and doc_id % 20 = 9)"
)


def job_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``historical_job_ads`` (20 columns, one row per document and variant).

    ``documents`` is the large side; the two dimensions are plain joins whose
    size in bytes Spark reads from their files and plans by. An input of fewer
    splits than cores (one file of one row group) is dealt out first; larger
    ones are scanned where they lie.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    cores = spark.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() < cores:
        docs = docs.repartition(cores, "doc_id")
    docs = docs.withColumn("v", F.explode(F.expr(_VARIANTS))).withColumn(
        "headlines", F.expr(f"array({_sql_list(SURFACE_HEADLINES)})")
    )
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    joined = docs.join(nation, (F.col("doc_id") + 3 * F.col("v")) % 25 == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return joined.selectExpr(*_ads_exprs())
