"""Quality assurance: QA summary and samples (D8, D9) and the data tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from skillgrid.functions.constants import LABEL_SOURCE, QA_TOP, REGEX_SOURCE, SAMPLES_PER_SKILL


def qa_summary(matches: DataFrame, one_row_per_id_skill: bool = False) -> DataFrame:
    """Per skill: distinct ads, match rows, distinct lower-cased matched terms.

    With one match row per (id, skill), distinct ads is the count of non-NULL
    ids, and the only distinct aggregate left is the (low-cardinality) matched terms.
    """
    ads = F.count("id") if one_row_per_id_skill else F.count_distinct("id")
    return matches.groupBy("skill").agg(
        ads.alias("ads"),
        F.count("*").alias("matches"),
        F.count_distinct(F.lower("matched_text")).alias("matched_terms"),
    )


def qa_top(summary: DataFrame, k: int = QA_TOP) -> DataFrame:
    """The summary's first ``k`` rows by ads (ties: skill). Parquet order is no contract."""
    return summary.orderBy(F.desc("ads"), F.asc("skill")).limit(k)


def skill_samples(matches: DataFrame, per_skill: int = SAMPLES_PER_SKILL) -> DataFrame:
    """Newest ``per_skill`` matches per skill (month desc, then id, NULL ids last) for review.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so a skill holding a third of all matches still sends at most
    ``k`` rows per map partition.
    """
    w = Window.partitionBy("skill").orderBy(F.desc("publication_month"), F.asc_nulls_last("id"))
    return (
        matches.withColumn("sample_rank", F.row_number().over(w))
        .where(F.col("sample_rank") <= per_skill)
        .select(
            "skill",
            "matched_text",
            "id",
            "publication_month",
            "headline",
            "description_snippet",
        )
    )


# --- Data tests -------------------------------------------------------------
# (table, test, column, accepted values or None)
SOURCE_TESTS = [
    ("historical_job_ads", "not_null", "id", None),
    ("historical_job_ads", "not_null", "publication_month", None),
    ("historical_job_skills", "not_null", "id", None),
    ("historical_job_skills", "accepted_values", "skill_source", (LABEL_SOURCE,)),
    ("historical_regex_skills", "not_null", "id", None),
    ("historical_regex_skills", "not_null", "publication_month", None),
    ("historical_regex_skills", "not_null", "skill", None),
    ("historical_regex_skills", "accepted_values", "skill_source", (REGEX_SOURCE,)),
]
MART_NOT_NULL = {
    "monthly_skill_counts": ["publication_month", "skill", "mentions"],
    "mart_dashboard_skill_trends": ["publication_month", "skill", "mentions", "ads", "share_of_ads"],
    "mart_skill_geography": [
        "publication_month",
        "skill",
        "municipality",
        "municipality_code",
        "region",
        "mentions",
        "ads",
    ],
}


def _check_expr(test: str, column: str | None, accepted: tuple[str, ...] | None):
    """Failure count of one test, as an aggregate expression.

    not_null counts NULL rows; accepted_values counts distinct non-NULL values
    outside the list (NULL passes); share_bounds counts rows outside [0, 1];
    not_empty is 1 for an empty table.
    """
    if test == "not_null":
        return F.count_if(F.col(column).isNull())
    if test == "accepted_values":
        bad = F.col(column).isNotNull() & ~F.col(column).isin(*accepted)
        return F.count_distinct(F.when(bad, F.col(column)))
    if test == "share_bounds":
        return F.count_if((F.col("share_of_ads") < 0) | (F.col("share_of_ads") > 1))
    if test == "not_empty":
        return F.when(F.count("*") == 0, F.lit(1)).otherwise(F.lit(0))
    raise ValueError(test)


def _table_report(name: str, df: DataFrame, checks: list[tuple[str, str | None, tuple | None]]) -> DataFrame:
    """All checks of one table in a single aggregate pass, one row per check."""
    aggs = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(test).alias("test_name"),
            F.lit(column).cast("string").alias("column_name"),
            _check_expr(test, column, accepted).cast("long").alias("failures"),
        )
        for test, column, accepted in checks
    ]
    return df.agg(F.array(*aggs).alias("r")).select(F.inline("r"))


def declared_tests() -> dict[str, list[tuple[str, str | None, tuple | None]]]:
    """The 26 data tests by table: (test, column, accepted values)."""
    checks: dict[str, list] = {}
    for table, test, column, accepted in SOURCE_TESTS:
        checks.setdefault(table, []).append((test, column, accepted))
    for table, columns in MART_NOT_NULL.items():
        checks.setdefault(table, []).extend(("not_null", c, None) for c in columns)
    checks["monthly_skill_counts"].append(("not_empty", None, None))
    checks["mart_dashboard_skill_trends"].append(("share_bounds", "share_of_ads", None))
    checks["mart_skill_geography"].append(("share_bounds", "share_of_ads", None))
    return checks


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """The 26 data tests as one DataFrame(table_name, test_name, column_name, failures)."""
    reports = [_table_report(t, tables[t], c) for t, c in declared_tests().items()]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


class ObservedTests:
    """The data tests, counted by the jobs that write the tables.

    ``watch`` adds the tests' counts to a frame as observed metrics; the next
    action over it, its write, collects them on the way. ``report`` then needs
    no scan: only a table that nothing watched is aggregated, and the distinct
    values of a failing ``accepted_values`` test are counted in the table, once
    its rows show that there are any.
    """

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, observed if the table has tests; the last frame watched under a name counts."""
        checks = declared_tests().get(name)
        if not checks:
            return df
        self._seen[name] = Observation()
        metrics = [_observed_expr(test, c, a).cast("long").alias(f"m{i}") for i, (test, c, a) in enumerate(checks)]
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("rows"), *metrics)

    def _failures(self, name: str, checks: list, table: DataFrame, rest: DataFrame | None) -> list[int] | None:
        """The failures from the observed counts and, for rows written earlier, from ``rest``; None without counts."""
        found = self._seen[name].get if name in self._seen else None
        if not found:
            return None  # never written, or no row reached the job
        counts = [found[f"m{i}"] for i in range(len(checks))]
        if rest is not None:
            more = rest.agg(*[F.coalesce(_observed_expr(t, c, a).cast("long"), F.lit(0)).alias(f"m{i}") for i, (t, c, a) in enumerate(checks)]).first()
            counts = [n + more[f"m{i}"] for i, n in enumerate(counts)]
        out = []
        for (test, column, accepted), n in zip(checks, counts, strict=True):
            if test == "not_empty":
                n = int(n == 0)
            elif test == "accepted_values" and n:
                n = table.agg(_check_expr(test, column, accepted)).first()[0]
            out.append(n)
        return out

    def report(self, tables: dict[str, DataFrame], rest: dict[str, DataFrame] | None = None) -> DataFrame:
        """``quality_report`` of the tables; ``rest`` has rows of a table that were not written by the watched job."""
        rows: list[tuple] = []
        unseen: list[DataFrame] = []
        for name, checks in declared_tests().items():
            failures = self._failures(name, checks, tables[name], (rest or {}).get(name))
            if failures is None:
                unseen.append(_table_report(name, tables[name], checks))
            else:
                rows += [(name, test, column, n) for (test, column, _), n in zip(checks, failures, strict=True)]
        spark = next(iter(tables.values())).sparkSession
        out = spark.createDataFrame(rows, "table_name string, test_name string, column_name string, failures long")
        for r in unseen:
            out = out.unionByName(r)
        return out


def _observed_expr(test: str, column: str | None, accepted: tuple[str, ...] | None):
    """What a writing job counts for one test: an aggregate without distinct, additive over rows."""
    if test == "accepted_values":
        return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))
    if test == "not_empty":
        return F.count(F.lit(1))
    return _check_expr(test, column, accepted)


def share_violations(trends: DataFrame, geography: DataFrame) -> DataFrame:
    """Rows of either mart whose share_of_ads is outside [0, 1] (a row = a failure)."""

    def bad(df: DataFrame, mart: str, municipality) -> DataFrame:
        return df.where((F.col("share_of_ads") < 0) | (F.col("share_of_ads") > 1)).select(
            F.lit(mart).alias("mart"),
            "publication_month",
            "skill",
            municipality.alias("municipality_code"),
            "mentions",
            "ads",
            "share_of_ads",
        )

    return bad(trends, "mart_dashboard_skill_trends", F.lit(None).cast("string")).unionByName(
        bad(geography, "mart_skill_geography", F.col("municipality_code"))
    )


def not_empty_check(df: DataFrame) -> DataFrame:
    """One row when ``df`` is empty, none otherwise. Reads at most one row."""
    return (
        df.limit(1)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") == 0)
        .select(F.lit(1).alias("failure"))
    )
