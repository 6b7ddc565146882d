"""URL filters by host-suffix and path-prefix expressions.

Method: a rule is a host and a path; it fits a URL whose host is the rule's or
a subdomain of it and whose path starts with the rule's. Every URL is expanded
into its host-suffix + path-prefix expressions. The SHA-256 digests of the
expressions are equi-joined with those of the rules on a short prefix, full
digests confirm the match, and the longest fitting rule wins (then the longer
host, then block over allow).

Only suffixes of as many labels and prefixes of as many characters as some rule
has are expanded: the distinct (labels, characters) pairs of the rules, so the
expansion is exact and its size does not depend on how long a URL is.

Scale: DataFrame functions only. Matches are resolved once per distinct URL
(map-side combined) and joined back to the rows on the URL, so a hot host costs
no more than its rows; a hot URL is a splittable side of that join.

Defined results: host is what stands between the first ``://`` and the next
``/``, ``?``, ``#`` or the end, with A-Z lower-cased (a port stays part of it);
path is what follows up to ``?``, ``#`` or the end; a null URL or one without
``://`` has both empty; an empty host fits no rule; URLs that no rule fits have
a null rule and verdict ``allow`` (a filter list names what to act on);
repeated rows and ids repeat; an empty rule table lets everything pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_VERDICT = "allow"
PREFIX_HEX = 8  # 32 bits of the digest
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(host, path, verdict) rows of a rule list."""
    return spark.createDataFrame(RULES if rules is None else rules, "host string, path string, verdict string")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page row."""
    usable = rules.where("host is not null and host <> '' and path is not null and verdict is not null")
    digest = F.sha2(F.concat("host", "path"), 256)
    signed = usable.select(
        F.col("host").alias("rule_host"), F.concat("host", "path").alias("rule"), "verdict", digest.alias("digest"),
        F.substring(digest, 1, PREFIX_HEX).alias("prefix"), _labels(F.col("host")).alias("labels"), F.length("path").alias("chars"),
    ).distinct()
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    urls = rows.select("host", "path").where("host <> ''").distinct()
    # Distinct (labels, characters) pairs: as many as hosts have depths times paths have lengths, whatever the number of rules.
    shapes = [F.struct(F.lit(n).alias("labels"), F.lit(k).alias("chars")) for n, k in sorted(signed.select("labels", "chars").distinct().collect())]
    if not shapes:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(DEFAULT_VERDICT).alias("verdict"))
    shaped = urls.withColumn("shape", F.explode(F.array(*shapes)))
    fits = (F.col("shape.labels") <= _labels(F.col("host"))) & (F.col("shape.chars") <= F.length("path"))
    suffix = F.expr("substring_index(host, '.', -shape.labels)")
    expression = F.concat(suffix, F.expr("left(path, shape.chars)"))
    expanded = shaped.where(fits).select("host", "path", F.sha2(expression, 256).alias("own"))
    expanded = expanded.withColumn("prefix", F.substring("own", 1, PREFIX_HEX))
    hits = expanded.join(signed, "prefix").where("own = digest")
    order = F.struct(F.length("rule"), F.length("rule_host"), (F.col("verdict") == "block"), "rule", "verdict")
    best = hits.groupBy("host", "path").agg(F.max(order).alias("best"))
    best = best.select("host", "path", "best.rule", "best.verdict")
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"))


def _sql_values(rules: list[tuple[str, str, str]]) -> str:
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)


ORACLE = f"""
with rules(rule_host, rule_path, verdict) as (values {_sql_values(RULES)}),
rest as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as r from pages
),
split as (
  select row_number() over () as k, page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from rest
),
fit as (
  select k, rule_host || rule_path as rule, verdict from split join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  qualify row_number() over (partition by k order by length(rule_host || rule_path) desc, length(rule_host) desc, verdict desc) = 1
)
select page_id, host, path, rule, coalesce(verdict, '{DEFAULT_VERDICT}') as verdict from split left join fit using (k)
"""
