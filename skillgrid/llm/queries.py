"""The registered queries of the operators: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skillgrid.llm import (
    bit_sliced,
    decontaminate,
    html_extract,
    mixing,
    ngram_join,
    periodic_runs,
    quality_gam,
    sharding,
    spelling_variants,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from skillgrid.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"))


def op2_bit_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.nearest(read(spark, sf_dir, "embeddings"))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(read(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(read(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read(spark, sf_dir, "pages"))


def op8_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicate_classes(read(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.hidden_runs(read(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_token_counts, op2_bit_sliced_search, op3_template_decontamination, op4_quality_gam, op5_systematic_mix,
        op6_suffix_dedup, op7_html_extraction, op8_hash_tree, op9_url_filters, op10_ngram_join, op11_toxicity, op12_periodic_runs,
        op13_spelling_variants,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_bit_sliced_search": bit_sliced.ORACLE,
    "op6_suffix_dedup": suffix_dedup.ORACLE,
    "op9_url_filters": url_filter.ORACLE,
    "op10_ngram_join": ngram_join.ORACLE,
}
