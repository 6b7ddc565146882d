"""The corpus pipeline: five stages over ``documents``, each one operator of skillgrid.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared checkpoint folder and reads it back, so a
lost executor never repeats an earlier stage. All stages but the last return
the columns of ``documents``.

Defined results: an empty table passes through every stage; null and empty
texts are judged by the quality model like any text of length 0, are never
near duplicates or contaminated, and weigh nothing in the mixture. Rows that
are equal in id and text count as one group of copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skillgrid.llm import decontaminate, mixing, ngram_join, quality_gam, sharding
from skillgrid.llm.common import materialize, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the additive model rejects."""
    return quality_gam.keep_quality(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near copies."""
    return ngram_join.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, re-parameterised or not."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that the sources meet their target weights."""
    return mixing.emit_copies(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Assigns every row of the mixture to a shard and a slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]

# No stage but the last two can be said in SQL (a trained model, a similarity
# join); tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
