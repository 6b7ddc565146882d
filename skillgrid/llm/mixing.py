"""Mixing sources to target weights by systematic sampling.

Method: every document of a source has the same expected number of copies
(its source's target words over its source's words). The expected copies are
prefix-summed over the source, one random offset per source is added, and the
document is emitted once per integer boundary that its step crosses. So a
source's copies differ from the expectation by less than one, and because the
documents are walked in order of size, its words do too, up to about one large
document. A step is at most 2, so no document is taken more than twice.

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and
share 150% of all words; a target stops at twice its source's words and the
excess is reshared by weight until no target is above its stop.

Scale: two passes. The first sums words per source (map-side combined). The
level of the targets is found by repeating one global sum over the source
table, so only two numbers a round come to the driver. The second pass is one
shuffle of the rows on (source, size class, salt): about sqrt(rows) salts
bound each task even if one source holds most rows, and the prefix sum is
finished from the bucket totals (see ``common.exclusive_prefix``).

Defined results: null texts have size 0 and are walked like any others, so
their copies weigh nothing (a source with no words has target 0 and takes
nothing); null sources form one source; equal
rows may be told apart only by their copies; an empty table gives an empty
result; extra columns pass through ``mix`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgrid.llm.common import exclusive_prefix, materialize, row_rank

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
_WORDS = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of maximal runs of non-blank characters; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(_WORDS)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """A non-null key in code-point order with null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def source_targets(sized: DataFrame) -> DataFrame:
    """(__source, source_size, target) from rows with ``__source`` and ``__size``."""
    sums = sized.groupBy("__source").agg(F.sum("__size").alias("source_size"), F.count("*").alias("__n"))
    # The sources are ranked over their own small table: buckets of leading characters keep even that two-level.
    sums = sums.withColumn("__all", F.lit(0)).withColumn("__lead", F.substring("__source", 1, 3))
    ranked = row_rank(sums, ["__all"], ["__lead"], [F.col("__source")], "__rank")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("__rank") % len(WEIGHTS) + 1).cast("int"))
    stats = materialize(ranked.select("__source", "source_size", "__n", weight.alias("__weight")), "mix-sources")

    total = stats.agg(F.sum("source_size")).first()[0] or 0
    wanted, level = SHARE * total, 0.0
    stop = F.col("source_size") * float(MOST_COPIES)
    while True:
        # Sources whose share at this level passes their stop give the excess to the others.
        capped = F.col("__weight") * F.lit(level) >= stop
        row = stats.agg(
            F.coalesce(F.sum(F.when(capped, stop)), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~capped, F.col("__weight"))), F.lit(0)).alias("open"),
        ).first()
        higher = (wanted - row["fixed"]) / row["open"] if row["open"] else level
        if higher <= level:
            break
        level = higher
    return stats.withColumn("target", F.least(F.col("__weight") * F.lit(level), stop))


def sized_rows(docs: DataFrame, carried: list[Column], seed: int = 5) -> DataFrame:
    """The carried columns with ``__source``, ``__size``, ``__doc`` and ``__identity``: all the mixture needs of a row."""
    return docs.select(
        *carried,
        _source_key(F.col("source")).alias("__source"),
        words(F.col("text")).alias("__size"),
        F.col("doc_id").alias("__doc"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("__identity"),
    )


def mix(sized: DataFrame, seed: int = 5) -> DataFrame:
    """``sized_rows`` with ``__size``, ``__source_size``, ``__target`` and ``__copies`` (0, 1 or 2)."""
    stats = source_targets(sized.select("__source", "__size"))
    rows = stats.agg(F.sum("__n")).first()[0] or 0
    salts = max(1, math.isqrt(rows) // 64)
    bucketed = sized.withColumns({
        "__class": F.floor(F.log2(F.col("__size") + F.lit(1.0)) * 16).cast("int"),
        "__salt": F.pmod("__identity", F.lit(salts)).cast("int"),
    })
    order = [F.col("__size"), F.col("__identity"), F.col("__doc")]
    facts = stats.select("__source", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"))
    found = row_rank(bucketed, ["__source"], ["__class", "__salt"], order, "__before", facts)
    expected = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    offset = F.pmod(F.xxhash64(F.lit(seed), "__source"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    crossed = F.floor(F.col("__before") * expected + expected + offset) - F.floor(F.col("__before") * expected + offset)
    copies = F.least(F.greatest(crossed, F.lit(0)), F.lit(MOST_COPIES)).cast("int")
    return found.withColumn("__copies", copies).drop("__source", "__class", "__salt", "__identity", "__before", "__doc")


def mixed_documents(docs: DataFrame, seed: int = 5) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every document row; texts are read once."""
    sized = materialize(sized_rows(docs, [F.col("doc_id")], seed), "mix-sizes")
    return mix(sized, seed).select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).cast("long").alias("taken"),
    )


def emit_copies(docs: DataFrame, seed: int = 5) -> DataFrame:
    """The mixture itself: every row of ``docs`` once per copy, columns unchanged."""
    # Rows travel as one struct, so no column of theirs can be mistaken for one of ours.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    taken = mix(sized_rows(docs, [row], seed), seed).where("__copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("row.*")
