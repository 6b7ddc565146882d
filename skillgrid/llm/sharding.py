"""Sharding by a hierarchical weighted hash tree (law ``key``).

Method: shards are leaves of a tree of regions and racks. For a document every
node has a weighted hash draw, an exponential variate whose rate is the node's
weight, and the document descends: the region with the least draw, in it the
rack with the least draw, in that the shard with the least draw. A shard's draw
is ``-ln(u(document, shard)) / weight``; a rack's draw is the least of its
shards' and a region's the least of its racks'. The least of exponentials is an
exponential whose rate is the sum of theirs, so each level draws exactly by
subtree weight, and the levels agree with each other: changing a shard's weight
changes only that shard's draw, so rows move only into it (weight up) or out of
it (weight down), within the path above it. Independent draws per level would
not do that: rows that enter a region because it grew would fall on its old
shards too, which breaks law ``key``.

Law: the id and the shard count decide. ``grown_shard`` is the shard with one
more shard in the tree; it differs from ``shard`` only where it is the new one.

Scale: the descent is one expression per row (no shuffle, no Python). ``slot``,
a gapless number inside the shard, is a two-level prefix count: rows shuffle
once on (shard, salt) with about sqrt(rows) salts, never on the shard alone.

Defined results: a null id is hashed as a value of its own; null text has size
16 and the checksum of no bytes, 0; rows with equal ids share a shard and get
different slots; an empty table gives an empty result; extra columns are not
read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgrid.llm.common import row_rank, text_or_empty

SHARDS = 40
SHARDS_PER_RACK = 4
RACKS_PER_REGION = 2
OVERHEAD = 16

Tree = dict[int, dict[int, dict[int, float]]]


def tree(shards: int, weights: dict[int, float] | None = None) -> Tree:
    """region -> rack -> shard -> weight (1 unless given); new shards fill the last rack, then open another."""
    out: Tree = {}
    for shard in range(shards):
        rack = shard // SHARDS_PER_RACK
        weight = (weights or {}).get(shard, 1.0)
        if weight > 0:
            out.setdefault(rack // RACKS_PER_REGION, {}).setdefault(rack, {})[shard] = weight
    return out


def _draw(key: Column, shard: int, weight: float) -> Column:
    # 52 bits of the hash, shifted by a half: strictly between 0 and 1.
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(shard), key, key.isNull()), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(uniform) / F.lit(float(weight))


def _least(draws: list[Column]) -> Column:
    return draws[0] if len(draws) == 1 else F.least(*draws)


def _lead(options: list[tuple[Column, Column]]) -> Column:
    """The value whose draw is least; ties go to the earlier one."""
    least = _least([d for d, _ in options])
    return reduce(lambda rest, x: F.when(x[0] == least, x[1]).otherwise(rest), reversed(options[:-1]), options[-1][1])


def draws(key: Column, nodes: Tree) -> dict[int, Column]:
    """The leaf draws, to be computed once per row before the descent reads them."""
    return {s: _draw(key, s, w) for racks in nodes.values() for shards in racks.values() for s, w in shards.items()}


def descend(leaf: dict[int, Column], nodes: Tree) -> Column:
    """The shard that the document reaches: region, then rack, then shard by the least draw."""
    regions = []
    for racks in nodes.values():
        inside = []
        for shards in racks.values():
            options = [(leaf[s], F.lit(s)) for s in shards]
            inside.append((_least([d for d, _ in options]), _lead(options)))
        regions.append((_least([d for d, _ in inside]), _lead(inside)))
    return _lead(regions).cast("int")


def with_shard(docs: DataFrame, shards: int = SHARDS, weights: dict[int, float] | None = None) -> DataFrame:
    """``docs`` with ``__shard`` and ``__grown`` (the shard with one more shard)."""
    grown = tree(shards + 1, weights)
    leaf = draws(F.col("doc_id"), grown)
    # The draws are one array column, so the tree's comparisons read them instead of hashing anew.
    names = sorted(leaf)
    drawn = docs.withColumn("__draws", F.array(*(leaf[s] for s in names)))
    stored = {s: F.col("__draws")[k] for k, s in enumerate(names)}
    return drawn.withColumn("__shard", descend(stored, tree(shards, weights))).withColumn(
        "__grown", descend(stored, grown)).drop("__draws")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every document row."""
    text = text_or_empty(F.col("text")).cast("binary")
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    placed = with_shard(narrow, shards)
    salts = max(1, math.isqrt(docs.count()) // 8)
    salted = placed.withColumn("__salt", F.pmod(F.xxhash64(F.lit(8), "doc_id", "text_crc32"), F.lit(salts)).cast("int"))
    order = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    ranked = row_rank(salted, ["__shard"], ["__salt"], order, "__slot")
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("__shard").alias("shard"),
        F.col("__slot").cast("long").alias("slot"), F.col("__grown").alias("grown_shard"))
