"""Shared steps of the operators: row keys, bounded prefix sums, grouped batches, components.

Everything here is a DataFrame step whose per-task state is bounded: prefix
sums are two-level (bucket totals, then rows inside a bucket), grouped Python
work streams sorted rows, and connected components is an iterated join whose
state is written to the shared checkpoint folder between rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skillgrid.session import materialize

__all__ = [
    "components", "exclusive_prefix", "grouped", "materialize", "read", "row_key", "row_rank", "tasks", "text_or_empty",
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One given table; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text_or_empty(text: Column) -> Column:
    """Null texts count as empty ones."""
    return F.coalesce(text.cast("string"), F.lit(""))


def row_key(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes of the columns: equal rows share them, others do not.

    Nulls are hashed with a marker, so a null and an empty text differ.
    """
    marked = [x for c in cols for x in (c, c.isNull())]
    return [F.xxhash64(F.lit(11), *marked), F.xxhash64(F.lit(29), *reversed(marked))]


def tasks(spark: SparkSession) -> int:
    """The session's shuffle width, for steps that name a partition count."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def exclusive_prefix(
    df: DataFrame, group: list[str], bucket: list[str], order: list[Column], value: Column, out: str,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one in its group.

    Rows of a group are ordered by the bucket columns, then by ``order``. Two
    levels keep every task small: a running sum inside each (group, bucket),
    and a running sum over the bucket totals of each group, joined back on the
    keys the rows are already partitioned by (the wide rows shuffle once).
    ``facts`` (one row per group) rides along with the bucket totals, so that
    no row is shuffled on its group alone. Group and bucket columns must not
    be null.
    """
    keys = [*group, *bucket]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    over_buckets = Window.partitionBy(*group).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*keys, F.coalesce(F.sum("__total").over(over_buckets), F.lit(0)).alias("__base"))
    if facts is not None:
        bases = bases.join(facts, group)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = df.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return ranked.join(bases, keys).withColumn(out, F.col("__base") + F.col("__inside")).drop("__base", "__inside")


def row_rank(
    df: DataFrame, group: list[str], bucket: list[str], order: list[Column], out: str, facts: DataFrame | None = None
) -> DataFrame:
    """Adds ``out``: the gapless rank (from 0) of the row in its group."""
    return exclusive_prefix(df, group, bucket, order, F.lit(1).cast("long"), out, facts)


def grouped(
    batches: Iterator[pd.DataFrame], keys: list[str], work: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], rows: int
) -> Iterator[pd.DataFrame]:
    """Calls ``work(rows, group numbers)`` on runs of whole groups of a stream sorted by ``keys``.

    A call gets ``rows`` rows and the rest of a group; one batch and one group
    are held. Callers keep groups bounded.
    """

    def breaks(frame: pd.DataFrame) -> np.ndarray:
        new = np.zeros(len(frame), bool)
        for k in keys:
            v = frame[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return new

    held: list[pd.DataFrame] = []
    n = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        n += len(batch)
        if n < rows:
            continue
        frame = pd.concat(held, ignore_index=True) if len(held) > 1 else batch
        new = breaks(frame)
        group, starts = new.cumsum(), np.flatnonzero(new)
        done = 0
        while True:
            # The next cut is the first start of a group after enough rows.
            k = np.searchsorted(starts, done + rows)
            if k == len(starts):
                break
            yield work(frame.iloc[done : starts[k]].reset_index(drop=True), group[done : starts[k]])
            done = starts[k]
        held, n = [frame.iloc[done:]], len(frame) - done
    if n:
        frame = pd.concat(held, ignore_index=True)
        yield work(frame, breaks(frame).cumsum())


def components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Connected components of an undirected edge list: (node, label), label = least node.

    Each round every node takes the least label among its neighbours and then
    its label's label. The label table is written to the shared folder between
    rounds; only one count per round comes to the driver.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = materialize(both.union(both.select("y", "x")).distinct(), f"{name}-edges")
    if not both.limit(1).count():
        return both.select(F.col("x").alias("node"), F.col("y").alias("label"))
    labels = materialize(both.groupBy("x").agg(F.min("y").alias("y")).select(
        F.col("x").alias("node"), F.least("x", "y").alias("label")), f"{name}-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), "label"), "y")
        near = near.groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("hook"))
        jump = labels.select(F.col("node").alias("hook"), F.col("label").alias("jump"))
        hooked = hooked.join(jump, "hook", "left").select(
            "node", "old", F.least("hook", F.coalesce("jump", "hook")).alias("label"))
        step = materialize(hooked, f"{name}-labels")
        changed = step.where("label <> old").limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels
