"""Exact top-k inner-product search with a bit-sliced index.

Vectors are turned into integers, ``floor(1024 * x)`` per component. The score
of a candidate is the integer inner product with the query.

Method: the rows are dealt into blocks of about ``BLOCK`` rows. A block's index
holds, for every component, its ``SLICE_BITS`` most significant bits above the
block's minimum as bitmaps over the rows (slices). For a query the component's
weight is rounded to ``WEIGHT_BITS`` bits; slices of components with negative
weight are complemented. Weighted slices are added with bitmap arithmetic
(carry-save adders on 64 rows a word, many queries at a time) into a bit-sliced
sum. From its most significant slice downward the k-th largest sum is found;
rows whose sum is within the proven rounding error of it are the boundary, and
those rows, with the certain ones, are resolved by exact inner products. The
error bound is worst-case, so the result is exact.

Scale: only the queries are replicated, group of ``QUERIES`` by group, to the
blocks; a block is shuffled once. Every (block of rows, group) is one row of an
equi-join on the block's number and is worked on by itself, so no task holds
more than one pair's bitmaps at a time. The join is always a merge join: Spark's
size estimates leave out the replication, and neither side may go to the driver.
Each pair passes at most k rows per query on; the last step ranks those.

Defined results: vectors that are null, empty, or hold null or non-finite
components, and rows without an id, take no part; pairs with a vector whose
products might not fit a long are scored with Python integers, block by block,
and ``score`` is null where it does not fit a long (``rank`` is exact all the
same); vectors are compared with vectors of their own length; rows with the query's id are never its candidates; other
repeated rows count each, ties going to the smaller id; if a query id is
repeated, its least vector asks; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillgrid.llm.common import materialize, tasks

SCALE = 1024
TOP = 10
EVERY = 100  # rows whose id is divisible by this ask
BLOCK = 4096
QUERIES = 512
SLICE_BITS = 6
WEIGHT_BITS = 6
MOST_TASKS = 2000  # of a join of blocks and query groups, unless the session's shuffle width is larger
_LARGEST = float(1 << 20)
_WHOLE = float(1 << 43)
_LARGE = float(1 << 41)  # largest component squared, times the components: integer products and their sums fit a long below it
_LONG = (1 << 63) - 1
_TILE = 128  # queries whose bitmaps are added at once
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, dim, z, large): the usable rows, components rounded down to multiples of 1 / ``SCALE``; large if products may not fit a long."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    sound = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & sound)
    # Doubles of _WHOLE and more are multiples already.
    z = F.transform("x", lambda c: F.when(F.abs(c) < _WHOLE, F.floor(c * F.lit(float(SCALE))).cast("double") / SCALE).otherwise(c))
    rows = rows.select("vec_id", F.size("x").alias("dim"), z.alias("z"))
    most = F.array_max(F.transform("z", lambda c: F.abs(c)))
    return rows.withColumn("large", most * most * F.col("dim") >= _LARGE)


def integer_vectors(usable: DataFrame) -> DataFrame:
    """(vec_id, dim, v): the integer components of the rows that are not large."""
    return usable.where(~F.col("large")).select("vec_id", "dim", F.transform("z", lambda c: (c * F.lit(float(SCALE))).cast("long")).alias("v"))


def _exact_integers(z: bytes, dim: int) -> np.ndarray:
    """The integer components as Python integers."""
    whole = [int(x) * SCALE if abs(x) >= _WHOLE else int(x * SCALE) for x in np.frombuffer(z, np.float64).tolist()]
    return np.array(whole, dtype=object).reshape(-1, dim)


def _order_key(score: int) -> bytes:
    """Bytes in the order of integers of one sign."""
    n = -(-abs(score).bit_length() // 8)
    key = n.to_bytes(4, "big") + abs(score).to_bytes(n, "big")
    return key if score >= 0 else bytes(255 - b for b in key)


_FOUND = "query_id long, vec_id long, score long, beyond int, order binary"


def exact_pairs(candidates: DataFrame, asked: DataFrame, k: int, block: int) -> DataFrame:
    """Each query's k best of every block, by Python integers: ``beyond`` is the sign of scores that fit no long, ``order`` their order."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", kind="stable")
        z = np.stack(frame["z"].to_numpy()).astype(np.float64)
        ids = frame["vec_id"].to_numpy(np.int64).tobytes()
        return pd.DataFrame({"dim": [z.shape[1]], "part": [frame["part"].iloc[0]], "ids": [ids], "z": [z.tobytes()]})

    def packed(rows: DataFrame, seed: int, name: str) -> tuple[DataFrame, int]:
        n = max(1, -(-rows.count() // block))
        parts = rows.select("vec_id", "dim", "z", F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int").alias("part"))
        out = parts.groupBy("dim", "part").applyInPandas(pack, "dim int, part int, ids binary, z binary")
        return out.select("dim", *[F.col(c).alias(f"{name}{c}") for c in ("part", "ids", "z")]), n

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                ids, v = np.frombuffer(r.c_ids, np.int64), _exact_integers(r.c_z, r.dim)
                out = []
                for own, q in zip(np.frombuffer(r.q_ids, np.int64).tolist(), _exact_integers(r.q_z, r.dim), strict=True):
                    scores = v.dot(q).tolist()
                    best = heapq.nsmallest(k, ((-x, i) for x, i in zip(scores, ids.tolist(), strict=True) if i != own))
                    for x, i in best:
                        beyond = (-x > _LONG) - (-x < -_LONG)
                        out.append((own, i, None if beyond else -x, beyond, _order_key(-x) if beyond else None))
                columns = [c.split()[0] for c in _FOUND.split(", ")]
                yield pd.DataFrame(out, columns=columns).astype({"score": "object"})

    rows, n = packed(candidates, 3, "c_")
    queries, _ = packed(asked, 4, "q_")
    queries = queries.withColumn("c_part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return _by_block(queries, rows, "c_part", n).mapInPandas(search, _FOUND)


def _by_block(asked: DataFrame, blocks: DataFrame, number: str, n_blocks: int) -> DataFrame:
    """Every block's row joined with the groups dealt to it; the right side of a merge join is held key by key, one block.

    The rows are few and their work is long, so the tasks follow the number of blocks, not the bytes.
    """
    n = max(tasks(asked.sparkSession), min(n_blocks, MOST_TASKS))
    return asked.repartition(n, "dim", number).join(blocks.repartition(n, "dim", number).hint("merge"), ["dim", number])


def _narrow(v: np.ndarray) -> bytes:
    """The integers in the smallest type that holds them all."""
    fits = (t for t in (np.int16, np.int32) if np.iinfo(t).min <= v.min() and v.max() <= np.iinfo(t).max)
    return v.astype(next(fits, np.int64)).tobytes()


def _wide(packed: bytes, rows: int, dim: int) -> np.ndarray:
    """The integers of :func:`_narrow`, one row each vector."""
    return np.frombuffer(packed, f"i{len(packed) // (rows * dim)}").astype(np.int64).reshape(rows, dim)


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    """One index row from the rows of a block."""
    frame = frame.sort_values("vec_id", kind="stable")
    v = np.stack(frame["v"].to_numpy()).astype(np.int64)
    low = v.min(0)
    u = v - low
    width = np.maximum(1, np.array([int(x).bit_length() for x in u.max(0)]))
    shift = np.maximum(0, width - SLICE_BITS)
    words = -(-len(v) // 64)
    slices = np.zeros((v.shape[1], SLICE_BITS, words * 8), np.uint8)
    for b in range(SLICE_BITS):
        packed = np.packbits(((u >> shift) >> b) & 1 != 0, axis=0, bitorder="little")
        slices[:, b, : packed.shape[0]] = packed.T
    return pd.DataFrame({
        "dim": [v.shape[1]], "block": [frame["block"].iloc[0]], "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()],
        "low": [low.tobytes()], "width": [width.astype(np.int64).tobytes()], "slices": [slices.tobytes()], "vectors": [_narrow(v)],
    })


def index(vectors: DataFrame, n_blocks: int) -> DataFrame:
    """The bit-sliced index, one row per block, written to the shared folder."""
    rows = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
    schema = "dim int, block int, ids binary, low binary, width binary, slices binary, vectors binary"
    # A reader holds a row group; one of 128 MB is many blocks.
    return materialize(rows.groupBy("dim", "block").applyInPandas(_pack, schema), "bsi-index", options={"parquet.block.row.count.limit": "4"})


def _add(columns: list[list[np.ndarray]], at: int, term: np.ndarray) -> None:
    """Carry-save addition: three bitmaps of one weight become one of it and one of the next."""
    while True:
        while at >= len(columns):
            columns.append([])
        held = columns[at]
        held.append(term)
        if len(held) < 3:
            return
        a, b, c = held
        half = a ^ b
        columns[at] = [half ^ c]
        term = (a & b) | (half & c)
        at += 1


def weighted_sum(slices: np.ndarray, weights: np.ndarray, negative: np.ndarray) -> list[np.ndarray]:
    """The slices, least first, of ``sum(weight * component)`` per query and row.

    slices: (components, bits, words); weights and negative: (queries, components).
    """
    columns: list[list[np.ndarray]] = [[]]
    flip = np.where(negative, _ONES, np.uint64(0))
    for d in np.flatnonzero(weights.any(0)):
        mask = [np.where((weights[:, d] >> a) & 1 != 0, _ONES, np.uint64(0))[:, None] for a in range(WEIGHT_BITS + 1)]
        used = [a for a, m in enumerate(mask) if m.any()]
        for b in range(slices.shape[1]):
            bitmap = slices[d, b][None, :] ^ flip[:, d][:, None]
            for a in used:
                _add(columns, a + b, bitmap & mask[a])
    out: list[np.ndarray] = []
    at = 0
    while at < len(columns):  # what is left: at most two bitmaps a column, added with carry
        held = columns[at]
        while len(held) > 1:
            a, b = held.pop(), held.pop()
            held.append(a ^ b)
            _add(columns, at + 1, a & b)
            held = columns[at]
        out.append(held[0] if held else np.zeros((len(weights), slices.shape[2]), np.uint64))
        at += 1
    return out


def _kth(sums: list[np.ndarray], valid: np.ndarray, k: int) -> np.ndarray:
    """Per query the k-th largest sum among the valid rows (0 if there are fewer), from the top slice down."""
    certain, open_ = np.zeros_like(valid), valid.copy()
    value = np.zeros(len(valid), np.int64)
    for bit in range(len(sums) - 1, -1, -1):
        ones = open_ & sums[bit]
        enough = np.bitwise_count(certain).sum(1, dtype=np.int64) + np.bitwise_count(ones).sum(1, dtype=np.int64) >= k
        value += np.where(enough, 1 << bit, 0)
        certain = np.where(enough[:, None], certain, certain | ones)
        open_ = np.where(enough[:, None], ones, open_ & ~sums[bit])
    return value


def _at_least(sums: list[np.ndarray], least: np.ndarray) -> np.ndarray:
    """The rows whose sum reaches the query's value."""
    above, equal = np.zeros_like(sums[0]), np.full_like(sums[0], _ONES)
    for bit in range(len(sums) - 1, -1, -1):
        want = np.where((least >> bit) & 1 != 0, _ONES, np.uint64(0))[:, None]
        above |= equal & sums[bit] & ~want
        equal &= ~(sums[bit] ^ want)
    return above | equal


def search_block(ids: np.ndarray, v: np.ndarray, low: np.ndarray, width: np.ndarray, slices: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int) -> list[tuple]:
    """(query id, vector id, score) of each query's k best rows of one block."""
    n, words = len(ids), slices.shape[2]
    shift = np.maximum(0, width - SLICE_BITS)
    rows = np.zeros(words * 8, np.uint8)
    packed = np.packbits(np.ones(n, bool), bitorder="little")
    rows[: len(packed)] = packed
    every = rows.view(np.uint64)
    out = []
    for a in range(0, len(q), _TILE):
        part, own = q[a : a + _TILE], q_ids[a : a + _TILE]
        weight = np.abs(part) << shift
        # Weights are rounded down to a common unit per query.
        unit = np.maximum(0, np.array([int(x).bit_length() for x in weight.max(1)]) - WEIGHT_BITS)[:, None]
        small = weight >> unit
        sums = weighted_sum(slices, small, part < 0)
        valid = np.repeat(every[None, :], len(part), 0)
        begin, end = np.searchsorted(ids, own), np.searchsorted(ids, own, side="right")
        for i in np.flatnonzero(end > begin):
            for r in range(begin[i], end[i]):
                valid[i, r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
        # Exact score minus unit * sum lies in [fixed, fixed + error]: the cut-off parts of weights and components.
        most = (1 << SLICE_BITS) - 1
        error = (weight - (small << unit)).sum(1) * most + (np.abs(part) * ((np.int64(1) << shift) - 1)).sum(1)
        least = _kth(sums, valid, k) - (error >> unit[:, 0]) - 1
        near = _at_least(sums, np.maximum(least, 0)) & valid
        bits = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")
        for i in range(len(part)):
            found = np.flatnonzero(bits[i])
            score = v[found] @ part[i]
            if len(found) > k:
                # Ties at the end go to the smaller id; rows are in order of id.
                order = np.argsort(-score, kind="stable")[:k]
                found, score = found[order], score[order]
            out += zip([int(own[i])] * len(found), ids[found].tolist(), score.tolist(), strict=True)
    return out


def top_k(embeddings: DataFrame, queries: DataFrame, k: int = TOP, block: int = BLOCK, group: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of ``embeddings`` for each row of ``queries``."""
    usable, asking = usable_vectors(embeddings), usable_vectors(queries)
    vectors = integer_vectors(usable)
    least = asking.groupBy("vec_id").agg(F.min(F.struct("dim", "z", "large")).alias("q"))
    least = materialize(least.select("vec_id", "q.dim", "q.z", "q.large"), "bsi-queries")
    asked = integer_vectors(least)
    n_blocks = max(1, -(-vectors.count() // block))
    n_groups = max(1, -(-asked.count() // group))

    def pack_queries(frame: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(frame["v"].to_numpy()).astype(np.int64)
        ids = frame["vec_id"].to_numpy(np.int64)
        return pd.DataFrame({"dim": [v.shape[1]], "grp": [frame["grp"].iloc[0]], "q_ids": [ids.tobytes()], "q": [_narrow(v)]})

    grouped = asked.withColumn("grp", F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(n_groups)).cast("int"))
    packed = grouped.groupBy("dim", "grp").applyInPandas(pack_queries, "dim int, grp int, q_ids binary, q binary")
    blocks = index(vectors, n_blocks)
    packed = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                read = lambda x: np.frombuffer(x, np.int64)
                ids, q_ids = read(r.ids), read(r.q_ids)
                slices = np.frombuffer(r.slices, np.uint64).reshape(r.dim, SLICE_BITS, -1)
                v, q = _wide(r.vectors, len(ids), r.dim), _wide(r.q, len(q_ids), r.dim)
                rows = search_block(ids, v, read(r.low), read(r.width), slices, q_ids, q, k)
                yield pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    found = _by_block(packed, blocks, "block", n_blocks).mapInPandas(search, "query_id long, vec_id long, score long")
    found = found.withColumns({"beyond": F.lit(0), "order": F.lit(None).cast("binary")})
    large = usable.where("large")
    if least.where("large").limit(1).count():
        found = found.union(exact_pairs(usable, least.where("large"), k, block))
    if large.limit(1).count():
        found = found.union(exact_pairs(large, least.where(~F.col("large")), k, block))
    best = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("order"), F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, every: int = EVERY, k: int = TOP) -> DataFrame:
    """The k best candidates among all rows for the rows whose id is divisible by ``every``."""
    return top_k(embeddings, embeddings.where(F.col("vec_id") % every == 0), k)


ORACLE = f"""
with sound as (
  select vec_id, [cast(floor({SCALE} * cast(x as double)) as bigint) for x in embedding] as v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x) or abs(x) >= {_LARGEST}]) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum([z[1] * z[2] for z in list_zip(q.v, c.v)]) as bigint) as score
  from sound q join sound c on c.vec_id <> q.vec_id and len(c.v) = len(q.v) where q.vec_id % {EVERY} = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from scored qualify rank <= {TOP}
"""
