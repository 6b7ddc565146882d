"""Exact-substring deduplication with suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
(in any document, the same one included) is removed. Texts are UTF-8 bytes;
matches never cross documents and are judged on the input.

Method: suffix arrays of byte shards by Larsson-Sadakane refinement in numpy
(sort by eight bytes, then double the sorted depth, re-sorting only the groups
that are still tied), Kasai's common prefixes, and merging across shards by
binary search. A corpus has too many shards to compare each with each, so
places that can match are brought into the same shard first:

1. Winnowing. In every string of ``LENGTH`` bytes the ``GRAM``-byte gram with
   the least hash is marked (leftmost on ties). Equal strings have equal marks
   at equal places, so strings can only match under the same mark. The strings
   of one mark are neighbours: a run of starts whose bytes form one *context*.
2. Marks that occur once are dropped. Equal contexts of a mark collapse to one
   with its number of occurrences, before anything wide moves.
3. The bytes of the distinct contexts are fetched from their documents and
   dealt by mark; a shard is about a thousand contexts. Its suffix array and
   common prefixes give the classes of equal strings. A class that starts at
   two or more places is duplicated.
4. A mark with more than ``SHARD`` contexts (a passage that a large part of the
   corpus shares) is salted over several shards. These report the digests of
   their classes; the reports are dealt by digest and each list is looked up
   in the merged one by binary search, which finds what two shards share.
5. Duplicated starts go back to every occurrence of their context and become
   byte intervals, which are joined in each document and cut out.

Scale: the scan emits about one 40-byte row per 85 bytes of text, and a row per
run of equal neighbours in periodic text. Whole texts shuffle twice, on their
hash: to fetch contexts and to cut. No task holds more than a shard or a
document. Memory per byte is bounded by working through texts in pieces of
``PIECE`` bytes.

Defined results: null texts are empty (0 bytes, digest of no bytes); texts
shorter than ``LENGTH`` lose nothing; rows with equal texts are different
places, also if their ids are equal or null; extra columns are not read.
Marks, contexts and texts are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgrid.llm.common import grouped, materialize, row_key, tasks, text_or_empty
from skillgrid.llm.text_hash import mix

LENGTH = 200
GRAM = 32
SHARD = 2048  # contexts of one mark that stay together
SHARD_ROWS = 1024  # contexts of a shard, about; its arrays then stay in a core's cache
PIECE = 1 << 20
_BASE = np.uint64(0xC2B2AE3D27D4EB4F | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)


class Rolling:
    """Hashes of substrings of a buffer, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, most: int) -> None:
        self._powers(most)

    def _powers(self, n: int) -> None:
        both = []
        for base in (_BASE, _INVERSE):
            x = np.full(n + 1, base, np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        self.up, self.down = both

    def load(self, data: np.ndarray) -> None:
        if len(data) >= len(self.up):
            self._powers(2 * len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=self.sums[1:])

    def hash(self, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        return mix((self.sums[z] - self.sums[a]) * self.down[a] + (z - a).astype(np.uint64))


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = len(v) - width + 1
    full = -(-len(v) // width) * width
    padded = np.full(full, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(v)] = v
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def winnow(data: np.ndarray, owner: np.ndarray, rolling: Rolling, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of starts with one mark: (mark hash, context hash, first start, number of starts).

    ``owner`` numbers the text of each byte; only strings inside one text count.
    """
    width = length - gram + 1
    rolling.load(data)
    at = np.arange(len(data) - gram + 1)
    hashes = rolling.hash(at, at + gram)
    least = _sliding_least((hashes & _HIGH) | at.astype(np.uint64), width)
    start = np.flatnonzero(owner[: len(data) - length + 1] == owner[length - 1 :])
    mark = (least[start] & _LOW).astype(np.int64)
    new = np.concatenate(([True], (mark[1:] != mark[:-1]) | (start[1:] != start[:-1] + 1)))
    head = np.flatnonzero(new)
    first, mark = start[head], mark[head]
    span = np.diff(np.concatenate((head, [len(start)])))
    context = rolling.hash(first, first + span + length - 1)
    place = mark - first
    return hashes[mark], mix(context + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first, span


def _folded(text: np.ndarray, mark: np.ndarray, context: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal neighbours at equal steps of one text as one row: (row numbers, step, repeats)."""
    step = np.diff(first, prepend=-1)
    same = np.zeros(len(mark), bool)
    same[1:] = (mark[1:] == mark[:-1]) & (context[1:] == context[:-1]) & (text[1:] == text[:-1])
    same[2:] &= ~same[1:-1] | (step[2:] == step[1:-1])
    head = np.flatnonzero(~same)
    repeats = np.diff(np.concatenate((head, [len(mark)])))
    return head, np.where(repeats > 1, step[np.minimum(head + 1, len(step) - 1)], 0), repeats


_RUNS = "mark long, context long, key long, key2 long, place long, again long, copies int"


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """Buffers of about ``PIECE`` bytes: (bytes, number of their text, offset in it).

    A longer text goes in pieces that overlap, so that every start lies in one
    of them; a run may be cut where pieces meet, which makes two contexts of it
    and loses no string.
    """
    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for i, data in enumerate(texts):
        for a in range(0, len(data) - length + 1, PIECE):
            part = data[a : a + PIECE + length - 1]
            if size and size + len(part) > PIECE:
                yield held
                held, size = ([], [], []), 0
            for column, x in zip(held, (part, i, a), strict=True):
                column.append(x)
            size += len(part)
    if size:
        yield held


def _scan(length: int, gram: int):
    """place packs (first start, starts), again packs (step, repeats); copies are equal texts of the batch."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rolling = Rolling(PIECE + 2 * length)
        for b in batches:
            keys, where, copies = np.unique(b[["key", "key2"]].to_numpy(), axis=0, return_index=True, return_counts=True)
            texts = [b["text"].iloc[i].encode("utf-8", "surrogatepass") for i in where]
            for parts, number, offset in _pieces(texts, length):
                sizes = [len(p) for p in parts]
                owner = np.repeat(np.arange(len(parts)), sizes)
                begin = np.cumsum([0, *sizes[:-1]])
                mark, context, first, span = winnow(np.frombuffer(b"".join(parts), np.uint8), owner, rolling, length, gram)
                part = owner[first]
                first = first - begin[part] + np.array(offset)[part]
                row, step, repeats = _folded(part, mark, context, first)
                text = np.array(number)[part[row]]
                yield pd.DataFrame({
                    "mark": mark[row].view(np.int64), "context": context[row].view(np.int64),
                    "key": keys[text, 0], "key2": keys[text, 1],
                    "place": first[row] << 16 | span[row], "again": step << 31 | repeats, "copies": copies[text].astype(np.int32)})

    return scan


def suffix_array(data: np.ndarray) -> np.ndarray:
    """The suffixes of the bytes in order (Larsson-Sadakane refinement)."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = head
    sorted_to = 8
    while True:
        tied = ~new
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        suffix = order[at]
        # A suffix that ends before the next step is a prefix of those it ties with, and comes first.
        ends = suffix + sorted_to >= n
        second = np.where(ends, n - suffix, rank[np.where(ends, 0, suffix + sorted_to)] + n + 1)
        both = (head[at].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        by = np.argsort(both, kind="stable")
        order[at], both = suffix[by], both[by]
        fresh = np.ones(len(at), bool)
        fresh[1:] = both[1:] != both[:-1]
        new[at] = fresh
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[at]] = head[at]
        sorted_to *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix of the array shares with the one before it, up to ``most``.

    Kasai's rule, vectorised: a suffix shares at least what the suffix before it
    in the text shares, less one. Every 32nd position is compared from scratch;
    those half-way between two known ones start at the rule's bound.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1))
    shared = np.zeros(n, np.int64)

    def extend(at: np.ndarray, start: np.ndarray) -> None:
        other = before[at]
        going = np.flatnonzero(other >= 0)
        length = np.minimum(start, most)
        length[other < 0] = 0
        while len(going):
            a, b = at[going] + length[going], other[going] + length[going]
            room = np.minimum(n - np.maximum(a, b), most - length[going])
            x = words[np.minimum(a, n - 1)] != words[np.minimum(b, n - 1)]
            same = np.where(x.any(1), x.argmax(1), 8)
            gain = np.minimum(same, np.maximum(room, 0))
            length[going] += gain
            going = going[(gain == 8) & (room > 8)]
        shared[at] = length

    extend(np.arange(0, n, 32), np.zeros(len(range(0, n, 32)), np.int64))
    gap = 16
    while gap:
        at = np.arange(gap, n, 2 * gap)
        extend(at, np.maximum(shared[at - gap] - gap, 0))
        gap //= 2
    out = shared[order]
    out[:1] = 0
    return out


def _classes(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """The duplicated starts of one shard's contexts, and for salted marks their classes' digests."""
    frame = frame.drop_duplicates(["mark", "context"])
    sizes = np.array([len(x) for x in frame["data"]])
    data = np.frombuffer(b"".join(frame["data"]), np.uint8)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    order = suffix_array(data)
    shared = common_prefixes(data, order, length)
    group = np.cumsum(shared < length)
    row = np.searchsorted(begin, order, side="right") - 1
    start = order - begin[row]
    owned = start < sizes[row] - length + 1
    group, row, start = group[owned], row[owned], start[owned]
    copies = frame["copies"].to_numpy()
    if not len(group):
        return pd.DataFrame({"mark": [], "context": [], "low": [], "high": [], "digest": [], "weight": []})
    weight = np.bincount(group, copies[row])[group].astype(np.int64)
    salted = (frame["salts"].to_numpy() > 1)[row]
    mark, context = frame["mark"].to_numpy(), frame["context"].to_numpy()
    out = [_ranges(mark[row], context[row], row, start, weight > 1)]
    if salted.any():
        rolling = Rolling(len(data))
        rolling.load(data)
        places = begin[row] + start
        digest = rolling.hash(places, places + length).view(np.int64)
        # One report per class; a class that is still single names its start.
        one = salted & np.concatenate(([True], group[1:] != group[:-1]))
        out.append(pd.DataFrame({
            "mark": mark[row[one]], "context": context[row[one]], "low": start[one], "high": start[one] + 1,
            "digest": digest[one], "weight": weight[one]}))
    return pd.concat(out, ignore_index=True)


def _ranges(mark: np.ndarray, context: np.ndarray, row: np.ndarray, start: np.ndarray, chosen: np.ndarray) -> pd.DataFrame:
    """The chosen starts as ranges [low, high) per context."""
    row, start, mark, context = row[chosen], start[chosen], mark[chosen], context[chosen]
    by = np.lexsort((start, row))
    row, start, mark, context = row[by], start[by], mark[by], context[by]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.concatenate((head[1:], [len(row)])) - 1
    return pd.DataFrame({
        "mark": mark[head], "context": context[head], "low": start[head], "high": start[tail] + 1 if len(head) else start[head],
        "digest": np.zeros(len(head), np.int64), "weight": np.zeros(len(head), np.int64)})


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Single classes of one shard that another shard reports too, found by binary search among the digests."""

    def work(frame: pd.DataFrame, _: np.ndarray) -> pd.DataFrame:
        digest, weight = frame["digest"].to_numpy(), frame["weight"].to_numpy()
        total = np.concatenate(([0], np.cumsum(weight)))
        lower, upper = np.searchsorted(digest, digest), np.searchsorted(digest, digest, side="right")
        met = (weight == 1) & (total[upper] - total[lower] > 1)
        return frame.loc[met, ["mark", "context", "low", "high"]]

    yield from grouped(batches, ["digest"], work, 8192)


def duplicated_starts(members: DataFrame, texts: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(mark, context, low, high): ranges of starts, counted from the context's first byte, whose strings occur elsewhere."""
    spark = members.sparkSession
    repeats = F.col("again").bitwiseAND(F.lit((1 << 31) - 1))
    contexts = members.groupBy("mark", "context").agg(
        F.sum(repeats * F.col("copies")).alias("copies"), F.min(F.struct("key", "key2", "place")).alias("source"))
    contexts = materialize(contexts, "suffix-contexts")
    many = contexts.groupBy("mark").agg(F.ceil(F.count("*") / F.lit(shard)).cast("int").alias("salts"))
    dealt = contexts.join(many, "mark").withColumn("salt", F.pmod("context", F.col("salts")).cast("int"))
    wanted = dealt.groupBy(F.col("source.key").alias("key"), F.col("source.key2").alias("key2")).agg(
        F.collect_list(F.struct("mark", "context", F.col("source.place").alias("place"), "copies", "salts", "salt")).alias("wanted"))
    # Of rows with equal texts, the one with the least id is read.
    heads = texts.groupBy("key", "key2").agg(F.min("doc_id").alias("head"))
    wanted = wanted.join(heads, ["key", "key2"])
    same = (texts["key"] == wanted["key"]) & (texts["key2"] == wanted["key2"])
    read = texts.join(wanted, same & texts["doc_id"].eqNullSafe(wanted["head"]))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("wanted")
            rows = lists.flatten()
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            place = rows.field("place").to_numpy()
            first, size = (place >> 16).tolist(), ((place & 0xFFFF) + length - 1).tolist()
            rest = [rows.field(c) for c in ("mark", "context", "copies", "salts", "salt")]
            done = 0
            for text, end in zip(b.column("text"), ends.tolist(), strict=True):
                data = text.as_buffer()
                for lo in range(done, end, 4096):
                    hi = min(end, lo + 4096)
                    cut = pa.array([data[a : a + n].to_pybytes() for a, n in zip(first[lo:hi], size[lo:hi], strict=True)], pa.binary())
                    yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in rest), cut], names=[*"mark context copies salts salt".split(), "data"])
                done = end

    schema = "mark long, context long, copies long, salts int, salt int, data binary"
    fetched = read.select("text", "wanted").mapInArrow(fetch, schema)
    shards = fetched.repartition(tasks(spark), "mark", "salt").sortWithinPartitions("mark", "salt")

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from grouped(batches, ["mark", "salt"], lambda frame, _: _classes(frame, length), SHARD_ROWS)

    schema = "mark long, context long, low int, high int, digest long, weight long"
    found = materialize(shards.mapInPandas(build, schema), "suffix-classes")
    reports = found.where("weight > 0").repartition(tasks(spark), "digest").sortWithinPartitions("digest")
    merged = reports.mapInPandas(_merge, "mark long, context long, low int, high int")
    return found.where("weight = 0").select("mark", "context", "low", "high").union(merged)


def removed_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """(key, key2, spans): per distinct text with duplicated strings, the byte intervals of its runs, unmerged.

    ``rows`` has (doc_id, key, key2, text); the two hashes together name a text.
    """
    runs = materialize(rows.select("key", "key2", "text").mapInPandas(_scan(length, gram), _RUNS), "suffix-runs")
    shared = runs.groupBy("mark").agg(F.sum(F.col("again").bitwiseAND(F.lit((1 << 31) - 1)) * F.col("copies")).alias("n")).where("n > 1")
    members = materialize(runs.join(shared.select("mark"), "mark"), "suffix-members")
    starts = duplicated_starts(members, rows, length, shard)
    hits = members.select("mark", "context", "key", "key2", "place", "again").distinct().join(starts, ["mark", "context"])
    return hits.groupBy("key", "key2").agg(F.collect_list(F.struct("place", "again", "low", "high")).alias("spans"))


def _cut(length: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, text, spans in zip(b["doc_id"], b["text"], b["spans"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                if spans is None or not len(spans):
                    out.append((doc, len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                    continue
                place, again, low, high = (np.array([s[c] for s in spans], np.int64) for c in ("place", "again", "low", "high"))
                repeats = again & ((1 << 31) - 1)
                nth = np.arange(repeats.sum()) - np.repeat(np.cumsum(repeats) - repeats, repeats)
                shift = np.repeat(place >> 16, repeats) + nth * np.repeat(again >> 31, repeats)
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, shift + np.repeat(low, repeats), 1)
                np.add.at(edge, shift + np.repeat(high, repeats) + length - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                n_spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                out.append((doc, len(data), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return cut


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every document row."""
    text = text_or_empty(F.col("text"))
    keys = row_key(text)
    rows = docs.select("doc_id", keys[0].alias("key"), keys[1].alias("key2"), text.alias("text"))
    spans = removed_spans(rows, length, gram, shard)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.join(spans, ["key", "key2"], "left").select("doc_id", "text", "spans").mapInPandas(_cut(length), schema)

# Every string of LENGTH bytes is grouped with its equals; spans are cut out of the hexadecimal text.
ORACLE = f"""
with texts as (
  select row_number() over () as k, doc_id, b, octet_length(b) as n_bytes, hex(b) as h
  from (select doc_id, encode(coalesce(text, '')) as b from documents)
),
starts as (
  select k, p, b[p : p + {LENGTH - 1}] as w
  from (select k, b, unnest(range(1, greatest(n_bytes - {LENGTH - 2}, 1))) as p from texts)
),
twice as (select k, p from (select k, p, count(*) over (partition by w) as n from starts) where n > 1),
ends as (
  select k, p, max(p + {LENGTH - 1}) over (partition by k order by p rows between unbounded preceding and 1 preceding) as covered from twice
),
runs as (select k, p, sum(case when covered is null or p > covered + 1 then 1 else 0 end) over (partition by k order by p) as run from ends),
spans as (select k, min(p) as a, max(p) + {LENGTH - 1} as z from runs group by k, run),
gaps as (select k, a, z, lag(z, 1, 0) over (partition by k order by a) as before from spans),
cut as (
  select k, count(*) as n_spans, sum(z - a + 1) as n_removed, max(z) as last_z,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before - 1)), '' order by a) as kept
  from gaps join texts using (k) group by k
)
select doc_id, cast(n_bytes as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(case when n_spans is null then b else unhex(kept || substr(h, 2 * last_z + 1)) end) as kept_sha256
from texts left join cut using (k)
"""
