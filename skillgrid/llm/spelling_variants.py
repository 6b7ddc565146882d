"""Spelling variant grouping: Bloom-guided neighbourhoods over the vocabulary of a corpus.

Method: the vocabulary (distinct words with their counts) is written once. For
every word length, a blocked Bloom filter of its words is built by Spark: a word
sets one bit in each of eight 32-bit lanes of one block, and lanes are OR-ed
map-side. The filters are broadcast; they take at most ``FILTER_BYTES``
together, a fixed size. Each word then generates its neighbours of one deleted
code point, and of one replaced by a larger one, and probes the filter of the
neighbour's length (a word's insertions are the deletions of the longer word,
its other replacements those of the other word). Only neighbours that a filter
knows are shuffled, to an equi-join with the vocabulary that removes the false
ones. A vocabulary too large for the filters only lets more neighbours through
to the join; the result is the same.

A word's form is its near word of the largest count (ties: the smallest word) if
that count is ``RATIO`` times its own or more. Counts grow along forms, so forms
end; roots are handed down from the ends, one join per step, in which a word
meets only the words whose form it is (its near words at most).

Scale: the text is scanned once and counted with map-side sums. Neighbours
exist only inside a task, a block of words at a time, as 64-bit hashes; strings
are made for those that pass. No word has more near words than its neighbours,
so no key grows with the corpus.

Defined results: null and empty texts have no words; ids are hashed as text (a
null id as the empty one); repeated rows count each; an empty table gives an
empty result; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgrid.llm.common import materialize, text_or_empty

LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_POINTS, LEAST_COUNT, RATIO = 6, 5, 5
TYPO_EVERY = 199
FILTER_BYTES = 32 << 20  # all filters together, whatever the vocabulary
BITS_PER_WORD = 16
LANES = 8
LONGEST = 64  # words of more code points share one filter
BLOCK = 1 << 19  # neighbours probed at once
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def words_of(docs: DataFrame) -> DataFrame:
    """(word) of every letter run, A-Z lower-cased; every 199th (by crc32 of id and run) loses a code point."""
    text = F.translate(text_or_empty(F.col("text")), UPPER, UPPER.lower())
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    runs = docs.select(key.alias("k"), F.explode(F.regexp_extract_all(text, F.lit(f"({LETTERS})"), F.lit(1))).alias("run"))
    runs = runs.where(F.length("run") >= LEAST_POINTS).withColumn("h", F.crc32(F.concat("k", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % TYPO_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counted = words.where(F.length("word") >= LEAST_POINTS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words strung together, and each word's first."""
    joined = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return joined, np.cumsum([0] + [len(w) for w in words])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(1, n), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _hash(words: list[str]) -> np.ndarray:
    """The sum of code point times power of its place, modulo 2^64."""
    points, at = _points(words)
    lengths = np.diff(at)
    place = np.arange(len(points)) - np.repeat(at[:-1], lengths)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(points * _powers(int(lengths.max(initial=1)))[place], dtype=np.uint64)))
    return sums[at[1:]] - sums[at[:-1]]


def _block_and_lanes(hashes: np.ndarray, blocks: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """A word's block (of a power of two) and its bit in each lane."""
    x = _mix(hashes)
    block = (x >> np.uint64(32)) & np.asarray(blocks - 1, np.uint64)
    y = _mix(x)
    lanes = (y[:, None] >> np.arange(0, 5 * LANES, 5, dtype=np.uint64)) & np.uint64(31)
    return block.astype(np.int64), lanes


class BloomFilters:
    """One blocked Bloom filter per word length (those over ``LONGEST`` share one), in one array."""

    def __init__(self, sizes: dict[int, int], filter_bytes: int = FILTER_BYTES):
        wanted = {k: _power_of_two(n * BITS_PER_WORD / (32 * LANES)) for k, n in sizes.items()}
        while sum(wanted.values()) * 4 * LANES > filter_bytes and max(wanted.values(), default=1) > 1:
            wanted = {k: max(1, b // 2) for k, b in wanted.items()}
        self.blocks = wanted
        self.first = dict(zip(wanted, np.cumsum([0, *wanted.values()])[:-1].tolist(), strict=True))
        self.lanes = np.zeros((0, LANES), np.uint32)

    def fill(self, blocks: np.ndarray, lanes: np.ndarray) -> BloomFilters:
        self.lanes = np.zeros((sum(self.blocks.values()), LANES), np.uint32)
        self.lanes[blocks] = lanes
        return self

    def places(self, shard: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block, lanes = _block_and_lanes(hashes, self.blocks[shard])
        return block + self.first[shard], lanes

    def holds(self, shard: int, hashes: np.ndarray) -> np.ndarray:
        if shard not in self.blocks:
            return np.zeros(len(hashes), bool)
        block, lanes = self.places(shard, hashes)
        known = np.ones(len(hashes), bool)
        for k in range(LANES):
            known &= (self.lanes[block, k] >> lanes[:, k].astype(np.uint32)) & np.uint32(1) == 1
        return known


def _power_of_two(x: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, x)))))


def _shard(length: int) -> int:
    return min(length, LONGEST + 1)


def bloom_filters(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> BloomFilters:
    """Filters of a vocabulary: bits are OR-ed by Spark, at most ``filter_bytes`` of blocks are fetched."""
    shard = F.least(F.length("word"), F.lit(LONGEST + 1))
    sizes = {r.shard: r.n for r in words.groupBy(shard.alias("shard")).agg(F.count("*").alias("n")).collect()}
    empty = BloomFilters(sizes, filter_bytes)

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = _hash(batch["word"].tolist())
            shards = np.minimum(batch["word"].str.len().to_numpy(), LONGEST + 1)
            for s in np.unique(shards).tolist():
                block, lanes = empty.places(s, hashes[shards == s])
                # Two 32-bit lanes travel in one long.
                masks = (np.uint64(1) << lanes).astype(np.uint64)
                pairs = (masks[:, ::2] | masks[:, 1::2] << np.uint64(32)).view(np.int64)
                yield pd.DataFrame({"block": block, **{f"m{k}": pairs[:, k] for k in range(LANES // 2)}})

    lanes = [f"m{k}" for k in range(LANES // 2)]
    made = words.select("word").mapInPandas(bits, "block long, " + ", ".join(f"{m} long" for m in lanes))
    rows = made.groupBy("block").agg(*[F.bit_or(m).alias(m) for m in lanes]).toPandas()
    pairs = np.ascontiguousarray(rows[lanes].to_numpy(np.int64)).view(np.uint32).reshape(len(rows), LANES)
    return empty.fill(rows["block"].to_numpy(np.int64), pairs)


def neighbours(words: list[str], filters: BloomFilters, alphabet: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (word number, place, code point or 0 for a deletion) of the neighbours that a filter knows.

    ``alphabet`` has the sorted code points of the vocabulary's words by length.
    """
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, numbers in by_length.items():
        letters = alphabet.get(_shard(length), np.zeros(0, np.uint64))
        power = _powers(length + 1)
        deletions, replacements = _shard(length - 1), _shard(length)
        step = max(1, BLOCK // (length * max(1, len(letters))))
        for a in range(0, len(numbers), step):
            chosen = np.array(numbers[a : a + step])
            points = _points([words[i] for i in chosen])[0].reshape(len(chosen), length)
            terms = points * power[:length]
            whole = terms.sum(axis=1, dtype=np.uint64)
            # Without code point k: what lies before it, and what lies after it one place earlier.
            before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
            shifted = np.zeros_like(points)
            shifted[:, 1:] = points[:, 1:] * power[: length - 1]
            after = shifted.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(shifted, axis=1, dtype=np.uint64)
            fresh = np.ones(points.shape, bool)  # within a stretch of one letter all deletions are alike
            fresh[:, 1:] = points[:, 1:] != points[:, :-1]
            row, place = np.nonzero(fresh)
            known = filters.holds(deletions, (before + after)[row, place])
            if known.any():
                yield chosen[row[known]], place[known], np.zeros(int(known.sum()), np.uint64)
            for c0 in range(0, length, max(1, BLOCK // max(1, len(letters) * len(chosen)))):
                c1 = min(length, c0 + max(1, BLOCK // max(1, len(letters) * len(chosen))))
                row, place, letter = np.nonzero(letters[None, None, :] > points[:, c0:c1, None])
                place += c0
                new = letters[letter]
                known = filters.holds(replacements, whole[row] + (new - points[row, place]) * power[place])
                if known.any():
                    yield chosen[row[known]], place[known], new[known]


def near_words(vocab: DataFrame, filters: BloomFilters) -> DataFrame:
    """(word, n, near, near_n): every pair of words that differ by one code point, in both directions."""
    shard = F.least(F.length("word"), F.lit(LONGEST + 1))
    letters = vocab.select(shard.alias("shard"), F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''")
    # At most as many rows as lengths times letters.
    found = letters.groupBy("shard").agg(F.array_sort(F.collect_set("c")).alias("cs")).collect()
    alphabet = {r.shard: np.sort(np.array([ord(c) for c in r.cs], np.uint64)) for r in found}
    shared = vocab.sparkSession.sparkContext.broadcast((filters, alphabet))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filters, alphabet = shared.value
        for batch in batches:
            words, counts = batch["word"].tolist(), batch["n"].to_numpy()
            for number, place, point in neighbours(words, filters, alphabet):
                for a in range(0, len(number), 1 << 14):
                    part = slice(a, a + (1 << 14))
                    chosen = [words[i] for i in number[part].tolist()]
                    edits = [
                        w[:k] + (chr(c) if c else "") + w[k + 1 :]
                        for w, k, c in zip(chosen, place[part].tolist(), point[part].tolist(), strict=True)
                    ]
                    yield pd.DataFrame({"word": pd.Series(chosen, dtype=object), "n": counts[number[part]], "edit": pd.Series(edits, dtype=object)})

    edits = vocab.select("word", "n").mapInPandas(probe, "word string, n long, edit string")
    known = vocab.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    pairs = edits.join(known, "edit")
    one = F.struct(F.col("word"), F.col("n"), F.col("edit").alias("near"), F.col("edit_n").alias("near_n"))
    two = F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.select(F.inline(F.array(one, two)))


def forms(vocab: DataFrame, filter_bytes: int = FILTER_BYTES, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word of a vocabulary (word, n)."""
    pairs = near_words(vocab, bloom_filters(vocab, filter_bytes))
    # The largest count, then the smallest word: Spark compares strings by bytes, which is code-point order.
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("b")
    )
    found = vocab.join(best, "word", "left")
    strong = -F.col("b.m") >= F.lit(ratio) * F.col("n")
    return found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("b.near")).alias("form"), F.when(strong, -F.col("b.m")).alias("form_n"),
    )


def with_roots(found: DataFrame) -> DataFrame:
    """Adds ``root``: the last of a word's forms (the word itself if it has none)."""
    found = materialize(found, "spelling-forms")
    steps = found.where("form is not null").select("word", "form")
    level = found.where("form is null").select("word", F.col("word").alias("root"))
    done = level
    while True:
        # A word of this level meets the words whose form it is: its near words at most.
        level = materialize(
            steps.join(level.withColumnRenamed("word", "form"), "form").select("word", "root"), "spelling-roots")
        if level.isEmpty():
            return found.join(done, "word")
        done = done.unionByName(level)


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The contract's rows: (word, form, root, n, n_near, form_n) for the words of all documents."""
    vocab = materialize(vocabulary(words_of(docs)), "spelling-vocabulary")
    return with_roots(forms(vocab)).select("word", "form", "root", "n", "n_near", "form_n")
