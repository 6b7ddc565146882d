"""Regex join of ads with a taxonomy relation, by an index over the aliases' rarest grams.

``extract.regex_skill_matches`` unrolls a fixed taxonomy into one expression.
Here the taxonomy is a DataFrame (skill, pattern_order, pattern) of any size, and
the join is one of equal keys:

1. Every alias has an anchor, a literal that each of its matches contains. Of the
   anchor's byte grams (of the largest of ``WIDTHS`` that the anchor has) the one
   that is rarest in the texts becomes the alias's key, as a 64-bit hash.
2. Every text emits its distinct grams, once, as far as they may be keys: a bit
   table of the keys is broadcast to the scan (``BITS`` bits, whatever the taxonomy).
3. An equi-join on the gram gives candidate (ad, alias) pairs; each alias has one
   key, so a pair comes up once.
4. Candidates meet their ad's text by row key, and the regex decides. Where a
   match's length is bounded, it runs only from the key's first to its last place
   in the text, with as much text on either side as a match can take.

A key that many texts hold, such as a one-letter anchor, is salted over all shuffle
partitions, on both sides; so is the key of aliases without an anchor, whose regex
has to run on every text. One hash for two grams only adds candidates. How rare a
gram is, is taken from ``STATISTICS_ROWS`` texts; the choice affects speed, not rows.

Rows are as those of ``regex_skill_matches``; aliases with a NULL part are left out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillgrid.functions import regex as regex_dialects
from skillgrid.functions import text as tx
from skillgrid.operators.extract import MATCH_COLUMNS, dedupe_matches, prefilter_text
from skillgrid.session import materialize

# Task code travels by value: executors need only public libraries.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(regex_dialects)

WIDTHS = (1, 2, 3, 4, 6, 8, 12)  # bytes of a gram
BITS = 1 << 25  # of the broadcast table: 4 MB
NO_ANCHOR = 0  # the key of aliases that every text has to be tested for; no gram has it
STATISTICS_ROWS = 20_000
HOT_SHARE = 1 / 64  # of the texts; keys in more of them are salted
PIECE = 1 << 20  # bytes whose grams are made at once
_BASE = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash (never 0) of every run of ``width`` bytes."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = h * _BASE + data[k : k + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h | np.uint64(1)


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def _known(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - 25)
    return (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def gram_spans(texts: list[str], table: np.ndarray, widths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (text number, gram hash, first, last): the distinct grams of every text that the bit table knows.

    ``first`` and ``last`` are the code points of the text in which the gram
    begins for the first and for the last time. Texts are strung together up to
    ``PIECE`` bytes; a gram that runs over a text's end counts as the text's,
    which adds a candidate or widens a span at most.
    """
    held: list[np.ndarray] = []
    first = size = 0

    def block(first: int, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        data = np.concatenate(parts)
        starts = np.cumsum([0] + [len(p) for p in parts])[:-1]
        points = np.cumsum([0] + [len(t) for t in texts[first : first + len(parts)]])[:-1]
        numbers, grams, places = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        passed = -1
        for a in range(0, len(data), PIECE):
            point = np.cumsum((data[a : a + PIECE] & 0xC0) != 0x80) + passed
            passed = point[-1]
            for w in widths:
                hashes = gram_hashes(data[a : a + PIECE + w - 1].astype(np.uint64), w)
                at = np.flatnonzero(_known(hashes, table))
                number = np.searchsorted(starts, at + a, side="right") - 1
                numbers.append(number)
                grams.append(hashes[at])
                places.append(point[at] - points[number])
        number, gram, place = np.concatenate(numbers), np.concatenate(grams), np.concatenate(places)
        order = np.lexsort((place, gram, number))
        number, gram, place = number[order], gram[order], place[order]
        new = np.ones(len(gram) + 1, bool)
        new[1:-1] = (gram[1:] != gram[:-1]) | (number[1:] != number[:-1])
        return first + number[new[:-1]], gram[new[:-1]], place[new[:-1]], place[new[1:]]

    for i, t in enumerate(texts):
        if held and size + len(t) > PIECE:
            yield block(first, held)
            held, size = [], 0
        if not held:
            first = i
        held.append(_bytes(t))
        size += len(held[-1])
    if held:
        yield block(first, held)


def text_grams(texts: list[str], table: np.ndarray, widths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``gram_spans`` without the spans."""
    for number, gram, _first, _last in gram_spans(texts, table, widths):
        yield number, gram


def anchored(patterns: DataFrame, dialect: str = "re2") -> DataFrame:
    """(skill, pattern_order, java, anchor, reach) of a taxonomy relation (skill, pattern_order, pattern)."""

    def translate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({
                "skill": b["skill"].astype(object), "pattern_order": b["pattern_order"],
                "java": pd.Series([regex_dialects.to_java(p, dialect) for p in b["pattern"]], dtype=object),
                "anchor": pd.Series([regex_dialects.literal_anchor(p) for p in b["pattern"]], dtype=object),
                "reach": pd.array([regex_dialects.match_reach(p) for p in b["pattern"]], dtype="Int32"),
            })

    rows = patterns.select("skill", F.col("pattern_order").cast("int").alias("pattern_order"), "pattern").dropna()
    return rows.mapInPandas(translate, "skill string, pattern_order int, java string, anchor string, reach int")


def _grams(aliases: DataFrame) -> DataFrame:
    """Every gram of every alias's anchor: the alias's columns, ``width`` and ``gram``; aliases without anchor left out."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            data = [_bytes(a) for a in b["anchor"]]
            widths = np.array([max(w for w in WIDTHS if w <= len(d)) for d in data], np.int64)
            grams = [np.unique(gram_hashes(d.astype(np.uint64), w)) for d, w in zip(data, widths.tolist(), strict=True)]
            rows = b.loc[b.index.repeat([len(x) for x in grams])].reset_index(drop=True)
            rows["width"] = np.repeat(widths, [len(x) for x in grams])
            rows["gram"] = (np.concatenate(grams) if grams else np.zeros(0, np.uint64)).view(np.int64)
            yield rows

    schema = "skill string, pattern_order int, java string, anchor string, reach int, width long, gram long"
    return aliases.where("anchor is not null").mapInPandas(split, schema)


def _bit_table(grams: DataFrame):
    """The grams as a broadcast table of ``BITS`` bits, OR-ed by Spark, and the gram widths in use."""
    bit = F.shiftrightunsigned("gram", 64 - 25)
    mask = F.expr("shiftleft(1L, cast(shiftrightunsigned(gram, 39) & 63 as int))")
    rows = grams.groupBy(F.shiftrightunsigned(bit, 6).alias("word")).agg(F.bit_or(mask).alias("mask")).toPandas()
    table = np.zeros(BITS // 64, np.uint64)
    table[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    widths = sorted(r.width for r in grams.select("width").distinct().collect())  # those of WIDTHS at most
    return grams.sparkSession.sparkContext.broadcast((table, widths))


def _emit(texts: DataFrame, bits, columns: str) -> DataFrame:
    """The key columns of every text with each of its grams that the bit table knows, and the gram's first and last place."""
    names = [c.split()[0] for c in columns.split(", ")]

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, widths = bits.value
        for batch in batches:
            for number, gram, first, last in gram_spans(batch["_folded"].tolist(), table, widths):
                rows = batch[names].iloc[number].reset_index(drop=True)
                rows["gram"], rows["first"], rows["last"] = gram.view(np.int64), first, last
                yield rows

    return texts.mapInPandas(emit, f"{columns}, gram long, first int, last int")


def alias_index(patterns: DataFrame, texts: DataFrame, dialect: str = "re2") -> DataFrame:
    """(gram, width, skill, pattern_order, java, anchor, reach, hot): each alias under the rarest gram of its anchor.

    ``texts`` has a column ``_folded``; its grams are counted in a sample of
    about ``STATISTICS_ROWS`` rows. ``hot`` marks keys that many texts hold.
    """
    aliases = materialize(anchored(patterns, dialect), "aliases")
    grams = materialize(_grams(aliases), "alias-grams")
    rows = texts.count()
    sample = texts.select("_folded").sample(min(1.0, STATISTICS_ROWS / max(1, rows)), seed=1)
    seen = _emit(sample.withColumn("one", F.lit(1)), _bit_table(grams), "one int")
    statistics = seen.groupBy("gram").agg(F.count("*").alias("texts"))
    rated = grams.join(statistics, "gram", "left").withColumn("texts", F.coalesce("texts", F.lit(0).cast("long")))
    best = rated.groupBy("skill", "pattern_order", "java", "anchor", "reach", "width").agg(F.min(F.struct("texts", "gram")).alias("k"))
    keyed = best.select(
        F.col("k.gram").alias("gram"), "width", "skill", "pattern_order", "java", "anchor", "reach",
        (F.col("k.texts") > HOT_SHARE * min(rows, STATISTICS_ROWS)).alias("hot"),
    )
    bare = aliases.where("anchor is null").select(
        F.lit(NO_ANCHOR).cast("long").alias("gram"), F.lit(0).cast("long").alias("width"), "skill", "pattern_order", "java", "anchor", "reach", F.lit(True).alias("hot"))
    return materialize(keyed.unionByName(bare), "alias-index")


def numbered(ads: DataFrame) -> DataFrame:
    """Ads read from files, with a row key (``_file``, ``_row``) that every scan gives alike."""
    return ads.select("*", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def candidates(texts: DataFrame, index: DataFrame) -> DataFrame:
    """(_file, _row, first, last, skill, pattern_order, java, anchor, reach): the pairs whose regex has to be run, each once.

    The alias's key is in the text from the code point ``first`` to ``last``; null where no key or no place is known.
    """
    salts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    emitted = _emit(texts, _bit_table(index.where(F.col("gram") != NO_ANCHOR)), "_file long, _row long, _aligned boolean")
    known = lambda c: F.when(F.col("_aligned"), F.col(c)).alias(c)
    emitted = emitted.select("_file", "_row", "gram", known("first"), known("last"))
    if index.where(F.col("gram") == NO_ANCHOR).limit(1).count():
        emitted = emitted.unionByName(texts.select(
            "_file", "_row", F.lit(NO_ANCHOR).cast("long").alias("gram"), *[F.lit(None).cast("int").alias(c) for c in ("first", "last")]))
    # A key in over HOT_SHARE of the texts: there are at most 1 / HOT_SHARE times the grams of a text of them.
    hot = index.where("hot").select("gram").distinct().withColumn("_hot", F.lit(True))
    emitted = emitted.join(F.broadcast(hot), "gram", "left")
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("_file", "_row"), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    spread = F.explode(F.sequence(F.lit(0), F.when(F.col("hot"), F.lit(salts - 1)).otherwise(F.lit(0))))
    left = emitted.select("_file", "_row", "gram", "first", "last", salt.alias("salt"))
    right = index.select("gram", "skill", "pattern_order", "java", "anchor", "reach", spread.alias("salt"))
    return left.join(right, ["gram", "salt"]).select("_file", "_row", "first", "last", "skill", "pattern_order", "java", "anchor", "reach")


def found_matches(ads: DataFrame, patterns: DataFrame, dialect: str = "re2") -> DataFrame:
    """Per-ad matches before the id dedupe, for a taxonomy relation of any size.

    ``ads`` must be read from files (their rows are told apart by file and place).
    """
    whole = tx.search_text(F.col("headline"), F.col("description_text"))
    keyed = numbered(ads.select("id", "publication_month", "headline", "description_text"))
    folded = prefilter_text(whole, dialect)
    # Folding keeps the places of characters unless it makes one of them two.
    texts = keyed.select("_file", "_row", whole.alias("_search"), folded.alias("_folded"))
    texts = texts.select("_file", "_row", "_folded", (F.length("_search") == F.length("_folded")).alias("_aligned"))
    pairs = candidates(texts, alias_index(patterns, texts, dialect))
    # What a match row shows is made once per ad, not once per candidate.
    snippet = tx.snippet_from_head(tx.snippet_head(F.col("description_text")), F.col("description_text"))
    shown = keyed.select("_file", "_row", "id", "publication_month", "headline", snippet.alias("description_snippet"), whole.alias("_search"))
    # A match holds the alias's key: with its length bounded, it is near one of the key's places.
    begin = "greatest(1, first - reach)"
    near = F.expr(f"if(first + reach is null, _search, substring(_search, {begin}, last + reach + 3 - {begin}))")
    # One search tells whether and what: an empty string is no match, but for an alias without an anchor.
    bare = F.col("anchor").isNull()
    found = F.when(~bare | F.rlike(F.col("_search"), F.col("java")), F.call_function("regexp_extract", near, F.col("java"), F.lit(0)))
    # Few bytes, much regex work: a number of partitions of its own keeps AQE from merging them.
    width = int(ads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(width, "_file", "_row")
    met = dealt.join(shown.repartition(width, "_file", "_row"), ["_file", "_row"])
    # A generator keeps the search out of the filter, which would run it again.
    hits = met.withColumn("matched_text", F.explode_outer(F.array(found)))
    hits = hits.where(F.col("matched_text").isNotNull() & (bare | (F.col("matched_text") != "")))
    return hits.select(
        "id", "publication_month", "headline", "description_snippet", "skill", "pattern_order",
        tx.trim_space_separators(F.col("matched_text")).alias("matched_text"),
    )


def regex_skill_matches(ads: DataFrame, patterns: DataFrame, dialect: str = "re2") -> DataFrame:
    """``historical_regex_skill_matches`` for a taxonomy relation: one row per (id, skill), first alias first."""
    return dedupe_matches(found_matches(ads, patterns, dialect)).select(*MATCH_COLUMNS)


def word_taxonomy(texts: DataFrame, key: str, column: str, shortest: int = 7, least: int = 2, most: int = 3) -> DataFrame:
    """A taxonomy made from a corpus: words of ``least`` to ``most`` texts as whole-word aliases, a skill per first two letters."""
    found = F.regexp_extract_all(F.lower(column), F.lit(f"([a-z]{{{shortest},}})"), F.lit(1))
    words = texts.select(F.col(key).alias("t"), F.explode(F.array_distinct(found)).alias("w"))
    rare = words.groupBy("w").agg(F.count_distinct("t").alias("n")).where(F.col("n").between(least, most))
    skill = F.concat(F.lit("words_"), F.substring("w", 1, 2))
    order = F.row_number().over(Window.partitionBy(skill).orderBy("w")) - 1
    return rare.select(skill.alias("skill"), order.alias("pattern_order"), F.concat(F.lit("\\b"), "w", F.lit("\\b")).alias("pattern"))
