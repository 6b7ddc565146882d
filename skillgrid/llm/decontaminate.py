"""Benchmark decontamination by template canonicalisation.

Method: texts become sequences of lower-case word tokens in which numbers (in
digits or words), units after a number and names (capitalised words inside a sentence; a run of
them is one name) are replaced by typed placeholders, so a question asked again
with other numbers or names keeps its template. A text has up to three
readings: this one, one in which a word seen as a name inside a sentence (and
never in lower case) is a name at sentence starts too, and one in lower case
without names, for copies in other case. A line break ends no sentence, an
empty line does. Windows of ``WINDOW`` tokens
are hash-joined with the benchmark's windows; the literal words of a window
must carry it (``LITERALS``); windows of the lower-case reading with fewer are
joined with their values in place of the placeholders, as exact copies. Joined windows that lie on one alignment of a
document and an item are checked for slot consistency: equal names of the item
must be equal names in the document and different ones different. Numbers and
units may coincide, as small numbers asked anew often do; ``n_conflicts``
reports it. Windows whose slots hold the
item's own values need no consistency. Consistent windows of neighbouring alignments (their shifts differ by no more
than the item has words) are taken together, so words put in, left out or
changed do not part a passage. A document is contaminated by an item if the
windows of a passage are at least ``COVER`` of the item's template windows (all
windows, if it has no others than exact ones), or cover at
least ``COVER`` of its words, or if they match ``RUN`` words of it in a row.

Scale: documents are read once, in Arrow batches, and nothing of them is
shuffled but the windows that may match: a bit filter of fixed size
(``FILTER_BITS``, whatever the benchmark's size) over the benchmark's window
hashes travels to the tasks; the equi-join on the 64-bit hash confirms what
passes. A benchmark too large for the filter only lets more windows through to
the join. Counts per (document, item) are combined before the shuffle.

Defined results: null and empty texts hold no tokens and are never
contaminated; an item of fewer than ``WINDOW`` tokens is one window of all its
tokens, exact if it has fewer than ``SHORTEST`` literal words (so an item of one
word is contained wherever that word is); repeated rows and ids are judged row by row, null ids included; an empty
benchmark flags nothing; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgrid.llm.common import materialize, row_key, text_or_empty
from skillgrid.llm.text_hash import mix, word_hashes

WINDOW = 8
LITERALS = 4  # words of a full window that are no placeholders
SHORTEST = 2  # the same for an item shorter than a window
COVER = 0.7
RUN = 13  # words of an item in a row that contaminate, whatever share of the item they are
FILTER_BITS = 1 << 23
# Units that may follow a number.
_UNITS = frozenset(
    "mm cm m km mg g kg t ml l s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks "
    "month months year years inch inches foot feet yard yards mile miles mph kph percent pct usd eur gbp dollar dollars "
    "euro euros cent cents pound pounds ounce ounces gallon gallons liter liters litre litres meter meters metre metres "
    "gram grams kilogram kilograms celsius fahrenheit watt watts volt volts hz khz mhz ghz kb mb gb tb".split()
)
# Number words.
_NUMBER_WORDS = {
    "zero": "0", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10",
    "eleven": "11", "twelve": "12", "thirteen": "13", "fourteen": "14", "fifteen": "15", "sixteen": "16", "seventeen": "17",
    "eighteen": "18", "nineteen": "19", "twenty": "20", "thirty": "30", "forty": "40", "fifty": "50", "sixty": "60",
    "seventy": "70", "eighty": "80", "ninety": "90", "hundred": "100", "thousand": "1000", "million": "1000000",
}
_UPPER = "".join(c for c in map(chr, range(0x41, 0x590)) if c.isupper())
# A number or a capitalised word, with the lower-case word after it (a unit, perhaps).
_MARKED = re.compile(rf"[0-9{_UPPER}][^\W_]*(?:[.,][0-9]+)*(?: [a-z]+)?")
_NUMBER = re.compile(r"[0-9]+(?:[.,][0-9]+)*")
_NUM, _UNIT, _NAME = "\x01", "\x02", "\x03"
_HYPHENS = " \t\r\n-"  # between the words of one name
_BEFORE = " \t\r\n\"'("  # may stand between the end of a sentence and the next one's first word
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n")
_RESERVED = re.compile("[\x01-\x03]")
_TABLE = bytes(c if c > 127 or chr(c).isalnum() or c in (1, 2, 3) else 32 for c in range(256))


def canonical(text: str, names: frozenset[str] = frozenset(), first: set[str] | None = None) -> tuple[bytes, list[str]]:
    """The text's lower-case words with placeholders, separated by blanks, and the placeholders' values in order.

    ``names`` are names at sentence starts too; ``first`` receives the
    capitalised words that begin a sentence.
    """
    text = _RESERVED.sub(" ", text)
    values: list[str] = []
    name_end = -1  # where the last name ended

    def place(m: re.Match) -> str:
        nonlocal name_end
        found, at = m.group(), m.start()
        if at and (text[at - 1].isalnum() or text[at - 1] == "_"):
            return found  # inside a word
        head, _, rest = found.partition(" ")
        if "0" <= head[0] <= "9":
            number = _NUMBER.match(head).group()
            tail = head[len(number) :].lower()
            if tail and tail not in _UNITS:
                return found  # as in "3rd"
            values.append(number)
            unit = tail or (rest if rest in _UNITS else "")
            if unit:
                values.append(unit)
            return f" {_NUM} {_UNIT if unit else ''} {'' if unit and not tail else rest}"
        if name_end >= 0 and not text[name_end:at].strip(_HYPHENS):
            name_end = at + len(head)
            values[-1] += f" {head.lower()}"
            return f" {rest}"
        if head.isupper():
            return found  # letters in capitals
        while at and text[at - 1] in _BEFORE:
            at -= 1
        if (not at or text[at - 1] in ".!?" or _PARAGRAPH.search(text, at, m.start())) and head not in names:
            if first is not None:
                first.add(head)
            return found  # a sentence's first word
        name_end = m.start() + len(head)
        values.append(head.lower())
        return f" {_NAME} {rest}"

    return _MARKED.sub(place, text).lower().encode("utf-8", "surrogatepass").translate(_TABLE), values


_HOLDERS = word_hashes([_NUM.encode(), _UNIT.encode(), _NAME.encode()])[0]
_COUNTED = np.sort(word_hashes([w.encode() for w in _NUMBER_WORDS])[0])
_MEASURED = np.sort(word_hashes([w.encode() for w in sorted(_UNITS)])[0])
_LOWER = re.compile(r"\b[a-z]\w*")
_NAME_PARTS = re.compile(r"[ .,]")


class Reading(NamedTuple):
    """One reading of a text as tokens; places are counted in words of the text, of which a name may have several."""

    words: np.ndarray  # hashes of the tokens
    holders: np.ndarray  # number of placeholders before each token
    places: np.ndarray  # place of each token and the end
    values: list[str]  # of the placeholders
    plain: bool  # without names
    data: bytes  # the tokens themselves


def _readings(text: str) -> list[tuple[bytes, list[str], bool]]:
    """The text's canonical forms that differ, and whether each is without names; the first one is the template."""
    first: set[str] = set()
    data, values = canonical(text, first=first)
    plain, plain_values = canonical(text.lower())
    if values == plain_values:
        return [(data, values, True)]
    out = [(data, values, False)]
    seen = {part for value in values for part in value.split()}
    again = {word for word in first if word.lower() in seen}
    if again:
        lower = set(_LOWER.findall(text))
        again = {word for word in again if word.lower() not in lower}
    if again:
        out.append((*canonical(text, frozenset(again)), False))
    return [*out, (plain, plain_values, True)]


def _with_number_words(hashes: np.ndarray, holder: np.ndarray, data: bytes, values: list[str]) -> tuple[np.ndarray, np.ndarray, bytes, list[str]]:
    """A reading with placeholders for number words, and for units after them, too."""
    numbers = np.isin(hashes, _COUNTED)
    if not numbers.any():
        return hashes, holder, data, values
    units = np.isin(hashes, _MEASURED) & ~holder
    units[0] = False
    units[1:] &= numbers[:-1]
    hashes, tokens, given, out = hashes.copy(), data.split(), iter(values), []
    hashes[numbers], hashes[units] = _HOLDERS[0], _HOLDERS[1]
    for k in np.flatnonzero(holder | numbers | units).tolist():
        if holder[k]:
            out.append(next(given))
        elif numbers[k]:
            out.append(_NUMBER_WORDS[tokens[k].decode()])
            tokens[k] = _NUM.encode()
        else:
            out.append(tokens[k].decode())
            tokens[k] = _UNIT.encode()
    return hashes, holder | numbers | units, b" ".join(tokens), out


def canonical_words(texts: list[str]) -> Iterator[list[Reading]]:
    """The readings of each text."""
    held = [_readings(t) for t in texts]
    hashes, offsets = word_hashes([data for readings in held for data, _, _ in readings])
    holder = np.isin(hashes, _HOLDERS)
    n = 0
    for readings in held:
        out = []
        for data, values, plain in readings:
            a, z = offsets[n], offsets[n + 1]
            n += 1
            words, held_by, data, values = _with_number_words(hashes[a:z], holder[a:z], data, values)
            size = np.ones(z - a, np.int64)
            for k, value in zip(np.flatnonzero(held_by), values, strict=True):
                if words[k] == _HOLDERS[2]:
                    size[k] = len(_NAME_PARTS.split(value))
            before, places = (np.concatenate(([0], np.cumsum(x))) for x in (held_by, size))
            out.append(Reading(words, before, places, values, plain, data))
        yield out


_ROLL = mix(np.arange(1, WINDOW + 1, dtype=np.uint64) * np.uint64(0xB5297A4D3F84D5B5)) | np.uint64(1)


def _window_hashes(words: np.ndarray, holders: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``width`` words and the number of literal words in each."""
    n = len(words) - width + 1
    if n <= 0 or not width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += words[k : k + n] * _ROLL[k]
    return mix(total ^ np.uint64(width)), width - (holders[width:] - holders[:-width])


def _reading_windows(r: Reading, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of a reading's windows, whether they are templates, and whether they can be joined at all."""
    hashes, literals = _window_hashes(r.words, r.holders, width)
    template = literals >= (LITERALS if width == WINDOW else SHORTEST)
    if not r.plain or template.all():
        return hashes, template, template
    words = r.words
    if r.values:
        words = words.copy()
        words[np.flatnonzero(np.diff(r.holders))] = word_hashes([" ".join(r.values).encode()])[0]
    exact, _ = _window_hashes(words, r.holders, width)
    return np.where(template, hashes, exact), template, np.ones(len(hashes), bool)


_ITEM = "n_windows int, n_template int, n_words int, item_at int, item_end int, counts boolean, width int, hash long, item_slots array<string>, slot_kinds array<string>"


_KINDS = {_NAME.encode(): "name", _UNIT.encode(): "unit", _NUM.encode(): "number"}


def _slot_kinds(r: Reading) -> list[str]:
    """What each placeholder stands for."""
    return [_KINDS[x] for x in r.data.split() if x in _KINDS]


def _item_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["item_id", *(c.split()[0] for c in _ITEM.split(", "))]
    for b in batches:
        out = []
        for item, text, readings in zip(b["item_id"], b["text"], canonical_words(b["text"].tolist()), strict=True):
            found = {}
            template: set[int] = set()  # places of the first reading's windows
            for n, r in enumerate(readings):
                # In a document the item's first word may stand inside a sentence, where a capital makes it a name.
                kinds = _slot_kinds(r)
                capital = text.lstrip()[:1].isupper() and len(r.words) > SHORTEST
                skip = int(capital and not r.holders[1])
                width = min(WINDOW, len(r.words) - (0 if r.plain else skip))
                hashes, is_template, use = _reading_windows(r, width)
                for k in np.flatnonzero(use):
                    if k < skip and not r.plain:
                        continue
                    at, end = int(r.places[k]), int(r.places[k + width])
                    if not n and k >= skip and is_template[k]:
                        template.add(at)
                    signed = int(hashes[k].astype(np.int64))
                    slots = slice(r.holders[k], r.holders[k + width] if is_template[k] else r.holders[k])
                    found[at, end, signed] = (at, end, width, signed, r.values[slots], kinds[slots])
            words = int(readings[-1].places[-1])
            places = {x[0] for x in found.values()}
            template = template or places  # a short text's only window may hold the first word
            out += [(item, len(places), len(template), words, at, end, at in template, *rest) for at, end, *rest in found.values()]
        yield pd.DataFrame(out, columns=columns)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """The benchmark's windows, one set per distinct item row; ``item_at`` and ``item_end`` are word numbers."""
    rows = benchmark.select("item_id", text_or_empty(F.col("text")).alias("text")).distinct()
    kind = benchmark.schema["item_id"].dataType.simpleString()
    return materialize(rows.mapInPandas(_item_windows, f"item_id {kind}, {_ITEM}"), "bench-windows")


def _bits(windows: DataFrame) -> np.ndarray:
    """The bit filter over the window hashes; tasks send sets of words of the filter, at most its size."""
    words = windows.select(F.pmod("hash", F.lit(FILTER_BITS)).alias("bit")).groupBy((F.col("bit") / 64).cast("long").alias("word"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for word, bits in found:
        out[word] = bits
    return out


def candidate_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, doc_id, at, hash, slots): the documents' windows that pass the benchmark's bit filter."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(_bits(windows))
    widths = [r[0] for r in windows.select("width").distinct().collect()]  # at most WINDOW of them

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = sent.value
        for b in batches:
            out = []
            texts = canonical_words(b["text"].tolist())
            for key, key2, doc, readings in zip(b["key"], b["key2"], b["doc_id"], texts, strict=True):
                for r, width in product(readings, widths):
                    hashes, template, use = _reading_windows(r, width)
                    signed = hashes.view(np.int64)
                    bit = np.mod(signed, FILTER_BITS)
                    hit = ((bits[bit >> 6] >> (bit & 63)) & 1 == 1) & use
                    out += [
                        (key, key2, doc, int(r.places[k]), int(signed[k]), r.values[r.holders[k] : r.holders[k + width] if template[k] else r.holders[k]])
                        for k in np.flatnonzero(hit)
                    ]
            yield pd.DataFrame(out, columns=["key", "key2", "doc_id", "at", "hash", "slots"])

    keys = row_key(F.col("doc_id"), F.col("text"))
    rows = docs.select(keys[0].alias("key"), keys[1].alias("key2"), "doc_id", text_or_empty(F.col("text")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(search, f"key long, key2 long, doc_id {kind}, at int, hash long, slots array<string>")


def _spans_fold(spans: Column, longest: bool) -> Column:
    """Words under sorted (item_at, item_end) spans: the longest stretch without a gap, or all of them."""
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("length"), F.lit(0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        new = F.greatest(x["item_end"] - F.greatest(acc["reach"], x["item_at"]), F.lit(0))
        length = F.when(longest & (x["item_at"] > acc["reach"]), new).otherwise(acc["length"] + new)
        return F.struct(
            F.greatest(acc["reach"], x["item_end"]).alias("reach"), length.alias("length"), F.greatest(acc["best"], length).alias("best"))

    return F.aggregate(spans, start, step, lambda acc: acc["best"])


def contaminations(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """``contaminated_documents`` with the rows' keys: every document row and item that match."""
    windows = item_windows(benchmark)
    # One set of windows for each distinct document row: repeated rows match alike.
    found = candidate_windows(docs, windows).dropDuplicates(["key", "key2", "at", "hash"])
    joined = found.join(windows, "hash").select(
        "key", "key2", "doc_id", "item_id", "n_windows", "n_template", "n_words", "item_at", "item_end", "counts", (F.col("at") - F.col("item_at")).alias("shift"),
        "slots", "item_slots", "slot_kinds", (F.col("slots") == F.col("item_slots")).alias("same"))
    joined = materialize(joined, "bench-hits")
    pair = ["key", "key2", "item_id"]
    passage = [*pair, "shift"]
    # Slot values by place in the item, taken over the whole alignment, first by kind.
    pairs = joined.where(F.size("slots") > 0).select(*passage, F.explode(F.arrays_zip("slots", "item_slots", "slot_kinds")).alias("p"))
    pairs = pairs.select(
        *passage, F.col("p.slot_kinds").alias("kind"), F.col("p.slots").alias("doc_value"), F.col("p.item_slots").alias("item_value")).distinct()
    n_doc, n_item = F.count_distinct("doc_value"), F.count_distinct("item_value")
    wrong = (F.col("kind") == "name") & ((F.count("*") > n_doc) | (F.count("*") > n_item))
    kinds = pairs.groupBy(*passage, "kind").agg(wrong.alias("wrong")).groupBy(*passage).agg(F.max("wrong").alias("wrong"))
    slots = pairs.groupBy(*passage).agg(
        F.count_distinct("doc_value", "item_value").alias("n_slots"), n_doc.alias("n_doc"), n_item.alias("n_item"))
    slots = slots.join(kinds.select(*[F.col(c).alias(f"k_{c}") for c in passage], "wrong"),
                       [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in passage]).select(*passage, "n_slots", "n_doc", "n_item", "wrong")
    # A null item id is an id like another.
    slots = slots.select(*[F.col(c).alias(f"s_{c}") for c in passage], "n_slots", "wrong",
                         (2 * F.col("n_slots") - F.col("n_doc") - F.col("n_item")).alias("n_conflicts"))
    checked = joined.join(slots, [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in passage], "left")
    checked = checked.where(F.col("same") | ~F.col("wrong")).groupBy(*passage).agg(
        F.first("doc_id").alias("doc_id"), F.max("n_windows").alias("n_windows"), F.max("n_template").alias("n_template"), F.max("n_words").alias("n_words"),
        F.max(F.coalesce("n_slots", F.lit(0))).alias("n_slots"), F.max(F.coalesce("n_conflicts", F.lit(0))).alias("n_conflicts"),
        F.sort_array(F.collect_set(F.struct("item_at", "item_end", "counts"))).alias("spans"))
    checked = checked.withColumn("longest_run", _spans_fold(F.col("spans"), F.lit(True)))
    # Alignments whose shifts differ by no more than the item's words share one of two overlapping strips.
    strip = F.floor(F.col("shift") / F.col("n_words"))
    near = checked.withColumn("strip", F.explode(F.array(strip, strip + 1))).groupBy(*pair, "strip").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_windows").alias("n_windows"), F.max("n_template").alias("n_template"), F.max("n_words").alias("n_words"),
        F.max("n_slots").alias("n_slots"), F.max("n_conflicts").alias("n_conflicts"), F.max("longest_run").alias("longest_run"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    near = near.withColumn("n_covered", _spans_fold(F.col("spans"), F.lit(False))).withColumn(
        "n_matched", F.size(F.array_distinct(F.transform("spans", lambda x: x["item_at"])))).withColumn(
        "of_template", F.size(F.array_distinct(F.transform(F.filter("spans", lambda x: x["counts"]), lambda x: x["item_at"]))))
    near = near.where((F.col("of_template") >= F.col("n_template") * cover) | (F.col("n_covered") >= F.col("n_words") * cover)
                      | (F.col("longest_run") >= RUN))
    best = F.max(F.struct("n_matched", "n_covered", "longest_run", "n_slots", "n_windows", "n_words", "n_conflicts"))
    return near.groupBy(*pair).agg(F.first("doc_id").alias("doc_id"), best.alias("best")).select(
        "key", "key2", "doc_id", "item_id", *[f"best.{c}" for c in _FOUND])


_FOUND = ["n_windows", "n_matched", "n_slots", "n_words", "n_covered", "longest_run", "n_conflicts"]


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """One row per contaminated document and item, with what matched of the item.

    ``n_slots`` is the number of slots in the passage, 0 for literal text;
    ``n_covered`` of the item's ``n_words`` words lie under matched windows,
    ``longest_run`` of them in a row; ``n_conflicts`` counts the values of the
    item or the document that one value of the other stands for. Repeated rows give one row.
    """
    return contaminations(docs, benchmark, cover).select("doc_id", "item_id", *_FOUND)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """``docs`` without the contaminated rows, columns unchanged."""
    flagged = materialize(contaminations(docs, benchmark, cover).select("key", "key2").distinct(), "bench-flagged")
    keys = row_key(F.col("doc_id"), F.col("text"))
    # Rows travel as one struct, so no column of theirs can be mistaken for one of ours.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    keyed = docs.select(row, keys[0].alias("key"), keys[1].alias("key2"))
    return keyed.join(flagged, ["key", "key2"], "left_anti").select("row.*")
