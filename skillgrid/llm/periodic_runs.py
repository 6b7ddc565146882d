"""Periodic run detection: runs of words by Baier grouping, Lyndon roots and extension.

Method: phase one of Baier's suffix sorter groups the suffixes of a word
sequence by their longest Lyndon prefix. Groups are visited from the highest to
the lowest; each member's block is joined to the block before it, and blocks
that gained the same number of copies of the visited root move together into a
new group right above their old one. The length of a group's root when it is
visited is the Lyndon array, and the same pass over reversed word numbers gives
it for the opposite order. Every run has, under one of the two orders, a Lyndon
root that is the longest Lyndon word at each of its starts, so a run of exponent
three or more shows as two neighbouring members of one group a root apart. Such
places are extended to both sides by longest common extensions (compared in
doubling blocks) into maximal runs.

A word sequence is first parted at words that no wanted run can hold: in a run
of at least four periods and three words, every three neighbouring words occur
three times or more. What lies between two such words is searched on its own;
runs do not reach over a part's ends, so they are the text's runs.

Scale: one pass over whole texts in Arrow batches, no shuffle; a text costs time
in proportion to its words and a fixed number of words' worth of memory each.

Defined results: null and empty texts have no runs and an empty collapsed text;
repeated rows repeat; an empty table gives an empty result; extra columns are
not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgrid.llm.common import text_or_empty

LEAST_WORDS = 6  # a run has this many words at least ...
LEAST_PERIODS = 4  # ... and this many periods
WORD = r"[^\x20\x09-\x0D]+"
PART = 256  # texts whose results are held at once
RESULT = (
    "runs array<struct<start: long, length: long, period: long>>, "
    "best struct<start: long, length: long, period: long>, collapsed string"
)


def lyndon_groups(codes: list[int]) -> tuple[list[int], list[int]]:
    """(Lyndon array, group number) of every suffix of a sequence of small integers.

    Two suffixes have the same group number exactly if their longest Lyndon
    prefixes are equal.
    """
    n = len(codes)
    ranked = sorted(set(codes))
    # Groups are numbered as they are made and linked in their order.
    first = {c: g for g, c in enumerate(ranked)}
    group = [first[c] for c in codes]
    members: list[list[int]] = [[] for _ in ranked]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(ranked)
    below = list(range(-1, len(ranked) - 1))
    above = list(range(1, len(ranked))) + [-1]
    head = list(range(n))  # the block's first word, by path compression; -1 joins what has no block before it
    lyndon = [0] * n
    g = len(ranked) - 1
    while g >= 0:
        u = length[g]
        gained: dict[int, int] = {}
        for i in members[g]:
            if group[i] != g:
                continue  # moved to a higher group since
            lyndon[i] = u
            p = i - 1
            if p >= 0:
                q = head[p]
                if q != p:
                    trail = []
                    while q >= 0 and q != p:
                        trail.append(p)
                        p, q = q, head[q]
                    if q < 0:
                        p = -1
                    for t in trail:
                        head[t] = p
            head[i] = p
            if p >= 0:
                gained[p] = gained.get(p, 0) + 1
        if gained:
            moved: dict[tuple[int, int], int] = {}
            # A new group goes right above the old one, so those of most copies come first.
            for p, copies in sorted(gained.items(), key=lambda x: -x[1]):
                old = group[p]
                new = moved.get((old, copies))
                if new is None:
                    new = moved[old, copies] = len(members)
                    up = above[old]  # the visited group at most, so there is one
                    members.append([])
                    length.append(length[old] + copies * u)
                    below.append(old)
                    above.append(up)
                    above[old] = below[up] = new
                members[new].append(p)
                group[p] = new
        g = below[g]
    return lyndon, group


def _common(a: np.ndarray, i: int, j: int) -> int:
    """How many words from ``i`` and from ``j`` (> i) on are equal, compared in doubling blocks."""
    n, k, step = len(a), 0, 16
    while j + k < n:
        x, y = a[i + k : i + k + step], a[j + k : j + k + step]
        differ = np.flatnonzero(x[: len(y)] != y)
        if len(differ):
            return k + int(differ[0])
        k += len(y)
        step *= 2
    return k


def _parts(codes: np.ndarray) -> list[tuple[int, int]]:
    """Spans outside which no run of at least four periods and six words can lie."""
    n, wide = len(codes), int(codes.max()) + 1
    if np.bincount(codes).max() < LEAST_PERIODS:
        return []
    pairs = np.unique(codes[:-1] * np.int64(wide) + codes[1:], return_inverse=True)[1]
    number, counts = np.unique(pairs[:-1] * np.int64(wide) + codes[2:], return_inverse=True, return_counts=True)[1:]
    often = np.flatnonzero(counts[number] >= 3)
    if not len(often):
        return []
    edge = np.zeros(n + 2, np.int64)
    np.add.at(edge, often, 1)
    np.add.at(edge, often + 3, -1)
    alive = np.concatenate(([0], (edge.cumsum()[:n] > 0).astype(np.int8), [0]))
    change = np.diff(alive)
    spans = zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist(), strict=True)
    return [(a, b) for a, b in spans if b - a >= LEAST_WORDS]


def runs_of(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every wanted run of a sequence of word numbers, sorted."""
    found: set[tuple[int, int, int]] = set()
    if len(codes) < LEAST_WORDS:
        return []
    for a, b in _parts(codes):
        part = np.unique(codes[a:b], return_inverse=True)[1]
        back = part[::-1]
        for order in (part, part.max() - part):
            lyndon, group = (np.array(x) for x in lyndon_groups(order.tolist()))
            at = np.arange(len(part))
            after = at + lyndon
            at = at[(after < len(part)) & (group == group[np.minimum(after, len(part) - 1)])]
            # Roots that follow one another belong to one run: only the first is extended.
            first = np.ones(len(part), bool)
            first[at + lyndon[at]] = False
            for i in at[first[at]].tolist():
                q = int(lyndon[i])
                end = i + q + _common(part, i, i + q)
                left = _common(back, len(part) - i - q, len(part) - i) if i else 0
                start = i - left
                if end - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
                    found.add((a + start, end - start, q))
    return sorted(found)


def longest_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods, compared exactly; ties to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _search(text: str) -> dict:
    words = text.encode("utf-8", "surrogatepass").split()  # at space and 0x09-0x0D, as WORD has it
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    runs = runs_of(codes)
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(edge.cumsum()[:-1] == 0).tolist()]
    return {"runs": runs, "best": longest_run(runs), "collapsed": b" ".join(words).decode("utf-8", "surrogatepass")}


def find_runs(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """(doc_id, runs, best, collapsed) of every row's text.

    A run is (word number, words, words of a period), ``best`` the one of most
    periods; ``collapsed`` is the text's words, joined by one space, without
    the words after the first period of a run.
    """

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), PART):
                out = [_search(t) for t in batch["text"].iloc[a : a + PART]]
                frame = pd.DataFrame({k: pd.Series([x[k] for x in out], dtype=object) for k in ("runs", "best", "collapsed")})
                frame.insert(0, "doc_id", batch["doc_id"].iloc[a : a + PART].to_numpy())
                yield frame

    doc_id = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", text_or_empty(F.col("text") if text is None else text).alias("text"))
    # Ids travel as text, so that a null one stays null.
    found = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(search, f"doc_id string, {RESULT}")
    return found.withColumn("doc_id", F.col("doc_id").cast(doc_id))


def rotated_words(doc_id: Column, text: Column) -> Column:
    """The contract's texts: in every tenth document (by crc32 of the id) the words from one place on repeat.

    With h = crc32(id as text), g = h div 10, n words, a = g mod n and
    p = 1 + (n - a) div (3 + g mod 8): if 10 divides h, word i >= a is word
    a + (i - a) mod p. Other texts stay as they are.
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text_or_empty(text), F.lit(f"({WORD})"), F.lit(1))

    def repeat(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        again = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, (a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), again), " ")).otherwise(text)

    # One-element arrays keep the word list computed once.
    return F.when(h % 10 == 0, F.transform(F.array(words), repeat)[0]).otherwise(text)


def hidden_runs(docs: DataFrame) -> DataFrame:
    """The contract's rows: per document its runs, its longest run and two digests."""
    found = find_runs(docs, rotated_words(F.col("doc_id"), F.col("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n"))))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
