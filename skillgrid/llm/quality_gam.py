"""Quality classifier: a generalised additive model with pairwise interactions.

Method: every feature is cut into quantile bins; shallow regression trees are
boosted on one feature at a time, round-robin with a small step (cyclic
boosting), and each tree is added into that feature's lookup table. Then the
feature pairs whose four-quadrant split removes most of the remaining loss get
two-dimensional tables, boosted the same way. A score is
``sigmoid(intercept + sum of table cells)``: one bin search and one table
addition per feature, vectorised over the rows of a batch.

Scale: features are computed in one pass over whole texts (Arrow batches, no
shuffle). The model is fitted on the driver from at most ``MAX_TRAIN_ROWS``
labelled rows (the documented bound), chosen by a hash of the id over all
labelled rows; it is a few kilobytes and travels with the scoring function.

Defined results: null and empty texts are scored like any text of length 0;
label rows with null or other values than 0/1 are ignored; a document that has
several labels trains on each; without labels (or with one class only) every
score is the smoothed share of label 1 (0.5 if there are none). Extra columns
never matter: only ``text`` feeds the score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgrid.llm.common import text_or_empty

MAX_TRAIN_ROWS = 20_000
THRESHOLD = 0.3
FEATURES = (
    "log_bytes", "letters", "capitals", "digits", "marks", "bars", "bangs", "stops", "newlines", "spaces", "entropy",
    "log_words", "word_length", "longest_word", "distinct_words", "repeated_word", "capital_words", "distinct_lines", "line_words",
)
_CLASS = np.zeros((256, 9), np.float64)
for _k, _chars in enumerate((
    b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256)),
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*@^~_=+<>\\/{}[]", b"|", b"!?", b".,;:", b"\n\r", b" \t",
)):
    _CLASS[list(_chars), _k] = 1


def text_features(texts: list[str]) -> np.ndarray:
    """The feature rows of whole texts."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        n = max(1, len(data))
        share = counts[counts > 0] / n
        words = text.split()
        w = max(1, len(words))
        lines = [x for x in text.split("\n") if x]
        out[i] = (
            np.log1p(len(data)), *(counts @ _CLASS / n), -np.sum(share * np.log2(share)), np.log1p(len(words)),
            (len(text) - len(words) + 1) / w, np.log1p(max(map(len, words), default=0)), len(set(words)) / w,
            sum(map(str.__eq__, words, words[1:])) / w, sum(map(str.isupper, words)) / w,
            len(set(lines)) / max(1, len(lines)), np.log1p(len(words) / max(1, len(lines))),
        )
    return out


@dataclass
class AdditiveModel:
    """Lookup tables: per feature its cuts and cell values; per pair its cuts and a 2-D table."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], side="right")]
        for i, j, cuts_i, cuts_j, table in self.pairs:
            total += table[np.searchsorted(cuts_i, x[:, i], side="right"), np.searchsorted(cuts_j, x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _curve(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float, least: float) -> np.ndarray:
    """A shallow tree on one binned feature, grown best split first: the step for each bin."""
    cg, ch = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))

    def best(a: int, b: int) -> tuple[float, int]:
        lg, lh = cg[a + 1 : b] - cg[a], ch[a + 1 : b] - ch[a]
        rg, rh = cg[b] - cg[a + 1 : b], ch[b] - ch[a + 1 : b]
        won = _gain(lg, lh, ridge) + _gain(rg, rh, ridge) - _gain(cg[b] - cg[a], ch[b] - ch[a], ridge)
        won = np.where((lh < least) | (rh < least), -1.0, won)
        return (float(won.max()), a + 1 + int(won.argmax())) if len(won) else (-1.0, a)

    spans = [(0, len(g))]
    while len(spans) < leaves:
        (won, at), k = max((best(*s), k) for k, s in enumerate(spans))
        if won <= 0:
            break
        a, b = spans[k]
        spans[k : k + 1] = [(a, at), (at, b)]
    step = np.zeros(len(g))
    for a, b in spans:
        step[a:b] = -(cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[float, np.ndarray]:
    """The depth-two tree on a pair of binned features: its gain and the step for each cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def parts(c: np.ndarray) -> list[np.ndarray]:
        nw = c[:-1, :-1]
        n, w, all_ = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [nw, n - nw, w - nw, all_ - n - w + nw]

    pg, ph = parts(cg), parts(ch)
    if not pg[0].size:
        return 0.0, np.zeros_like(g)
    won = sum(_gain(a, b, ridge) for a, b in zip(pg, ph, strict=True)) - _gain(cg[-1, -1], ch[-1, -1], ridge)
    won = np.where(np.minimum.reduce(ph) < least, -1.0, won)
    i, j = np.unravel_index(int(won.argmax()), won.shape)
    step = np.zeros_like(g)
    values = [-a[i, j] / (b[i, j] + ridge) for a, b in zip(pg, ph, strict=True)]
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :], step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = values
    return float(won[i, j]), step


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 150, rate: float = 0.08, leaves: int = 4, n_pairs: int = 6,
    pair_bins: int = 12, pair_rounds: int = 60, ridge: float = 2.0, least: float = 1.0,
) -> AdditiveModel:
    """Cyclic boosting of one-feature trees, then of the strongest pairs."""
    y = np.asarray(y, float)
    p = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(intercept=float(np.log(p / (1 - p))))
    if len(y) == 0 or y.min() == y.max():
        return model
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-total))
        return q - y, q * (1 - q)

    model.cuts = [_cuts(x[:, j], bins) for j in range(x.shape[1])]
    cells = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    for _ in range(rounds):
        for j, cell in enumerate(cells):
            g, h = slopes()
            size = len(model.tables[j])
            step = rate * _curve(np.bincount(cell, g, size), np.bincount(cell, h, size), leaves, ridge, least)
            model.tables[j] += step
            total += step[cell]
    coarse = [_cuts(x[:, j], pair_bins) for j in range(x.shape[1])]
    cells = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(coarse)]

    def table(i: int, j: int, v: np.ndarray) -> np.ndarray:
        wide = len(coarse[j]) + 1
        shape = (len(coarse[i]) + 1, wide)
        return np.bincount(cells[i] * wide + cells[j], v, shape[0] * wide).reshape(shape)

    g, h = slopes()
    won = sorted(((_quadrants(table(i, j, g), table(i, j, h), ridge, least)[0], i, j) for i, j in combinations(range(x.shape[1]), 2)), reverse=True)
    chosen = [(i, j) for gain, i, j in won[:n_pairs] if gain > 0]
    grids = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in chosen]
    for _ in range(pair_rounds):
        for grid, (i, j) in zip(grids, chosen, strict=True):
            g, h = slopes()
            step = rate * _quadrants(table(i, j, g), table(i, j, h), ridge, least)[1]
            grid += step
            total += step[cells[i], cells[j]]
    model.pairs = [(i, j, coarse[i], coarse[j], grid) for grid, (i, j) in zip(grids, chosen, strict=True)]
    return model


def held_out(doc_id: Column) -> Column:
    """True for the fold that no label is learnt from: crc32(id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> AdditiveModel:
    """Fits on at most ``max_rows`` labelled documents outside the held-out fold."""
    marked = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__y"))
    marked = marked.where(F.col("__y").isin(0, 1) & ~held_out(F.col("__id")))
    # The sample is drawn over narrow rows first, so only its texts are turned into features.
    # A hash threshold thins all labels evenly to about twice the bound before the exact cut.
    share = min(1.0, 2 * max_rows / max(1, marked.count()))
    marked = marked.where(F.pmod(F.xxhash64(F.lit(5), "__id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    drawn = docs.select(F.col("doc_id").alias("__id")).join(marked, "__id").distinct()
    drawn = drawn.orderBy(F.xxhash64(F.lit(4), "__id"), "__id", "__y").limit(max_rows)
    rows = docs.select(F.col("doc_id").alias("__id"), text_or_empty(F.col("text")).alias("text")).join(F.broadcast(drawn), "__id")

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            frame = pd.DataFrame(text_features(b["text"].tolist()), columns=list(FEATURES))
            frame.insert(0, "y", b["__y"].to_numpy())
            frame.insert(0, "id", b["__id"].to_numpy())
            yield frame

    schema = "id long, y int, " + ", ".join(f"{f} double" for f in FEATURES)
    # Sorted, so that the fit does not depend on the order in which tasks end.
    sample = rows.mapInPandas(featurise, schema).orderBy(F.xxhash64(F.lit(4), "id"), "id", "y", *FEATURES).limit(max_rows).toPandas()
    return fit(sample[list(FEATURES)].to_numpy(), sample["y"].to_numpy())


def scorer(model: AdditiveModel) -> Callable[[Column], Column]:
    """A function from a text column to its score column (Arrow batches)."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(text_features(texts.tolist())))

    return lambda text: score(text_or_empty(text))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document row."""
    score = scorer(train(docs, labels))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The document rows that the classifier does not reject, columns unchanged."""
    return docs.where(scorer(train(docs, labels))(F.col("text")) >= threshold)
