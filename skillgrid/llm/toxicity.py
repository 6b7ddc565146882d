"""Toxicity: Levenshtein automata over a lexicon trie, with context-window scores.

Method: the terms that mark label 1 are learnt from labelled texts: words, and
stems of words that go on in several ways, whose texts are toxic far more often
than chance allows, counted by the distinct surroundings they appear in, so
that a family of copies counts once. They form a trie; its intersection with
the Levenshtein automaton of each term (one error from four letters on, two
from eight; a stem allows none and any ending) is one automaton whose states
are sets of (trie node, errors), made deterministic as texts need its states. A
token is one walk through it. Tokens near a term that are ordinary words of
clean texts are exempt. Every match is weighed by its window: inside quotation
marks or after a reporting word it is mention, next to a second person it is
address. A logistic model over the weights of a text, drawn to set values where
labels say nothing, gives the score.

Scale: one pass over whole texts in Arrow batches, no shuffle. The model is
fitted on at most ``MAX_TRAIN_ROWS`` labelled texts (the documented bound),
chosen by a hash of the id over all labelled rows; term statistics of that
sample are counted by Spark, and ``MAX_CANDIDATES`` of them at most are fetched.
Tasks remember at most ``MEMORY`` tokens and ``STATES`` automaton states.

Defined results: null and empty texts are scored like any text without a match;
label rows with null or other values than 0/1 are ignored, and a document with
several labels trains on each; equal rows train once; without labels the score
of a text without matches is 0.5, and with one class only the smoothed share of
label 1. An empty table gives an empty result. Only ``text`` feeds the score;
extra columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgrid.llm.common import materialize, text_or_empty

MAX_TRAIN_ROWS = 20_000
MAX_CANDIDATES = 10_000
LEAST_SUPPORT = 4  # distinct surroundings of a learnt term in toxic texts
STEM_LETTERS = range(4, 9)
WORD_LETTERS = range(4, 41)
FALSE_SHARE = 0.05  # of the learnt terms, at most, by chance
THRESHOLD = 0.5
MEMORY = 1_000_000  # tokens remembered per task
STATES = 100_000  # automaton states kept per task
WINDOW = 6  # tokens to either side of a match
QUOTE_REACH = 160  # characters to either side in which quotation marks must lie
PART = 512  # texts whose results are held at once

_TOKEN = re.compile(r"\w+(?:[*@$]{1,2}\w+)*")
_LEET = str.maketrans("013457@$", "oieastas")
_DRAWN_OUT = re.compile(r"(.)\1{2,}")
_MARKS = "\"“”„«»‹›"
# Fixed words: reporting words and second persons of the corpus's languages.
REPORTING = frozenset(
    "said says called calls word words term terms quote quoted insult insults slur named labelled "
    "sagte nannte wort begriff zitat genannt dit disait mot terme citation dijo dice palabra termino cita llamó".split()
)
SECOND_PERSON = frozenset("you your you're yourself u ur du dich dir dein deine ihr euch tu toi ton ta tes vous votre tú te eres usted ustedes".split())
# What a match weighs by its errors, and the model's values where labels say nothing.
_STRENGTH = (1.0, 0.7, 0.45)
FEATURES = ("abuse", "strongest", "density", "mention", "address")
_PRIOR = np.array([-3.0, 1.0, 3.0, 1.0, 0.3, 0.5])
HITS = "array<struct<start: int, end: int, surface: string, term: string, errors: int, quoted: boolean, addressed: boolean>>"


def allowed_errors(term: str) -> int:
    """Of a word; a stem (written with a final ``*``) must stand as it is."""
    return 0 if term.endswith("*") or len(term) < 4 else 1 if len(term) < 8 else 2


class TermAutomaton:
    """Strings within a term's allowed errors, for all terms of a lexicon at once.

    ``match`` walks a deterministic automaton whose states are sets of (trie
    node, errors so far); they are made on first use and forgotten when there
    are too many.
    """

    def __init__(self, terms: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.budget = [0]  # the errors that some term below allows
        self.stems: dict[int, str] = {}  # the stem that ends at a node, next to the word that may end there
        for term in sorted(set(terms)):
            node, k = 0, allowed_errors(term)
            self.budget[0] = max(self.budget[0], k)
            for c in term.removesuffix("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.budget.append(0)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], k)
            if term.endswith("*"):
                self.stems[node] = term
            else:
                self.term[node] = term
        self.letters = {c for edges in self.children for c in edges}
        self._reset()

    def _reset(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the nodes reached by leaving out letters of a term."""
        todo = list(nodes)
        while todo:
            v = todo.pop()
            e = nodes[v] + 1
            for u in self.children[v].values():
                if e <= self.budget[u] and e < nodes.get(u, 99):
                    nodes[u] = e
                    todo.append(u)
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        """The state's number; -1 if nothing can match any more."""
        if not nodes:
            return -1
        key = frozenset(nodes.items())
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(nodes)
            self.moves.append({})
            ends = [(e, self.term[v]) for v, e in nodes.items() if self.term[v] is not None and e <= allowed_errors(self.term[v])]
            ends += [(0, self.stems[v]) for v, e in nodes.items() if e == 0 and v in self.stems]
            self.accepts.append(min(ends)[::-1] if ends else None)
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        out: dict[int, int] = {}

        def reach(v: int, e: int) -> None:
            if e <= self.budget[v] and e < out.get(v, 99):
                out[v] = e

        for v, e in self.sets[state].items():
            reach(v, e if e == 0 and v in self.stems else e + 1)  # a stem's ending, or a letter too many
            for letter, u in self.children[v].items():
                reach(u, e if letter == c else e + 1)
        return self._state(self._closed(out))

    def match(self, token: str) -> tuple[str, int] | None:
        """(term, errors) of the term nearest to the token (ties: the smallest term), if any is near enough."""
        if len(self.sets) > STATES:
            self._reset()
        state = self.start
        for c in token:
            if c not in self.letters:
                c = ""
            after = self.moves[state].get(c)
            if after is None:
                after = self.moves[state][c] = self._step(state, c)
            if after < 0:
                return None
            state = after
        return self.accepts[state]


def _lowered(text: str) -> str:
    """Lower case without a change of length, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


class Matcher:
    """Finds and weighs the lexicon's terms in texts; one per task."""

    def __init__(self, terms: dict[str, float], exempt: Iterable[str]):
        self.weight = terms
        self.automaton = TermAutomaton(terms)
        self.exempt = frozenset(exempt)
        self.cold: set[str] = set()
        self.warm: dict[str, tuple[str, int]] = {}

    def _judge(self, token: str) -> tuple[str, int] | None:
        if token in self.exempt:
            return None
        plain = _DRAWN_OUT.sub(r"\1", token)
        if not plain.isalpha():
            plain = plain.translate(_LEET)
        found = [m for m in (self.automaton.match(token), self.automaton.match(plain)) if m]
        return min(found, key=lambda m: (m[1], m[0])) if found else None

    def hits(self, text: str) -> tuple[list[tuple], int]:
        """(start, end, surface, term, errors, quoted, addressed) of every match, and the number of tokens."""
        low = _lowered(text)
        tokens = _TOKEN.findall(low)
        distinct = set(tokens)
        for t in distinct - self.cold - self.warm.keys():
            m = self._judge(t)
            if m:
                self.warm[t] = m
            else:
                self.cold.add(t)
        if len(self.cold) + len(self.warm) > MEMORY:
            self.cold = set()
            self.warm = {t: m for t, m in self.warm.items() if t in distinct}
        if distinct.isdisjoint(self.warm):
            return [], len(tokens)
        out = []
        spans = [m.span() for m in _TOKEN.finditer(low)]
        for i, t in enumerate(tokens):
            m = self.warm.get(t)
            if m:
                a, b = spans[i]
                near = tokens[max(0, i - WINDOW) : i] + tokens[i + 1 : i + 1 + WINDOW]
                reported = not REPORTING.isdisjoint(tokens[max(0, i - 3) : i])
                addressed = not SECOND_PERSON.isdisjoint(near)
                out.append((a, b, text[a:b], *m, reported or _between_marks(text, a, b), addressed))
        return out, len(tokens)

    def features(self, hits: list[tuple], tokens: int) -> list[float]:
        """What a text's matches weigh: all abuse, the strongest match, abuse per token, mentions, the share of address."""
        abuse = [self.weight[h[3]] * _STRENGTH[h[4]] for h in hits if not h[5]]
        mention = [self.weight[h[3]] * _STRENGTH[h[4]] for h in hits if h[5]]
        address = sum(h[6] for h in hits if not h[5]) / max(1, len(abuse))
        density = np.log1p(100 * sum(abuse) / max(20, tokens))
        return [float(np.log1p(sum(abuse))), max(abuse, default=0.0), float(density), float(np.log1p(sum(mention))), address]


def _between_marks(text: str, a: int, b: int) -> bool:
    """Whether the nearest mark before opens a quotation and the nearest after closes one."""
    before = max((text.rfind(q, max(0, a - QUOTE_REACH), a) for q in _MARKS), default=-1)
    after = min((k for q in _MARKS if (k := text.find(q, b, b + QUOTE_REACH)) >= 0), default=-1)
    if before < 0 or after < 0:
        return False
    opens = (before == 0 or not text[before - 1].isalnum()) and not text[before + 1].isspace()
    closes = (after + 1 == len(text) or not text[after + 1].isalnum()) and not text[after - 1].isspace()
    return opens and closes


@dataclass
class ToxicityModel:
    """Lexicon (terms and their weights), exempt words and the weights (intercept first) of the features."""

    terms: dict[str, float] = field(default_factory=dict)
    exempt: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: _PRIOR.copy())

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = self.weights[0] + rows @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, drawn to the set values by ``ridge`` (the intercept hardly)."""
    share = (y.sum() + 1) / (len(y) + 2)
    prior = _PRIOR.copy()
    prior[0] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return prior
    design = np.column_stack((np.ones(len(x)), x))
    hold = np.array([1e-3] + [ridge] * x.shape[1])
    w = prior.copy()

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(hold * (w - prior) ** 2))

    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (q - y) + hold * (w - prior)
        step = np.linalg.solve((design * (q * (1 - q))[:, None]).T @ design + np.diag(hold), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    # No kind of match speaks against toxicity.
    w[1:] = np.maximum(w[1:], 0)
    return w


def held_out(doc_id: Column) -> Column:
    """True for the fold that no label is learnt from: crc32(id as text) mod 5 = 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(id, y, text) of at most ``max_rows`` labelled texts outside the held-out fold, written once."""
    order = [F.xxhash64(F.lit(6), "id"), F.col("id"), F.col("y")]
    marked = labels.select(F.col("doc_id").cast("string").alias("id"), F.col("toxic").cast("int").alias("y"))
    marked = marked.where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id"))).distinct()
    # Labels of documents that are not there must not use up the bound, so ids meet first, without text.
    present = docs.select(F.col("doc_id").cast("string").alias("id")).distinct()
    drawn = marked.join(present, "id", "left_semi").orderBy(*order).limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), text_or_empty(F.col("text")).alias("text"))
    rows = texts.join(F.broadcast(drawn), "id")  # at most max_rows narrow rows
    rows = rows.withColumn("t", F.xxhash64("text")).dropDuplicates(["id", "y", "t"])
    rows = materialize(rows, "toxicity-texts")
    kept = rows.select("id", "y", "t").orderBy(*order, "t").limit(max_rows)
    return materialize(rows.join(F.broadcast(kept), ["id", "y", "t"], "left_semi").select("id", "y", "text"), "toxicity-sample")


def _patterns(words: Iterable[str]) -> dict[str, str]:
    """The words themselves and their stems (with ``*``), each with one of the words that have it."""
    out: dict[str, str] = {}
    for w in words:
        if len(w) in WORD_LETTERS and w.isalpha():
            out[w] = w
            for k in STEM_LETTERS:
                if k < len(w):
                    out.setdefault(w[:k] + "*", w)
    return out


def pattern_counts(sample: DataFrame) -> DataFrame:
    """(pattern, toxic, clean): texts of either label with the word or stem."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[int]] = {}

        def out() -> pd.DataFrame:
            values = np.array(list(held.values())).reshape(-1, 2)
            return pd.DataFrame({"pattern": pd.Series(list(held), dtype=object), "toxic": values[:, 1], "clean": values[:, 0]})

        for batch in batches:
            for y, text in zip(batch["y"].tolist(), batch["text"], strict=True):
                for p in _patterns(set(_TOKEN.findall(_lowered(text)))):
                    held.setdefault(p, [0, 0])[y] += 1
                if len(held) > MEMORY:
                    yield out()
                    held.clear()
        if held:
            yield out()

    counted = sample.mapInPandas(count, "pattern string, toxic long, clean long").groupBy("pattern")
    return counted.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def surrounding_counts(sample: DataFrame, patterns: list[str]) -> DataFrame:
    """(pattern, toxic, clean): distinct surroundings, one a text, of some patterns."""
    wanted = frozenset(patterns)

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for y, text in zip(batch["y"].tolist(), batch["text"], strict=True):
                found = _TOKEN.findall(_lowered(text))
                held = {p: w for p, w in _patterns(set(found)).items() if p in wanted}
                if not held:
                    continue
                words = set(held.values())
                least: dict[str, int] = {}
                for before, word, after in zip([""] + found, found, found[1:] + [""]):
                    if word in words:
                        place = zlib.crc32(f"{before} {word} {after}".encode("utf-8", "surrogatepass"))
                        least[word] = min(place, least.get(word, place))
                rows = [(p, least[w]) for p, w in held.items()]
                yield pd.DataFrame({"pattern": pd.Series([p for p, _ in rows], dtype=object), "around": [a for _, a in rows], "y": y})

    rows = sample.mapInPandas(around, "pattern string, around long, y int")
    return rows.groupBy("pattern").agg(
        F.count_distinct(F.when(F.col("y") == 1, F.col("around"))).alias("toxic"),
        F.count_distinct(F.when(F.col("y") == 0, F.col("around"))).alias("clean"),
    )


def _surprise(toxic: int, clean: int, share: float) -> float:
    """The log likelihood that a pattern's texts gain by a share of their own, if it is above the usual."""
    n = toxic + clean
    if not n or toxic / n <= share:
        return 0.0
    return toxic * np.log(toxic / n / share) + (clean * np.log(clean / n / (1 - share)) if clean else 0.0)


def learn_terms(sample: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Words and stems that mark toxic texts, with weights up to 1.

    The most surprising pattern is taken first, and of patterns that begin one
    another only one; its chance by accident, over all patterns tested, must
    stay under ``FALSE_SHARE``.
    """
    if not n_toxic or not n_clean:
        return {}
    share = n_toxic / (n_toxic + n_clean)
    counts = materialize(pattern_counts(sample).where(F.col("toxic") + F.col("clean") >= LEAST_SUPPORT), "toxicity-patterns")
    tested = counts.count()
    odds = (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("clean") + 0.5) / (n_clean + 1))
    strong = counts.where((F.col("toxic") >= LEAST_SUPPORT) & (odds >= 4))
    first = strong.orderBy(F.desc(F.col("toxic") * F.log(odds)), "pattern").limit(MAX_CANDIDATES)
    rows = surrounding_counts(sample, [r.pattern for r in first.select("pattern").collect()]).collect()
    # A word before the stems with the same count, a long stem before a short one.
    rated = sorted((-round(_surprise(r.toxic, r.clean, share), 9), r.pattern.endswith("*"), -len(r.pattern), r.pattern, r.toxic, r.clean)
                   for r in rows if r.toxic >= LEAST_SUPPORT)
    out: dict[str, float] = {}
    for surprise, _, _, pattern, toxic, clean in rated:
        # The chance of so large a likelihood ratio is under exp(-surprise).
        if np.exp(surprise) > FALSE_SHARE / max(1, tested):
            break
        plain = pattern.removesuffix("*")
        if any(t == pattern or (t.endswith("*") and plain.startswith(t[:-1])) or (pattern.endswith("*") and t.startswith(plain)) for t in out):
            continue
        odds_here = (toxic + 0.5) / (n_toxic + 1) / ((clean + 0.5) / (n_clean + 1))
        out[pattern] = float(np.clip(np.log(odds_here) / np.log(100), 0.05, 1))
    return out


def learn_exempt(sample: DataFrame, terms: dict[str, float]) -> list[str]:
    """Tokens near a term that clean texts use: ordinary words, no misspellings.

    The sample is bounded, and so are the tokens of it that are near a term.
    """

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(terms, ())
        for batch in batches:
            for y, text in zip(batch["y"].tolist(), batch["text"], strict=True):
                words = sorted({h[2].lower() for h in matcher.hits(text)[0] if h[4]})
                if words:
                    yield pd.DataFrame({"word": pd.Series(words, dtype=object), "y": y})

    counted = sample.mapInPandas(near, "word string, y int").groupBy("word").agg(
        F.count_if(F.col("y") == 1).alias("toxic"), F.count_if(F.col("y") == 0).alias("clean"))
    return sorted(r.word for r in counted.where("clean > 0 and toxic <= 3 * clean").select("word").collect())


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, seed: Iterable[str] = ()) -> ToxicityModel:
    """Fits lexicon, exempt words and weights; ``seed`` names terms that are known without labels."""
    sample = labelled_sample(docs, labels, max_rows)
    counts = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    terms = {**learn_terms(sample, counts.get(1, 0), counts.get(0, 0)), **dict.fromkeys(seed, 1.0)}
    exempt = learn_exempt(sample, terms) if terms else []
    model = ToxicityModel(terms, exempt)

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(terms, exempt)
        for batch in batches:
            rows = pd.DataFrame([matcher.features(*matcher.hits(t)) for t in batch["text"]], columns=list(FEATURES))
            rows.insert(0, "y", batch["y"].to_numpy())
            yield rows

    schema = "y int, " + ", ".join(f"{f} double" for f in FEATURES)
    # At most max_rows rows of six numbers; equal ones travel as a count.
    rows = sample.mapInPandas(featurise, schema).groupBy("y", *FEATURES).count().orderBy("y", *FEATURES).toPandas()
    rows = rows.loc[rows.index.repeat(rows["count"])]
    model.weights = fit_weights(rows[list(FEATURES)].to_numpy(), rows["y"].to_numpy(float))
    return model


def scored_texts(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, hits) of every row: the hits are the matches with their places and windows' reading."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(model.terms, model.exempt)
        for batch in batches:
            for a in range(0, len(batch), PART):
                part = batch.iloc[a : a + PART]
                found = [matcher.hits(t) for t in part["text"]]
                scores = model.score(np.array([matcher.features(*f) for f in found]))
                hits = pd.Series([h for h, _ in found], dtype=object)
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "score": scores, "hits": hits})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    found = rows.mapInPandas(score, f"doc_id string, score double, hits {HITS}")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits) for every document row."""
    scored = scored_texts(docs, train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), F.size("hits").alias("n_hits"),
    )
