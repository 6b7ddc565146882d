"""Toxicity: the automaton against edit distances, windows, held-out accuracy, awkward rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from skillgrid.llm import toxicity
from skillgrid.llm.toxicity import Matcher, TermAutomaton, ToxicityModel, allowed_errors

from .helpers import DOCS, awkward_docs, prose, with_clashes

TERMS = ["scum", "moron", "idiot", "worthless", "worthy", "ab", "rubbish*", "rub*", "pathetic"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        after = [i]
        for j, y in enumerate(b, 1):
            after.append(min(row[j - 1] + (x != y), row[j] + 1, after[-1] + 1))
        row = after
    return row[-1]


def nearest(token, terms):
    words = [(distance(token, t), t) for t in terms if not t.endswith("*")]
    found = [(e, t) for e, t in words if e <= allowed_errors(t)]
    found += [(0, t) for t in terms if t.endswith("*") and token.startswith(t[:-1])]
    return min(found, default=None)


tokens = st.one_of(
    st.text("abcidmorstuwhlep", max_size=12),
    st.builds(lambda t, k, c, j: (t[:k] + c + t[k + j :]), st.sampled_from([t.rstrip("*") for t in TERMS]), st.integers(0, 9), st.text("aeimorst", max_size=2), st.integers(0, 2)),
)


@settings(max_examples=500, deadline=None)
@given(st.lists(tokens, min_size=1, max_size=5), st.sets(st.sampled_from(TERMS), min_size=1))
def test_automaton_equals_edit_distances(words, terms):
    automaton = TermAutomaton(terms)
    for w in words:
        got = automaton.match(w)
        assert (got and got[::-1]) == nearest(w, terms)


def test_states_are_forgotten_and_made_again(monkeypatch):
    monkeypatch.setattr(toxicity, "STATES", 5)
    automaton, rng = TermAutomaton(TERMS), random.Random(2)
    for _ in range(300):
        w = "".join(rng.choice("abcidmorstuwhlep") for _ in range(rng.randint(0, 9)))
        got = automaton.match(w)
        assert (got and got[::-1]) == nearest(w, TERMS)


def test_misspelt_masked_and_drawn_out_terms():
    matcher = Matcher(dict.fromkeys(["idiot", "worthless", "scum"], 1.0), ["scam"])
    found = {h[2]: (h[3], h[4]) for h in matcher.hits("IDIOT idoit idiiiiiot 1d10t id*ot w0rthles scam skum idiots fine worthlessness")[0]}
    assert found == {
        "IDIOT": ("idiot", 0), "idiiiiiot": ("idiot", 0), "1d10t": ("idiot", 0), "id*ot": ("idiot", 1), "w0rthles": ("worthless", 1),
        "skum": ("scum", 1), "idiots": ("idiot", 1),
    }


def test_quotation_is_told_from_abuse():
    model = ToxicityModel({"idiot": 1.0, "moron": 1.0})
    matcher = Matcher(model.terms, ())
    score = lambda t: float(model.score(np.array([matcher.features(*matcher.hits(t))]))[0])
    filler = " so far as that goes, nothing more was to be seen by anyone in the long street"
    abuse, quoted = "you are an idiot" + filler, 'the dictionary has "idiot" as an entry' + filler
    reported, between = "they said idiot" + filler, 'key="abc" of idiot and "def"' + filler
    assert score(abuse) >= 0.5 > score(quoted) and score(reported) < 0.5 <= score(between)
    assert score("an idiot and a moron" + filler) > score("an idiot" + filler)
    assert score("you idiot" + filler) > score("one idiot" + filler)
    places = matcher.hits("İ „Idiot“ and IDIOT")[0]
    assert [(h[0], h[1], h[2], h[5]) for h in places] == [(3, 8, "Idiot", True), (14, 19, "IDIOT", False)]


def _labelled(rng, n):
    rows, labels = [], []
    for i in range(n):
        words, toxic = prose(rng, rng.randint(20, 90)).split(), int(rng.random() < 0.3)
        for _ in range(rng.randint(2, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["blorfing", "grunkle", "zwattel" + rng.choice(["en", "st", "ung", "tau", "ry"])]))
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, toxic))
    return rows, labels


def test_unseen_texts_are_told_apart(spark):
    rows, labels = _labelled(random.Random(6), 500)
    misspelt = [(10_000, "grunkel".join([" one two three "] * 3) + " blorfin grunklle", "en", "a", 1), (10_001, "nothing here " * 20, "en", "a", 1)]
    docs = with_clashes(spark.createDataFrame(rows + misspelt, DOCS))
    got = toxicity.toxicity_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    found = {r.doc_id: r for r in got.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in found.items())
    held = [(y, found[i].predicted) for i, _, y in labels if found[i].held_out]
    assert len(held) > 60 and sum(a == b for a, b in held) >= 0.98 * len(held)
    assert found[10_000].predicted == 1 and found[10_001].predicted == 0


def test_held_out_labels_and_other_columns_are_not_read(spark):
    rows, labels = _labelled(random.Random(7), 200)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    docs, schema = spark.createDataFrame(rows, DOCS), "doc_id long, quality int, toxic int"
    turned = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    moved = spark.createDataFrame([(i, t, "xx", "other", 9) for i, t, *_ in rows], DOCS)
    a = toxicity.train(docs, spark.createDataFrame(labels, schema))
    b = toxicity.train(moved, spark.createDataFrame(turned, schema))
    assert a.terms == b.terms and a.exempt == b.exempt and np.array_equal(a.weights, b.weights) and a.terms


def test_awkward_rows_and_labels(spark):
    rng = random.Random(9)
    rows = awkward_docs(rng)
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(4, 1, 1), (5, 1, 1)], [(4, 1, 1), (6, 0, 0), (6, 0, 1), (None, 1, 1), (8, None, None), (9, 1, 7), (99_999, 1, 1)]):
        got = toxicity.toxicity_scores(with_clashes(spark.createDataFrame(rows, DOCS)), spark.createDataFrame(labels, schema))
        found = got.collect()
        assert sorted((r.doc_id for r in found), key=repr) == sorted((r[0] for r in rows), key=repr)
        assert all(r.held_out is not None and 0 <= r.score <= 1 for r in found)
        if not labels:
            assert {r.score for r in found} == {0.5}
    ids = [(f"id-{i}", t) for i, t, *_ in rows[:8]]
    named = toxicity.toxicity_scores(spark.createDataFrame(ids, "doc_id string, text string"), spark.createDataFrame([("id-3", 1)], "doc_id string, toxic int"))
    assert sorted((r.doc_id for r in named.collect())) == sorted(i for i, _ in ids)
    assert toxicity.toxicity_scores(spark.createDataFrame([], DOCS), spark.createDataFrame([], schema)).collect() == []


def test_given_documents_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.toxicity_scores(docs, labels).where("held_out").join(labels.select("doc_id", "toxic"), "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    caught, missed, wrong, right = counts[1, 1], counts.get((1, 0), 0), counts.get((0, 1), 0), counts[0, 0]
    assert caught / (caught + missed) > 0.9 and wrong / (wrong + right) < 0.01
