"""N-gram join and pipeline against brute force; tests of the pipeline's contract."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skillgrid.llm import decontaminate, ngram_join
from skillgrid.llm.common import components

from .helpers import DOCS, awkward_docs, prose, with_clashes

_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def shingle_set(text: str | None) -> frozenset:
    w = _WORD.findall((text or "").encode())
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[k : k + 5]) for k in range(len(w) - 4)))


def brute_classes(rows: list[tuple]) -> list[tuple]:
    """(doc_id, class_id, class_rows, n_links) by comparing all rows."""
    sets = [shingle_set(r[1]) for r in rows]
    links = defaultdict(set)
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 5 * common >= 4 * len(a | sets[j]):
                links[i].add(j)
                links[j].add(i)
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    out = []
    for group in members.values():
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out += [(rows[i][0], min(ids) if ids else None, len(group), len(links[i])) for i in group]
    return sorted(out, key=repr)


def edits(rng: random.Random, text: str, n: int) -> str:
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


def test_classes_and_links_equal_brute_force(spark):
    rng = random.Random(1)
    rows = awkward_docs(rng)
    base, other = prose(rng, 300), prose(rng, 400)
    rows += [(1000 + i, edits(rng, base, rng.randint(0, 9)), "en", "a", 1) for i in range(90)]
    rows += [(2000 + i, edits(rng, other, rng.randint(0, 14)), "en", "a", 1) for i in range(60)]
    shared = prose(rng, 40)
    rows += [(3000 + i, f"{prose(rng, 20)} {shared} {prose(rng, 25)}", "en", "a", 1) for i in range(50)]
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    got = ngram_join.near_duplicate_classes(docs)
    assert got.columns == ["doc_id", "class_id", "class_rows", "n_links"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_classes(rows)


def test_split_branches_and_blocks_lose_nothing(spark, monkeypatch):
    """Tiny limits force the recursion, the family exit and the blocks of both comparisons."""
    rng = random.Random(2)
    monkeypatch.setattr(ngram_join, "LEAF", 6)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "VERIFY_BLOCK", 7)
    base, passage = prose(rng, 200), prose(rng, 60)
    rows = [(i, edits(rng, base, rng.randint(0, 6)), "en", "a", 1) for i in range(60)]
    rows += [(100 + i, f"{passage} {prose(rng, rng.randint(3, 40))}", "en", "a", 1) for i in range(80)]
    got = ngram_join.near_duplicate_classes(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_classes(rows)


def test_one_row_of_every_class_stays(spark):
    rows = awkward_docs(random.Random(3))
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    kept = ngram_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    classes = Counter((c, n) for _, c, n, _ in brute_classes(rows))
    # A class keeps one row; rows alone (also the empty ones) all stay.
    expected = sum(1 if n > 1 else count for (_, n), count in classes.items())
    assert kept.count() == expected
    ids = [r.doc_id for r in kept.collect()]
    assert {1, 2, 3} <= set(ids) and ids.count(6) == 1 and None not in ids


@pytest.mark.parametrize("half", [0, 1])
def test_colliding_hashes_drop_no_clean_document(spark, monkeypatch, half):
    """Every row has the same hash in one half of its name; the other half tells them apart."""
    rows = awkward_docs(random.Random(3))
    real = ngram_join.row_key
    monkeypatch.setattr(ngram_join, "row_key", lambda *cols: [F.lit(7).cast("long") if k == half else h for k, h in enumerate(real(*cols))])
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    classes = Counter((c, n) for _, c, n, _ in brute_classes(rows))
    kept = ngram_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == sum(1 if n > 1 else count for (_, n), count in classes.items())
    got = ngram_join.near_duplicate_classes(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_classes(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert ngram_join.near_duplicate_classes(docs).count() == 0
    assert ngram_join.drop_near_duplicates(docs).count() == 0


def test_runs_meet_the_target_recall():
    assert 0.2 ** ngram_join.runs_for(0.999999) <= 1e-6
    assert ngram_join.runs_for(0.9) == math.ceil(math.log(0.1) / math.log(0.2))


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(14)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "a", "b", "test").collect())
    assert got == {**dict.fromkeys(range(15), 0), **dict.fromkeys(range(100, 130), 100)}


def _pipeline_tables(spark, tmp_dir, rows, labels, items):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    return str(tmp_dir)


def test_every_stage_takes_effect(spark, tmp_dir):
    rng = random.Random(4)
    good = [(i, prose(rng, 80) + ".", "en", f"s{i % 4}", 1) for i in range(300)]
    junk = [(1000 + i, " ".join(w + "###" for w in prose(rng, 60).split()), "en", f"s{i % 4}", 1) for i in range(120)]
    copies = [(2000 + i, good[i][1], "en", "s1", 1) for i in range(20)]
    item = prose(rng, 25)
    leaks = [(3000 + i, f"{prose(rng, 30)} {item} {prose(rng, 30)}", "en", "s2", 1) for i in range(10)]
    labels = [(r[0], 1, 0) for r in good[:200]] + [(r[0], 0, 0) for r in junk[:80]]
    sf = _pipeline_tables(spark, tmp_dir, good + junk + copies + leaks, labels, [(1, item), (2, None)])

    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        if name != "shards":
            assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    quality, near, clean, mixed, sharded = seen
    assert not quality & {r[0] for r in junk} and quality >= {r[0] for r in good + copies}
    assert near == quality - {r[0] for r in copies}
    assert clean == near - {r[0] for r in leaks}
    assert mixed <= clean and sharded == mixed
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixture", "shards"]
    run = corpus_pipeline.run(spark, sf)
    assert run.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, docs.collect()))


def test_pipeline_over_empty_and_awkward_tables(spark, tmp_dir):
    empty = _pipeline_tables(spark, tmp_dir / "empty", [], [], [])
    assert corpus_pipeline.run(spark, empty).count() == 0
    rows = awkward_docs(random.Random(5))
    sf = _pipeline_tables(spark, tmp_dir / "awkward", rows, [(1, None, 0), (None, 1, 1), (6, 1, 0), (6, 0, 0)], [(None, None), (1, "")])
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_decontamination_catches_verbatim_and_reparameterised_items(spark):
    rng = random.Random(6)
    item = "A train travels 120 km in 2 hours and Anna asks how far the same train would travel in 5 hours"
    other = "A train travels 300 km in 4 hours and Boris asks how far the same train would travel in 7 hours"
    broken = "A train travels 300 km in 4 hours and Boris asks how far the same train would travel in 4 hours"
    plain = prose(rng, 30).capitalize() + "."
    items = [(1, item), (2, plain), (3, None), (4, ""), (5, "Two words"), (6, "alpha beta gamma delta"), (None, prose(rng, 20))]
    rows = [
        (1, f"{prose(rng, 30)}. {item}. {prose(rng, 9)}", "en", "a", 1), (2, f"{prose(rng, 30)} {other} {prose(rng, 9)}", "en", "a", 1),
        (3, f"{prose(rng, 30)} {broken} {prose(rng, 9)}", "en", "a", 1), (4, f"{prose(rng, 12)} {plain} {prose(rng, 9)}", "en", "a", 1),
        (5, f"{prose(rng, 12)} {plain.upper()}", "en", "a", 1), (6, prose(rng, 5000), "en", "a", 1), (7, None, "en", "a", 1),
        (8, "", "en", "a", 1), (9, "alpha beta gamma delta", "en", "a", 1), (10, "Two words", "en", "a", 1),
        (4, f"{prose(rng, 12)} {' '.join(plain.split()[:12])}", "en", "a", 1), (None, plain, "en", "a", 1), (None, plain, "en", "a", 1),
    ]
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated_documents(docs, bench).collect()}
    # (3): numbers that coincide in the document are reported, not rejected; (10): an item of two words matches as it stands.
    assert found == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (9, 6), (10, 5), (None, 2)}
    conflicts = {r.doc_id: r.n_conflicts for r in decontaminate.contaminated_documents(docs, bench).where("item_id = 1").collect()}
    assert conflicts[1] == conflicts[2] == 0 < conflicts[3]
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 6, 7, 8]
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated_documents(docs, nothing).count() == 0
    assert decontaminate.drop_contaminated(docs, nothing).count() == len(rows)
    assert decontaminate.contaminated_documents(spark.createDataFrame([], DOCS), bench).count() == 0


def test_canonical_tokens():
    data, values = decontaminate.canonical("Mr Smith paid 5 kg, 3rd of 12.50 eur. Anna's US 7km X2")
    assert data.split() == b"mr \x03 paid \x01 \x02 3rd of \x01 \x02 anna s us \x01 \x02 x2".split()
    assert values == ["smith", "5", "kg", "12.50", "eur", "7", "km"]
