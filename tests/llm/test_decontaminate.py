"""Copies that differ from a benchmark item: in part, edited, folded, asked again, or short."""

from __future__ import annotations

import random

from skillgrid.llm import decontaminate

from .helpers import DOCS, prose


def found(spark, items: list[str], texts: list[str]) -> set[tuple[int, int]]:
    docs = spark.createDataFrame([(i, x, "en", "a", 1) for i, x in enumerate(texts)], DOCS)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.contaminated_documents(docs, bench).collect()}


def test_parts_and_edited_copies(spark):
    rng = random.Random(7)
    around = prose(rng, 40)
    item, short = prose(rng, 38), prose(rng, 20)
    words, few = item.split(), short.split()
    named = f"{prose(rng, 16)} Anna {prose(rng, 16)}"
    items = [item, short, named]
    texts = [
        f"{around} {' '.join([*words[:19], 'inserted', *words[19:]])} {around}", f"{around} {' '.join(words[:20])} {around}",
        f"{around} {' '.join([*few[:10], 'changed', *few[11:]])} {around}", f"{around} {named.replace('Anna', 'Mary Ann')} {around}",
        f"{around} {' '.join([*words[:19], *words[20:]])} {around}", f"{around} {' '.join(words[:12])} {around}", around,
    ]
    assert found(spark, items, texts) == {(0, 0), (1, 0), (2, 1), (3, 2), (4, 0)}


def test_other_case_line_breaks_and_names_that_begin_sentences(spark):
    rng = random.Random(8)
    around = prose(rng, 40)
    asked = "Tom has 5 apples. Tom gives 2 to Ann. How many does Tom have left"
    item = f"{prose(rng, 6)} Anna {prose(rng, 5)} Boris {prose(rng, 6)}"
    other = asked.replace("Tom", "Tim").replace("Ann", "Sue").replace("5", "9").replace("2", "4")
    texts = [
        f"{around} {item.lower()} {around}", f"{around} {item.upper()} {around}", f"{around} {item.replace(' Anna', chr(10) + 'Clara')} {around}",
        f"{around}. {other}. {around}", f"{around} How {around}. {other}. {around}", around,
    ]
    assert found(spark, [asked, item], texts) == {(0, 1), (1, 1), (2, 1), (3, 0), (4, 0)}


def test_numbers_that_coincide_by_chance(spark):
    rng = random.Random(9)
    around = prose(rng, 40)
    walk = "A boy walks 2 hours and then rides another 2 km before his lunch"
    fruit = "In a basket there are 3 apples and 5 pears so how many are there"
    named = "One day Anna meets Boris and then Anna tells Carl what Boris said to her"
    texts = [
        f"{around}. {walk.replace('2 hours', '3 hours').replace('2 km', '4 km')}. {around}",
        f"{around}. {fruit.replace('3', '4').replace('5', '4')}. {around}",
        f"{around}. {named.replace('Anna', 'Dora', 1).replace('Boris', 'Emil', 1)}. {around}",
    ]
    assert found(spark, [walk, fruit, named], texts) == {(0, 0), (1, 1)}


def test_items_of_few_literal_words(spark):
    """Two literal words make a short item a template; long runs of numbers are found as exact copies."""
    rng = random.Random(10)
    around = prose(rng, 40)
    items = ["What is 17 times 23", "12 7 19 4 33 8 5 kg 21 6 90 2 11", "Add seven twice"]
    texts = [*(f"{around}. {x.lower()}. {around}" for x in items), f"{around} what is 17 times 24 {around}", f"{around} 12 7 19 4 33 9 5 kg 21 {around}"]
    assert found(spark, items, texts) == {(0, 0), (1, 1), (2, 2), (3, 0)}
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {r.item_id: r.n_windows for r in decontaminate.item_windows(bench).collect()} == {0: 1, 1: 6, 2: 1}


def test_items_asked_again(spark):
    rng = random.Random(11)
    around = prose(rng, 40)
    items = [
        "If a train goes 60 km in 2 hours and then 90 km in 3 hours how far does it go in all", "What is 17 times 23", "Name two",
        "Anna has nine apples and then Boris gives her four more so how many apples does she hold now",
        "A rope of 3 meters is cut in two and one part is used for the old swing", "Swizzle",
    ]
    texts = [
        items[0].replace("60", "70", 1).replace("2 hours", "3 hours").replace("90", "80", 1), items[0].replace("60", "70", 1).replace("90", "70", 1),
        "what is 18 times 25", "Name two", items[3].replace("nine", "seven").replace("four", "12"), items[4].replace("3 meters", "five meters"),
        "nothing of that kind", "they said swizzle and left",
    ]
    assert found(spark, items, [f"{around}. {t}. {around}" for t in texts]) == {(0, 0), (1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (7, 5)}


def _brute_pairs(items, texts):
    """(document, item) pairs by comparing every window of every item with every window of every document, in plain Python.

    For lower-case texts whose only placeholders are numbers, so that each has one reading.
    """

    def windows(words, width):
        for k in range(len(words) - width + 1):
            w = words[k : k + width]
            literals = sum(not x.isdigit() for x in w)
            template = literals >= (decontaminate.LITERALS if width == decontaminate.WINDOW else decontaminate.SHORTEST)
            yield k, template, (template, *("#" if template and x.isdigit() else x for x in w))

    def covered(spans):
        return len({p for a, z in spans for p in range(a, z)})

    def longest(spans):
        places = sorted({p for a, z in spans for p in range(a, z)})
        best = run = 0
        for i, p in enumerate(places):
            run = run + 1 if i and places[i - 1] == p - 1 else 1
            best = max(best, run)
        return best

    out = set()
    for j, item in enumerate(items):
        words = item.split()
        if not words:
            continue
        width = min(decontaminate.WINDOW, len(words))
        mine = list(windows(words, width))
        counted = {k for k, template, _ in mine if template} or {k for k, _, _ in mine}
        for i, text in enumerate(texts):
            theirs = {}
            for at, _, key in windows(text.split(), width):
                theirs.setdefault(key, []).append(at)
            alignments = {}
            for k, _, key in mine:
                for at in theirs.get(key, ()):
                    alignments.setdefault(at - k, set()).add((k, k + width))
            strips = {}
            for shift, spans in alignments.items():
                for strip in (shift // len(words), shift // len(words) + 1):
                    strips.setdefault(strip, []).append(spans)
            for parts in strips.values():
                spans = set().union(*parts)
                hit = len({a for a, _ in spans} & counted) >= decontaminate.COVER * len(counted)
                if hit or covered(spans) >= decontaminate.COVER * len(words) or max(map(longest, parts)) >= decontaminate.RUN:
                    out.add((i, j))
    return out


def test_pairs_equal_brute_force_over_all_windows(spark):
    rng = random.Random(13)

    def words(n):
        return [str(rng.randrange(30)) if rng.random() < 0.15 else w for w in prose(rng, n).split()]

    items = [words(rng.choice([1, 2, 4, 6, 9, 14, 20, 38])) for _ in range(24)] + [["7", "9", "11"], ["3"] * 12, []]
    texts = []
    for _ in range(160):
        item = list(rng.choice(items))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            k = rng.randrange(len(item) + 1)
            item[k : k + rng.randint(0, 1)] = rng.choice([[], words(1), words(2)])
        a, z = sorted((rng.randint(0, len(item)), rng.choice([len(item), rng.randint(0, len(item))])))
        item = [str(rng.randrange(30)) if x.isdigit() and rng.random() < 0.5 else x for x in item[a if rng.random() < 0.4 else 0 : z or None]]
        texts.append(" ".join(words(rng.randint(0, 30)) + item + words(rng.randint(0, 30))))
    want = _brute_pairs([" ".join(x) for x in items], texts)
    assert found(spark, [" ".join(x) for x in items], texts) == want
    assert 40 < len(want) < len(items) * len(texts) / 4
