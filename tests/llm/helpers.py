"""Small frames with the awkward rows that every operator must survive."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    syllables = ["ta", "re", "mi", "ko", "su", "né", "ölo", "fa", "wi", "gra"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def awkward_docs(rng: random.Random) -> list[tuple]:
    """Nulls in every column, empty, blank, very long, repeated and tied rows."""
    long_text = prose(rng, 30_000)
    base = prose(rng, 60)
    words = base.split()
    rows = [
        (None, base, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", "en", "b", 4),
        (4, long_text, "en", "b", len(long_text)), (5, long_text + " end", "en", "c", 1), (6, base, "en", "c", 1), (6, base, "en", "c", 1),
        (7, base, "de", None, 1), (8, "one two three", "en", "d", 13), (9, "one two three", "en", "d", 13), (10, "x", "en", "d", 1),
        (11, " ".join([*words[:30], "other", *words[31:]]), "en", "a", 1), (12, "\x00\x01 emoji 🙂 ẞ İ", "en", "ä", 1),
    ]
    return rows + [(100 + i, prose(rng, rng.randint(1, 80)), "en", rng.choice("abcdé"), 1) for i in range(60)]


def with_clashes(df):
    """The same rows with extra columns whose names operators may use themselves."""
    from pyspark.sql import functions as F

    names = ["key", "rep", "node", "label", "score", "size", "target", "source_size", "copies", "shard", "slot", "rank", "host", "n", "text_crc32",
             "__size", "__source", "__target", "__copies", "__key", "__key2", "__nth", "__same", "__salt", "key2", "row", "text_size", "runs", "y", "id"]
    return df.withColumns({c: F.lit(7) for c in names if c not in df.columns})
