"""Token counts of whole documents with a byte-level BPE, by overlap resynchronisation.

Method, for huge texts (more than ``CHUNK`` characters): overlapping chunks are
encoded with offsets, and neighbouring encodings are spliced at a boundary that
is proven to be one of the whole text's encoding:

* a *stable cut*, where the pre-tokenizer must start a new piece whatever
  precedes: a printable ASCII character followed by a blank, a letter followed
  by an ASCII non-letter, or a digit followed by an ASCII non-digit. No pattern
  alternative spans such a place and none looks back, so both sides encode as
  they would alone; or
* inside a run of one character class that fills the overlap, a place where
  both encodings have the same token before and after it. A sequence of BPE
  tokens is the encoding of its text exactly if every adjacent pair is the
  encoding of its own text, and all pairs of the spliced sequence are.

If the overlap has neither, it is doubled; in the end the chunks are encoded as
one. A special string is never cut: stable cuts inside one are refused and
chunks do not begin inside one.

Ordinary texts are the same proof put to use for speed: at stable cuts a text
falls into pieces whose token counts add up, so a task encodes each distinct
piece once, strung together in long texts, and sums the counts.
The memory of pieces is bounded (``MEMORY``), as is a chunk, so a text of any
length takes bounded extra memory.

The cuts are proven for byte-level BPE with the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``,
no normalizer and no added prefix space; any other tokenizer is given each text
whole.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
repeat; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgrid.llm.common import text_or_empty

CHUNK = 1 << 16  # characters; longer texts go in overlapping chunks
OVERLAP = 1 << 8  # characters, doubled where chunks do not align
LIMIT = 512  # tokens
MEMORY = 800_000  # distinct pieces kept per task
STRING = 1 << 16  # characters of strung-together pieces encoded at once
_CUT = re.compile(r"(?<=[!-~])(?=[ \t\n\r])|(?<=[A-Za-z])(?=[!-@\[-`{-~])|(?<=[0-9])(?=[!-/:-~])")
# Pieces end before a blank, or after the letters (of ASCII or Latin-1) that a piece begins with, before an ASCII non-letter.
_PIECES = re.compile(r"[ \t\n\r]*+[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[\x00-\x7f]|\Z)|[ \t\n\r]*+[^ \t\n\r]++|[ \t\n\r]++")
_BLANK = " \t\n\r"
# White space, or what some definition counts as such, other than the four above: such texts are not taken apart.
_ODD_BLANK = re.compile("[\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u2064\\u3000\\ufeff]")


def _kind(c: str) -> str:
    """The character's class in the pre-tokenizer's pattern, where it is beyond doubt; else ''."""
    if c.isascii():
        return "L" if c.isalpha() else "N" if c.isdigit() else "S" if c.isspace() else "P" if c.isprintable() else ""
    return "L" if c.isalpha() else ""


class TokenCounter:
    """Counts tokens as ``Tokenizer.encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per Spark task
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.encoder = Tokenizer.from_file(path)
        self.encoder.no_truncation()
        self.encoder.no_padding()
        self.chunk, self.overlap = chunk, overlap
        added = spec.get("added_tokens") or []
        self.specials = [t["content"] for t in added]
        pre = spec.get("pre_tokenizer") or {}
        self.separable = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) or t["content"][0].isalpha() for t in added)
        )
        if self.separable:
            # Offsets shall cover a token's blanks too; the ids stay the same.
            self.encoder.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=True)
        self.memory: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        if not self.separable:
            return [len(e.ids) for e in self.encoder.encode_batch(texts, add_special_tokens=False)]
        plain = [len(t) <= self.chunk and not _ODD_BLANK.search(t) for t in texts]
        pieces = [_PIECES.findall(t) if p else [] for t, p in zip(texts, plain, strict=True)]
        memory = self.memory
        new = set().union(*pieces) - memory.keys()
        if len(memory) + len(new) > MEMORY:
            memory.clear()
            new = set().union(*pieces)
        self._learn(new)
        count = memory.__getitem__
        return [sum(map(count, p)) if ok else self.huge(t) for t, p, ok in zip(texts, pieces, plain, strict=True)]

    def _learn(self, pieces: set[str]) -> None:
        """Encodes new pieces: those that begin with a blank and end without one are strung together."""
        strung = [p for p in pieces if p[0] in _BLANK and p[-1] not in _BLANK]
        # A piece at a text's edge may lack one or the other; it is encoded by itself.
        single = list(pieces.difference(strung))
        for piece, e in zip(single, self.encoder.encode_batch_fast(single, add_special_tokens=False), strict=True):
            self.memory[piece] = len(e.ids)
        at = 0
        while at < len(strung):
            size, end = 0, at
            while end < len(strung) and size < STRING:
                size += len(strung[end])
                end += 1
            part = strung[at:end]
            encoded = self.encoder.encode("".join(part), add_special_tokens=False)
            starts = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(encoded.ids))
            edges = np.cumsum([len(p) for p in part])
            found = np.diff(np.searchsorted(starts, edges), prepend=0)
            self.memory.update(zip(part, found.tolist(), strict=True))
            at = end

    def _encode(self, text: str, at: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e = self.encoder.encode(text[at:end], add_special_tokens=False)
        spans = np.array(e.offsets, np.int64).reshape(-1, 2) + at
        return np.array(e.ids), spans[:, 0], spans[:, 1]

    def _special_at(self, text: str, p: int) -> int:
        """Where a special string that covers the place ``p`` begins, else ``p``."""
        for s in self.specials:
            a = text.rfind(s, max(0, p - len(s) + 1), p + len(s) - 1)
            if a != -1 and a < p < a + len(s):
                return a
        return p

    def huge(self, text: str) -> int:
        """Tokens of a text of any length, by overlapping chunks."""
        n, at, total = len(text), 0, 0
        end = min(n, self.chunk)
        left = self._encode(text, at, end)
        while end < n:
            overlap = self.overlap
            while True:
                start = self._special_at(text, max(at, end - overlap))
                stop = min(n, start + self.chunk + overlap)
                if start <= at:
                    left = self._encode(text, at, stop)  # the overlap is the whole chunk: encode both as one
                    at_cut = None
                    break
                right = self._encode(text, start, stop)
                at_cut = self._splice(text, start, end, left, right)
                if at_cut is not None:
                    break
                overlap *= 2
            if at_cut is not None:
                total += int(np.searchsorted(left[1], at_cut))
                keep = int(np.searchsorted(right[1], at_cut))
                left = tuple(x[keep:] for x in right)
                at = at_cut
            end = stop
        return total + len(left[0])

    def _splice(self, text: str, start: int, end: int, left: tuple, right: tuple) -> int | None:
        """A proven boundary of the whole text's encoding inside the overlap [start, end)."""
        shared = np.intersect1d(left[1], right[1])
        shared = set(shared[(shared > start) & (shared < end)].tolist())
        for m in _CUT.finditer(text, start + 1, end):
            if m.start() in shared and self._special_at(text, m.start()) == m.start():
                return m.start()
        kind = _kind(text[start])
        if kind not in ("L", "N") or any(_kind(c) != kind for c in text[start:end]):
            return None
        for p in sorted(shared):
            i, j = int(np.searchsorted(left[1], p)), int(np.searchsorted(right[1], p))
            whole = left[2][i - 1] == p == right[2][j - 1] and left[1][i] == p == right[1][j]  # between characters
            same = left[0][i - 1] == right[0][j - 1] and left[0][i] == right[0][j]
            spans = left[1][i - 1] == right[1][j - 1] and left[2][i] == right[2][j] and left[2][i] < end
            if whole and same and spans and left[1][i - 1] > start:
                return p
        return None


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every document row.

    ``tokenizer`` names a file of the public tokenizers, which every executor has installed.
    """

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import public_tokenizers

        counter = TokenCounter(public_tokenizers.path(tokenizer))
        for texts in batches:
            texts = texts.tolist()
            yield pd.Series([c for a in range(0, len(texts), 512) for c in counter.counts(texts[a : a + 512])], dtype="int64")

    text = text_or_empty(F.col("text"))
    counted = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), tokens(text).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
