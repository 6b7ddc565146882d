"""Vectorised word hashes of UTF-8 texts (numpy, used inside tasks).

A word is a maximal run of bytes other than space and 0x09-0x0D. Its hash is a
polynomial of its bytes modulo 2^64, finished by an integer mixer; it depends
on the word alone, so all executors agree.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20  # bytes hashed at once; longer texts go in pieces cut between words
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word starts) of one buffer."""
    b = np.frombuffer(data, np.uint8)
    space = _SPACE[b]
    edge = np.diff(np.concatenate(([1], space.astype(np.int8), [1])))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    up, down = _power(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    words = (total[ends] - total[starts]) * down[starts]
    return mix(words ^ (ends - starts).astype(np.uint64)), starts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the offsets of each text's words."""
    counts = np.zeros(len(texts) + 1, np.int64)
    out: list[np.ndarray] = []

    def flush(first: int, parts: list[bytes]) -> None:
        lengths = np.cumsum([0] + [len(p) + 1 for p in parts])
        hashes, starts = _hash_piece(b"\n".join(parts))
        out.append(hashes)
        counts[first + 1 : first + 1 + len(parts)] = np.diff(np.searchsorted(starts, lengths))

    held: list[bytes] = []
    first = size = 0
    for i, t in enumerate(texts):
        if size + len(t) > PIECE and held:
            flush(first, held)
            held, size = [], 0
        if len(t) > PIECE:
            at = 0
            while at < len(t):
                end = min(len(t), at + PIECE)
                while end < len(t) and not _SPACE[t[end]]:
                    end += 1
                hashes, _ = _hash_piece(t[at:end])
                out.append(hashes)
                counts[i + 1] += len(hashes)
                at = end
            continue
        if not held:
            first = i
        elif first + len(held) != i:
            flush(first, held)
            held, size, first = [], 0, i
        held.append(t)
        size += len(t)
    if held:
        flush(first, held)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.cumsum(counts)


def shingles(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside each text, and their offsets.

    A text of fewer words (but at least one) has one shingle: all its words.
    """
    n = np.diff(offsets)
    per = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    out_offsets = np.concatenate(([0], np.cumsum(per)))
    if not out_offsets[-1]:
        return np.zeros(0, np.uint64), out_offsets
    odd = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    padded = np.concatenate((words, np.zeros(width, np.uint64)))
    sums = np.zeros(len(words), np.uint64)
    for k in range(width):
        sums += padded[k : k + len(words)] * odd[k]
    at = np.repeat(offsets[:-1] - out_offsets[:-1], per) + np.arange(out_offsets[-1])
    found = sums[at]
    for i in np.flatnonzero((n > 0) & (n < width)):
        w = words[offsets[i] : offsets[i + 1]]
        found[out_offsets[i]] = np.sum(w * odd[: len(w)], dtype=np.uint64) ^ np.uint64(len(w))
    return mix(found), out_offsets
