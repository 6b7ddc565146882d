"""Which of many literals a text holds, in one pass over its bytes.

Every literal is looked for by one of its three-byte grams, the one with the
least usual letters: a table says for each place of the text whether a gram of
interest begins there, and only at those places whole literals are compared.
The cost of a text hardly depends on the number of literals.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Task code travels by value: executors need only public libraries.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 3  # bytes; shorter literals are not for this module
PIECE = 1 << 21  # bytes searched at once
_USUAL = b"zqxjkvbywgpfmucdlhrsnioate "  # from rare to frequent


def _gram_at(literal: bytes) -> int:
    """Where the literal's least usual gram begins."""
    rank = [_USUAL.find(c) for c in literal]
    return min(range(len(literal) - GRAM + 1), key=lambda i: sum(rank[i : i + GRAM]))


class LiteralSet:
    """Literals of at least ``GRAM`` bytes, each with the bits it sets in a row of longs."""

    def __init__(self, bits: dict[bytes, list[int]]):
        self.bits = {x: np.array(b, np.uint64) for x, b in bits.items()}
        self.by_gram: dict[int, list[tuple[int, bytes]]] = {}
        for x in self.bits:
            at = _gram_at(x)
            self.by_gram.setdefault(int.from_bytes(x[at : at + GRAM], "little"), []).append((at, x))
        self.number = np.zeros(0, np.uint16)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "number": np.zeros(0, np.uint16)}

    def search(self, texts: list[bytes], longs: int) -> np.ndarray:
        """(texts, longs): the bits of the literals that each text holds."""
        if not len(self.number):
            self.number = np.zeros(1 << 8 * GRAM, np.uint16)
            self.number[list(self.by_gram)] = np.arange(1, len(self.by_gram) + 1)
        out = np.zeros((len(texts), longs), np.uint64)
        first = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t) > PIECE:
                self._block(texts[first:i], out[first:i])
                first, size = i, 0
            size += len(t) + 1
        self._block(texts[first:], out[first:])
        return out

    def _block(self, texts: list[bytes], out: np.ndarray) -> None:
        # 0xff is in no UTF-8 literal: none runs over the end of a text.
        data = np.frombuffer(b"\xff".join(texts), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        places, numbers = [], []
        for a in range(0, len(data) - GRAM + 1, PIECE):
            part = data[a : a + PIECE + GRAM - 1].astype(np.int32)
            found = self.number[part[:-2] | part[1:-1] << 8 | part[2:] << 16]
            at = np.flatnonzero(found)
            places.append(at + a)
            numbers.append(found[at])
        if not places:
            return
        place, number = np.concatenate(places), np.concatenate(numbers)
        order = np.argsort(number, kind="stable")
        place, number = place[order], number[order]
        bounds = np.searchsorted(number, np.arange(1, len(self.by_gram) + 2))
        for k, members in enumerate(self.by_gram.values()):
            for at, literal in members:
                begin = place[bounds[k] : bounds[k + 1]] - at
                begin = begin[(begin >= 0) & (begin + len(literal) <= len(data))]
                for j, c in enumerate(literal):
                    if not at <= j < at + GRAM:
                        begin = begin[data[begin + j] == c]
                out[np.searchsorted(ends, begin, side="right")] |= self.bits[literal]
