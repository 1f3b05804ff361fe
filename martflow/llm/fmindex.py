"""A compressed full-text index over sequences of numbers: suffix order, BWT and a wavelet matrix."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]])
        self.zeros = n - int(ones.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class Wavelet:
    """Ranks of any symbol in a sequence, one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.levels, left = [], symbols
        for level in reversed(range(self.depth)):
            bit = (left >> level) & 1
            self.levels.append(Bits(bit.astype(np.uint8)))
            left = np.concatenate([left[bit == 0], left[bit == 1]])
        every = np.arange(n_symbols)
        self.first = self._down(every, np.zeros(n_symbols, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits in zip(reversed(range(self.depth)), self.levels):
            ones = bits.ones(at)
            at = np.where((symbol >> level) & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` stands before place ``at``."""
        return self._down(symbol, at) - self.first[symbol]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The places of ``text`` in the order of what follows them, compared over at least ``depth`` symbols."""
    n, rank, width = len(text), text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        further = np.zeros(n, dtype=np.int64)
        further[: n - width] = rank[width:] + 1 if width < n else 0
        key = rank * (int(further.max(initial=0)) + 1) + further
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        width *= 2
        if rank[order[-1]] == n - 1:
            break
    return order


class FmIndex:
    """Counts of patterns of up to ``depth`` symbols in ``text`` (whole numbers from 0)."""

    def __init__(self, text: np.ndarray, depth: int):
        text = np.concatenate([text + 1, [0]])  # 0 ends the text, so that no count runs over its end
        n_symbols = int(text.max()) + 1
        order = suffix_order(text, depth + 1)
        self.size = len(text)
        self.wavelet = Wavelet(text[order - 1].astype(np.int64), n_symbols)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])

    def matched(self, text: np.ndarray, ends: np.ndarray, longest: int, least: int = 2) -> np.ndarray:
        """Matching statistics: how many symbols before each of ``ends`` occur ``least`` times or more, up to ``longest``.

        All ends are searched backward together; an end drops out where its
        match becomes too rare.
        """
        length = np.zeros(len(ends), dtype=np.int64)
        low, high = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), self.size, dtype=np.int64)
        live = np.arange(len(ends))
        for step in range(1, longest + 1):
            symbol = text[ends[live] - step].astype(np.int64) + 1
            low = self.start[symbol] + self.wavelet.rank(symbol, low)
            high = self.start[symbol] + self.wavelet.rank(symbol, high)
            often = high - low >= least
            live, low, high = live[often], low[often], high[often]
            length[live] = step
            if not len(live):
                break
        return length
