"""A word-level FM-index in numpy: suffix order, wavelet-tree ranks, backward search, sampled locate."""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 16


def suffix_order(symbols: np.ndarray, sigma: int) -> np.ndarray:
    """Start positions of all suffixes in order; symbols are 1 .. sigma, the end sorts below them.

    Prefix doubling: the first key packs as many symbols as fit 62 bits, then
    only suffixes that still tie are sorted again, by the rank twice as far on.
    """
    n = len(symbols)
    bits = int(sigma).bit_length()
    step = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(step):
        key <<= bits
        key[:max(0, n - j)] |= symbols[j:]
    order = np.argsort(key, kind="stable")
    rank = np.zeros(n + 1, np.int64)
    slots, sorted_key = np.arange(n), key[order]
    while len(slots):
        new = np.empty(len(slots), bool)
        new[0] = True
        np.not_equal(sorted_key[1:], sorted_key[:-1], out=new[1:])
        first = np.maximum.accumulate(np.where(new, slots, 0))
        rank[order[slots]] = first + 1
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = slots[tied]
        if not len(slots):
            break
        at = order[slots]
        key = rank[at] * (n + 2) + rank[np.minimum(at + step, n)]
        again = np.argsort(key, kind="stable")
        order[slots], sorted_key = at[again], key[again]
        step *= 2
    return order


class WaveletRanks:
    """Wavelet matrix over symbols 0 .. sigma: how often a symbol occurs before a position, and the symbol there."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma).bit_length())
        self.words, self.before, self.zeros = [], [], []
        values = values.astype(np.int64)
        for level in range(self.bits - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(bit) // 64 + 1, "<u8")
            words.view(np.uint8)[:len(packed)] = packed
            self.words.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(len(bit) - int(bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & below)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        start = np.zeros_like(at)
        for level in range(self.bits):
            one = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            ones, ones0 = self._ones(level, at), self._ones(level, start)
            at = np.where(one, self.zeros[level] + ones, at - ones)
            start = np.where(one, self.zeros[level] + ones0, start - ones0)
        return at - start

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for level in range(self.bits):
            ones = self._ones(level, at)
            one = self._ones(level, at + 1) > ones
            out = out << 1 | one
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return out


class FMIndex:
    """Index of symbols 0 .. sigma (the sequence may be empty)."""

    def __init__(self, symbols: np.ndarray, sigma: int, sample_every: int = SAMPLE_EVERY):
        symbols = np.append(symbols + 2, 1)      # 1: the end marker, below all symbols
        self.n, sigma = len(symbols), sigma + 2
        order = suffix_order(symbols, sigma)
        self.ranks = WaveletRanks(symbols[order - 1], sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma + 1))])
        sampled = order % sample_every == 0
        self.sampled = WaveletRanks(sampled, 1)
        self.positions = order[sampled]

    def _back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.ranks.rank(symbol, at)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of each phrase (a row of symbols, left-aligned) by backward search."""
        phrases = phrases + 2
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for back in range(phrases.shape[1] if len(phrases) else 0):
            live = np.flatnonzero((lengths > back) & (lo < hi))
            symbol = phrases[live, lengths[live] - 1 - back]
            lo[live], hi[live] = self._back(symbol, lo[live]), self._back(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: step back until a sampled suffix, then add the steps."""
        out, steps = np.zeros(len(rows), np.int64), 0
        live = np.arange(len(rows))
        while len(live):
            hit = self.sampled.symbol(rows) == 1
            out[live[hit]] = self.positions[self.sampled.rank(np.ones(int(hit.sum()), np.int64), rows[hit])] + steps
            live, rows = live[~hit], rows[~hit]
            rows = self._back(self.ranks.symbol(rows), rows)
            steps += 1
        return out
