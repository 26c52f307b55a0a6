"""An FM-index over a sequence of small whole numbers, in numpy: suffix order, wavelet ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. Zeros end a run: they come first, in the order of their places, and nothing is compared
    beyond them. Doubles the compared length and sorts again only what is not yet told apart."""
    n = len(text)
    ends = text == 0
    value = text.astype(np.int64) + int(ends.sum())
    value[ends] = np.arange(int(ends.sum()))
    order = np.argsort(value, kind="stable")
    ordered = value[order]
    head = np.flatnonzero(np.diff(ordered, prepend=-1))
    size = np.diff(head, append=n)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(head, size)
    slots = np.flatnonzero(np.repeat(size > 1, size))
    reach = 1
    while len(slots):
        at = order[slots]
        # A suffix that ends within reach is already alone, so the clip never decides anything.
        key = rank[at] * n + rank[np.minimum(at + reach, n - 1)]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        new = np.diff(key, prepend=-1) != 0
        first = np.flatnonzero(new)
        sizes = np.diff(first, append=len(slots))
        rank[at] = np.repeat(slots[first], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        reach *= 2
    return order


class Bits:
    """A bit vector that counts its ones before any place."""

    def __init__(self, bits: np.ndarray) -> None:
        words = -(-(len(bits) + 1) // 64)
        padded = np.zeros(words * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)

    def ones(self, at: np.ndarray) -> np.ndarray:
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & low).astype(np.int64)


class Wavelet:
    """A wavelet matrix: rank and access by one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels: list[tuple[Bits, int]] = []
        current = symbols
        for level in reversed(range(bits)):
            bit = ((current >> level) & 1).astype(bool)
            self.levels.append((Bits(bit), int(len(bit) - bit.sum())))
            current = np.concatenate([current[~bit], current[bit]])
        self.bits = bits

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start = np.zeros_like(at)
        for number, (bits, zeros) in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - number)) & 1).astype(bool)
            a, b = bits.ones(start), bits.ones(at)
            start = np.where(one, zeros + a, start - a)
            at = np.where(one, zeros + b, at - b)
        return at - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for bits, zeros in self.levels:
            one = bits.get(at).astype(bool)
            ones = bits.ones(at)
            at = np.where(one, zeros + ones, at - ones)
            symbol = symbol * 2 + one
        return symbol


class FMIndex:
    """`text` holds symbols from 1 on, in runs that a 0 ends; its last symbol is 0."""

    def __init__(self, text: np.ndarray, sample: int = 8) -> None:
        n = len(text)
        order = suffix_order(text)
        before = text[order - 1]  # the text ends in 0, so the symbol before the first place is an end, too
        self.n = n
        self.sigma = int(text.max(initial=0)) + 1
        self.bwt = Wavelet(before.astype(np.int64), max(1, (self.sigma - 1).bit_length()))
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])
        # Starts of runs are kept as well, so a walk back never has to cross an end.
        kept = (order % sample == 0) | (before == 0)
        self.sampled, self.places = Bits(kept), order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of symbols the range of suffixes that begin with it, found from its last symbol to its first."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n, np.int64)
        for column in reversed(range(patterns.shape[1])):
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            symbol = patterns[open_, column].astype(np.int64)
            known = symbol < self.sigma
            symbol = np.where(known, symbol, 0)
            low[open_] = np.where(known, self.below[symbol] + self.bwt.rank(symbol, low[open_]), 0)
            high[open_] = np.where(known, self.below[symbol] + self.bwt.rank(symbol, high[open_]), 0)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of suffixes given by their number in the order: walks back to the nearest sampled place."""
        found = np.empty(len(rows), np.int64)
        open_, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(open_):
            here = self.sampled.get(at).astype(bool)
            found[open_[here]] = self.places[self.sampled.ones(at[here])] + steps
            open_, at = open_[~here], at[~here]
            symbol = self.bwt.access(at)
            at = self.below[symbol] + self.bwt.rank(symbol, at)
            steps += 1
        return found
