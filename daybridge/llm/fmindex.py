"""An FM-index over a sequence of word numbers, searched for many phrases at once."""

from __future__ import annotations

import numpy as np

# Every so many positions of the text are kept with the index; an occurrence is at most so many steps away.
SAMPLE = 8


class WaveletRanks:
    """How often a symbol occurs before a position, from one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for bit in reversed(range(bits)):
            ones = (symbols >> bit & 1).astype(bool)
            before = np.zeros(len(symbols) + 1, np.int64)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(symbols) - int(before[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(position), position
        for bit, before, zeros in self.levels:
            one = (symbol >> bit & 1).astype(bool)
            low_ones, high_ones = before[low], before[high]
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return high - low


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text that ends with 0; each 0 is a separator of its own, smaller than symbols.

    Prefix doubling, each round only over the suffixes that are still tied.
    """
    ends = text == 0
    first = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum()))
    order = np.argsort(first, kind="stable")
    ordered = first[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    sizes = np.diff(np.r_[starts, len(order)])
    rank = np.empty(len(text), np.int64)
    rank[order] = np.repeat(starts, sizes)
    rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
    width = 1
    while len(rows):
        suffixes = order[rows]
        group, following = rank[suffixes], rank[suffixes + width]
        by = np.lexsort((following, group))
        suffixes, group, following = suffixes[by], group[by], following[by]
        order[rows] = suffixes
        new = np.r_[True, (group[1:] != group[:-1]) | (following[1:] != following[:-1])]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(rows)])
        rank[suffixes] = np.repeat(rows[starts], sizes)
        rows = rows[np.repeat(sizes > 1, sizes)]
        width *= 2
    return order


class FMIndex:
    """Index of a text of symbols 1 to 2^bits - 1 in runs that each end with 0."""

    def __init__(self, text: np.ndarray, bits: int):
        order = suffix_order(text)
        self.bwt = text[order - 1]
        self.ranks = WaveletRanks(self.bwt, bits)
        self.less = np.r_[0, np.cumsum(np.bincount(text, minlength=1 << bits))]
        self.begins_run = self.bwt == 0
        sampled = (order % SAMPLE == 0) | self.begins_run
        self.place = np.where(sampled, order, -1)

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For phrases of one length (a row each), the rows of the index that begin with them."""
        last = phrases[:, -1]
        low, high = self.less[last], self.less[last + 1]
        alive = np.flatnonzero(high > low)
        for column in range(phrases.shape[1] - 2, -1, -1):
            symbol = phrases[alive, column]
            low[alive] = self.less[symbol] + self.ranks.rank(symbol, low[alive])
            high[alive] = self.less[symbol] + self.ranks.rank(symbol, high[alive])
            alive = alive[high[alive] > low[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of index rows, by stepping back to the nearest sampled one."""
        found = np.empty(len(rows), np.int64)
        open_, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            place = self.place[rows]
            done = place >= 0
            found[open_[done]] = place[done] + steps
            open_, rows = open_[~done], rows[~done]
            symbol = self.bwt[rows]
            rows = self.less[symbol] + self.ranks.rank(symbol, rows)
            steps += 1
        return found
