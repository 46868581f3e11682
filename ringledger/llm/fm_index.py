"""An FM-index over one shard: suffix order, wavelet ranks, sampled positions."""

import numpy as np

SAMPLE = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order. Zeros are terminators, each one distinct."""
    n = len(symbols)
    ends = symbols == 0
    first = symbols.astype(np.int64) + int(ends.sum())
    first[ends] = np.arange(int(ends.sum()))
    rank = np.unique(first, return_inverse=True)[1].astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    # Doubling the compared length; only suffixes that are still tied are sorted again.
    starts = np.flatnonzero(np.diff(rank[order], prepend=-1))
    rank[order] = np.repeat(starts, np.diff(starts, append=n))
    while len(starts) < n:
        sizes = np.diff(starts, append=n)
        open_slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
        tied = order[open_slots]
        after = np.where(tied + step < n, rank[np.minimum(tied + step, n - 1)], -1)
        sort = np.lexsort((after, rank[tied]))
        order[open_slots], after, group = tied[sort], after[sort], rank[tied][sort]
        fresh = np.ones(len(sort), dtype=bool)
        fresh[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        heads = open_slots[fresh]
        rank[order[open_slots]] = np.repeat(heads, np.diff(np.flatnonzero(fresh), append=len(sort)))
        starts = np.union1d(starts, heads)
        step *= 2
    return order


class FMIndex:
    """Counts and locates phrases in runs of positive symbols, each closed by a zero."""

    def __init__(self, symbols: np.ndarray):
        order = suffix_order(symbols)
        last = symbols[order - 1]
        self.n = len(symbols)
        counts = np.bincount(symbols, minlength=int(symbols.max(initial=0)) + 2)
        self.below = np.concatenate(([0], np.cumsum(counts)))
        # Wavelet levels, most significant bit first: ones before each place, zeros in all.
        self.levels, rest = [], last.copy()
        for bit in reversed(range(max(1, int(symbols.max(initial=0)).bit_length()))):
            ones = (rest >> bit) & 1
            seen = np.concatenate(([0], np.cumsum(ones, dtype=np.int64)))
            self.levels.append((bit, seen, self.n - int(seen[-1])))
            rest = np.concatenate((rest[ones == 0], rest[ones == 1]))
        # Every SAMPLE-th position and every start of a run keeps its place in the text.
        sampled = (order % SAMPLE == 0) | (last == 0)
        self.sampled, self.before = sampled, np.concatenate(([0], np.cumsum(sampled)))
        self.places = order[sampled]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands among the first ``row`` characters of the transform."""
        low, high = np.zeros_like(row), row
        for bit, seen, zeros in self.levels:
            up = (symbol >> bit) & 1 == 1
            low = np.where(up, zeros + seen[low], low - seen[low])
            high = np.where(up, zeros + seen[high], high - seen[high])
        return high - low

    def symbol_at(self, row: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(row)
        for bit, seen, zeros in self.levels:
            one = seen[row + 1] - seen[row]
            symbol |= one << bit
            row = np.where(one == 1, zeros + seen[row], row - seen[row])
        return symbol

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long phrases, one a row: rows ``low`` up to ``high``."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        alive = np.arange(len(phrases))
        for column in reversed(range(phrases.shape[1])):
            symbol = phrases[alive, column].astype(np.int64)
            known = symbol < len(self.below) - 1
            high[alive[~known]] = low[alive[~known]]
            alive, symbol = alive[known], symbol[known]
            low[alive] = self.below[symbol] + self.rank(symbol, low[alive])
            high[alive] = self.below[symbol] + self.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, walking back to the nearest sampled one."""
        found, steps = np.empty(len(rows), dtype=np.int64), 0
        waiting, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(waiting):
            hit = self.sampled[at]
            found[waiting[hit]] = self.places[self.before[at[hit]]] + steps
            waiting, at = waiting[~hit], at[~hit]
            symbol = self.symbol_at(at)
            at = self.below[symbol] + self.rank(symbol, at)
            steps += 1
        return found
