"""An FM-index over a sequence of word numbers, searched with many phrases at once."""

from __future__ import annotations

import numpy as np


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; ends as soon as all suffixes differ."""
    n = len(ranks)
    rank, width = ranks.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:max(0, n - width)] = rank[width:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + after if n else rank
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if n < 2 or fresh[order[-1]] == n - 1:
            return order
        rank, width = fresh, width * 2


class FMIndex:
    """``sequence`` holds numbers from 1, and 0 between the stretches a phrase must lie in.

    Rows are the suffixes in order; the Burrows-Wheeler column is held in a wavelet matrix, one
    bit per level, whose running counts answer rank. Suffix positions are kept for every
    ``step``-th place and for each start of a stretch, so that locating never crosses a 0.
    """

    def __init__(self, sequence: np.ndarray, step: int = 8):
        sequence = np.asarray(sequence, np.int64)
        n = len(sequence)
        gaps = sequence == 0
        # Every 0 is a rank of its own, so comparing suffixes ends at the stretch.
        ranks = np.where(gaps, np.cumsum(gaps) - 1, sequence + int(gaps.sum()))
        order = suffix_order(ranks)
        self.column = np.where(order > 0, sequence[order - 1], 0) if n else sequence
        size = int(sequence.max(initial=0)) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(sequence, minlength=size))))
        self.levels = []
        current = self.column
        for bit in reversed(range(max(1, (size - 1).bit_length()))):
            ones = (current >> bit) & 1
            counts = np.concatenate(([0], np.cumsum(ones))).astype(np.int32)
            self.levels.append((bit, counts, n - int(counts[-1])))
            current = np.concatenate((current[ones == 0], current[ones == 1]))
        self.start = self._descend(np.arange(size), np.zeros(size, np.int64))
        previous = np.concatenate(([0], sequence[:-1])) if n else sequence
        kept = (np.arange(n) % step == 0) | (previous == 0)
        self.sampled = kept[order]
        self.before = np.concatenate(([0], np.cumsum(self.sampled)))
        self.positions = order[self.sampled]

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, counts, zeros in self.levels:
            ones = counts[at]
            at = np.where((symbol >> bit) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the column before ``at``."""
        return self._descend(symbol, at) - self.start[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of each phrase: a row of numbers, padded with 0 on the left."""
        m, width = phrases.shape
        lo, hi = np.zeros(m, np.int64), np.full(m, len(self.column), np.int64)
        live = np.flatnonzero((phrases < len(self.first) - 1).all(axis=1))
        alive = np.zeros(m, bool)
        alive[live] = True
        for at in reversed(range(width)):
            symbol = phrases[live, at]
            live = live[symbol > 0]
            symbol = symbol[symbol > 0]
            lo[live] = self.first[symbol] + self.rank(symbol, lo[live])
            hi[live] = self.first[symbol] + self.rank(symbol, hi[live])
            alive[live] = lo[live] < hi[live]
            live = live[alive[live]]
        hi[~alive] = lo[~alive]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the given rows."""
        rows, places = rows.copy(), np.empty(len(rows), np.int64)
        waiting, steps = np.arange(len(rows)), 0
        while len(waiting):
            done = self.sampled[rows[waiting]]
            ended = waiting[done]
            places[ended] = self.positions[self.before[rows[ended]]] + steps
            waiting = waiting[~done]
            symbol = self.column[rows[waiting]]
            rows[waiting] = self.first[symbol] + self.rank(symbol, rows[waiting])
            steps += 1
        return places
