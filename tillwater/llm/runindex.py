"""A run-length index over one bounded collection of byte segments.

The suffixes of all segments are sorted (prefix doubling, each segment ended by a mark of
its own); the Burrows-Wheeler transform is kept as runs. Sampled are, for every stretch of
rows that share their next `depth` bytes, the first text place among them. Streaming a
segment backwards through the runs, from the row of its end mark, gives its row at every
place, and from that the earliest place with the same next `depth` bytes.
"""

from __future__ import annotations

import numpy as np

SYMBOLS = 7  # of 9 bits each, in the first sort key


class RunIndex:
    """Index of segments given as one line of bytes and len + 1 offsets, in order of age.

    `depth` is SYMBOLS at least.
    """

    def __init__(self, line: np.ndarray, offsets: np.ndarray, depth: int) -> None:
        n_segments = len(offsets) - 1
        self.sizes = np.diff(offsets)
        size = len(line) + n_segments
        self.ends = offsets[1:] + np.arange(n_segments)  # places of the end marks
        symbol = np.zeros(size + SYMBOLS, np.int64)
        keep = np.ones(size, bool)
        keep[self.ends] = False
        symbol[:size][keep] = line.astype(np.int64) + 1
        rank, half = self.sort(symbol, size, keep, depth)
        order = np.empty(size, np.int64)
        order[rank] = np.arange(size)
        before = np.where(order > 0, symbol[order - 1], 0)
        fresh = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.run_start, self.run_symbol = fresh, before[fresh]
        lengths = np.diff(np.append(fresh, size))
        # Where a run's first row leads: rows of smaller symbols, and earlier runs of its own.
        smaller = np.concatenate([[0], np.cumsum(np.bincount(before, minlength=258))])
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        total = np.cumsum(lengths[by_symbol]) - lengths[by_symbol]
        first = np.searchsorted(self.run_symbol[by_symbol], self.run_symbol[by_symbol])
        self.leads = np.empty(len(fresh), np.int64)
        self.leads[by_symbol] = smaller[self.run_symbol[by_symbol]] + total - total[first]
        # Stretches of rows with the same next `depth` bytes, and the first place of each.
        far = np.minimum(order + depth - half[1], size - 1)
        one, two = half[0][order], half[0][far]
        self.stretch = np.flatnonzero(
            np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
        self.first_place = np.minimum.reduceat(order, self.stretch)

    @staticmethod
    def sort(symbol: np.ndarray, size: int, inside: np.ndarray, depth: int):
        """Ranks of all suffixes, and (ranks, length) of prefixes of over half of `depth`."""
        place = np.arange(size)
        marks = np.flatnonzero(~inside)
        to_end = np.repeat(marks, np.diff(marks, prepend=-1)) - place
        key = np.zeros(size, np.int64)
        for k in range(SYMBOLS):
            key = (key << 9) | np.where(k < to_end, symbol[k : size + k], 0)
        order = np.argsort(key, kind="stable")
        ended = to_end[order] < SYMBOLS
        group = key[order]
        fresh = np.concatenate([[True], group[1:] != group[:-1]]) | ended
        starts = np.maximum.accumulate(np.where(fresh, place, 0))
        rank = np.empty(size, np.int64)
        rank[order] = starts
        single = fresh & np.append(fresh[1:], True)
        # `open_` holds the suffixes that share their rank, in order of it.
        open_ = order[~single]
        reached, half = SYMBOLS, (rank.copy(), SYMBOLS)
        while len(open_):
            group = rank[open_]
            following = rank[open_ + reached]
            order = np.argsort(group * size + following)
            open_, group, following = open_[order], group[order], following[order]
            outer = np.concatenate([[True], group[1:] != group[:-1]])
            fresh = outer | np.concatenate([[True], following[1:] != following[:-1]])
            at = np.arange(len(open_))
            outer_at = np.maximum.accumulate(np.where(outer, at, 0))
            fresh_at = np.maximum.accumulate(np.where(fresh, at, 0))
            rank[open_] = group + fresh_at - outer_at
            single = fresh & np.append(fresh[1:], True)
            open_ = open_[~single]
            reached *= 2
            if reached <= depth:
                half = (rank.copy(), reached)
        # Without ties left, all ranks differ, as they would at any greater length.
        if 2 * half[1] < depth:
            half = (rank, half[1])
        return rank, half

    def earliest(self) -> np.ndarray:
        """For each place of the marked line, the first place with the same next bytes."""
        found = np.empty(int(self.ends[-1]) + 1 if len(self.ends) else 0, np.int64)
        # Rows of the end marks come first, in order of the segments.
        row = np.arange(len(self.ends))
        found[self.ends] = self.ends
        lanes = np.argsort(-self.sizes, kind="stable")
        row, ends, sizes = row[lanes], self.ends[lanes], self.sizes[lanes]
        for step in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            active = int(np.searchsorted(-sizes, -step, side="right"))
            row = row[:active]
            run = np.searchsorted(self.run_start, row, side="right") - 1
            row = self.leads[run] + row - self.run_start[run]
            stretch = np.searchsorted(self.stretch, row, side="right") - 1
            found[ends[:active] - step] = self.first_place[stretch]
        return found
