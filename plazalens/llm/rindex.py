"""A run-length index of a block of strings: the Burrows-Wheeler transform as runs, with text positions sampled at run ends.

Copies make long runs, so the index grows with what is new in the block. Strings are streamed through it backwards, all at once;
each step gives the row of the suffix that begins there. A row lies in at most one interval of suffixes that share ``depth`` bytes:
the place's matching statistic reaches ``depth`` exactly if there is one.
"""

import numpy as np

FIRST = 7  # symbols that one number holds at first; doubled from there
NONE = 256  # stands for the closing symbol of a string in the transform


class RunIndex:
    """Index of ``strings`` (arrays of bytes). Every string has a closing symbol of its own, below all bytes and in the strings' order."""

    def __init__(self, strings: list[np.ndarray], depth: int):
        lengths = np.array([len(s) for s in strings], np.int64)
        self.m, self.depth = len(strings), depth
        self.stop = np.cumsum(lengths + 1) - 1
        self.begin = self.stop - lengths
        n = int(lengths.sum()) + self.m
        data, owner = np.zeros(n, np.int64), np.repeat(np.arange(self.m), lengths + 1)
        inside = np.ones(n, bool)
        inside[self.stop] = False
        if self.m:
            data[inside] = np.concatenate(strings)
        order, equal = self._sorted(data, inside, owner)
        symbol = np.concatenate((np.zeros(1, np.int64), data[:-1])) if n else data
        symbol[self.begin] = NONE
        before = symbol[order]
        # runs: first rows, symbols, and the row that the first one's suffix has when its symbol is put in front
        first = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1]))) if n else np.zeros(0, np.int64)
        sizes = np.diff(np.concatenate((first, [n])))
        symbols = before[first]
        below = self.m + np.concatenate(([0], np.cumsum(np.bincount(data[inside], minlength=256))))[:256]
        by_symbol = np.argsort(symbols, kind="stable")
        earlier = np.cumsum(sizes[by_symbol]) - sizes[by_symbol]  # rows of the same or a smaller symbol in runs before
        group = np.searchsorted(symbols[by_symbol], np.arange(NONE + 1))
        offset = np.concatenate((earlier, [n]))[group]
        target = np.empty(len(first), np.int64)
        target[by_symbol] = earlier - offset[symbols[by_symbol]]
        self.first, self.target = first, target + np.where(symbols < NONE, below[np.minimum(symbols, 255)], 0)
        self.shift = self.target - first
        self.last_at = order[first + sizes - 1] if n else order  # sampled run ends
        self.run_of = np.repeat(np.arange(len(first), dtype=np.int32), sizes)  # directory of the runs by row
        self._intervals(order, equal, owner)

    def _sorted(self, data: np.ndarray, inside: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array by prefix doubling, and for each place a number that tells the next ``half`` bytes apart."""
        n, place = len(data), np.arange(len(data))
        stop = self.stop[owner]
        padded = np.concatenate((np.where(inside, data + 1, 0), np.zeros(FIRST, np.int64)))
        key, left = np.zeros(n, np.int64), stop - place
        length = min(FIRST, self.depth)
        for j in range(length):
            key *= 257
            key += padded[j : n + j]
        # what is behind a string's end doesn't count
        near = np.flatnonzero(left < length)
        cut = np.zeros(len(near), np.int64)
        for j in range(length):
            cut *= 257
            cut += padded[near + j] * (left[near] > j)
        key[near] = cut
        rank, tied = _ranks(key)
        self.half, equal = 1, None
        while True:
            if length <= self.depth:
                self.half, equal = length, rank
            if not len(tied):
                break
            # only suffixes that are not told apart yet are sorted again; where one ends within what is compared already, its string decides
            beyond = tied + length
            after = np.where(beyond >= stop[tied], owner[tied], self.m + rank[np.minimum(beyond, n - 1)])
            group = rank[tied]
            finer, still = _ranks(group * (n + self.m + 1) + after)
            # places in ``finer`` begin at 0, those of a group at its rank
            sizes = np.bincount(group, minlength=n)
            now = rank.copy()
            now[tied] = group + finer - (np.cumsum(sizes) - sizes)[group]
            rank, tied = now, tied[still]
            length *= 2
        order = np.empty(n, np.int64)
        order[rank] = place
        return order, equal

    def _intervals(self, order: np.ndarray, equal: np.ndarray, owner: np.ndarray) -> None:
        """First and last rows of the suffixes that share ``depth`` bytes, where there are two or more."""
        n = len(order)
        fits = order + self.depth <= self.stop[owner[order]]
        same = np.zeros(n + 1, bool)
        if n and equal is not None:
            parts = [equal[np.minimum(order + at, n - 1)] for at in (*range(0, self.depth - self.half, self.half), self.depth - self.half)]
            same[1:n] = fits[1:] & fits[:-1]
            for p in parts:
                same[1:n] &= p[1:] == p[:-1]
        opening = ~same[:-1] & same[1:]
        self.opens, self.closes = np.flatnonzero(opening), np.flatnonzero(same[:-1] & ~same[1:])
        # directory of the intervals by row
        self.interval_of = np.where(same[:-1] | same[1:], np.cumsum(opening, dtype=np.int32) - np.int32(1), np.int32(-1))

    def back(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that are one symbol longer. Rows of whole strings have none."""
        return self.shift[self.run_of[rows]] + rows

    def place(self, row: int) -> int:
        """Text place of a row: back steps to a sampled run end (or a string's begin) and their number."""
        steps = 0
        ends = np.concatenate((self.first[1:], [len(self)])) - 1
        while True:
            run = int(np.searchsorted(self.first, row, "right")) - 1
            if row == ends[run]:
                return int(self.last_at[run]) + steps
            row, steps = int(self.back(np.array([row]))[0]), steps + 1

    def __len__(self) -> int:
        return int(self.stop[-1]) + 1 if self.m else 0

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """Places (in the strings laid end to end, closing symbols included) whose next ``depth`` bytes occur again, and the number of
        their interval."""
        lengths = self.stop - self.begin
        order = np.argsort(-lengths, kind="stable")  # those still going on are in front
        rows, lengths = order.copy(), lengths[order]
        places, numbers = [], []
        falling = -lengths
        for step in range(1, int(lengths[0]) + 1 if self.m else 0):
            n = int(np.searchsorted(falling, -step, "right"))
            rows = self.back(rows[:n])
            if step >= self.depth and len(self.opens):
                k = self.interval_of[rows]
                hit = np.flatnonzero(k >= 0)
                places.append(self.stop[order[hit]] - step)
                numbers.append(k[hit].astype(np.int64))
        empty = [np.zeros(0, np.int64)]
        return np.concatenate(places or empty), np.concatenate(numbers or empty)


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many keys are smaller than each, and the places of the keys that are there more than once."""
    order = np.argsort(keys)  # equal keys get one rank, so their order is free, and the unstable sort is several times faster
    ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    size = np.diff(np.concatenate((first, [len(keys)])))
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.repeat(first, size)
    several = np.zeros(len(keys), bool)
    several[order] = np.repeat(size > 1, size)
    return rank, np.flatnonzero(several)
