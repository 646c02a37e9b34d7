"""An FM-index over a sequence of numbers: backward search by wavelet-tree ranks, places from sampled suffixes."""

import numpy as np

SAMPLE = 4


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of all suffixes in sorted order, by doubling the sorted length. A suffix comes before those it starts."""
    n = len(text)
    rank = text.astype(np.int64)
    width = 1
    while True:
        key = rank * (int(rank.max(initial=0)) + 2)
        key[:max(0, n - width)] += rank[width:] + 1
        order = np.argsort(key)
        in_order = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, in_order[1:] != in_order[:-1]][:n])
        width *= 2
        if n == 0 or rank[order[-1]] == n - 1:
            return order


class WaveletTree:
    """Ranks in a sequence of numbers below a limit: one row of bits per binary digit, split by digit at every level."""

    def __init__(self, values: np.ndarray, limit: int):
        self.levels = []
        values = values.astype(np.int64)
        for digit in reversed(range(max(1, int(limit - 1).bit_length()))):
            ones = (values >> digit) & 1
            before = np.r_[0, np.cumsum(ones)].astype(np.int32)
            zeros = len(values) - int(before[-1])
            self.levels.append((digit, before, zeros))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def rank(self, value: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each value stands before each place."""
        start = np.zeros_like(place)
        for digit, before, zeros in self.levels:
            one = ((value >> digit) & 1).astype(bool)
            place = np.where(one, zeros + before[place], place - before[place])
            start = np.where(one, zeros + before[start], start - before[start])
        return place - start


class FMIndex:
    """Index of text, numbers from 1 to limit - 1; 0 is added as its end."""

    def __init__(self, text: np.ndarray, limit: int):
        text = np.r_[text, 0].astype(np.int64)
        order = suffix_order(text)
        self.last = text[order - 1]
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=limit))]
        self.tree = WaveletTree(self.last, limit)
        kept = order % SAMPLE == 0
        self.sampled = np.where(kept, order, -1)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of phrases that occur, with the first and the end of their ranges of sorted suffixes."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.last))
        for column in reversed(range(phrases.shape[1])):
            value = phrases[which, column]
            low = self.first[value] + self.tree.rank(value, low)
            high = self.first[value] + self.tree.rank(value, high)
            some = low < high
            which, low, high = which[some], low[some], high[some]
        return which, low, high

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows start: step back until a sampled suffix, and count the steps."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        away = np.flatnonzero(self.sampled[rows] < 0)
        while len(away):
            value = self.last[rows[away]]
            rows[away] = self.first[value] + self.tree.rank(value, rows[away])
            steps[away] += 1
            away = away[self.sampled[rows[away]] < 0]
        return self.sampled[rows] + steps
