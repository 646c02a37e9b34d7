"""Merging Burrows-Wheeler transforms of short strings by refining their interleave."""

import numpy as np

from .fmindex import suffix_order

#: Distinct signs up to which two of them fit a sort key of 16 bits.
FEW_SIGNS = 255


class ShardTransform:
    """Transform of one shard's strings, each with an end sign of its own below all bytes.

    symbols: the sign before each sorted suffix, 0 for an end sign, else byte + 1; before a whole string stands its own
    end sign. back: where the suffix that begins with this sign is sorted.
    string, offset: where each sorted suffix starts.
    """

    def __init__(self, strings: np.ndarray, sizes: np.ndarray):
        """strings: the bytes of all strings one after the other."""
        n = len(sizes)
        firsts = np.cumsum(sizes + 1) - (sizes + 1)
        ends = firsts + sizes
        text = np.zeros(int(sizes.sum()) + n, np.int64)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = strings.astype(np.int64) + n
        text[ends] = np.arange(n)
        order = suffix_order(text)
        self.string = np.repeat(np.arange(n), sizes + 1)[order]
        self.offset = order - firsts[self.string]
        signs = np.where(inside, text - n + 1, 0).astype(np.uint16)
        self.symbols = np.where(self.offset > 0, signs[order - 1], 0)
        # The k-th suffix that begins with a sign comes from the k-th row that stands after one; end signs by their strings.
        after = np.argsort(self.symbols, kind="stable")
        self.back = np.empty(len(text), np.int64)
        self.back[after[n:]] = np.arange(n, len(text))
        self.back[after[:n]] = self.string[after[:n]]


def merge(shards: list[ShardTransform], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' sorted suffixes, as rows of all shards in turn, and each one's group of equal prefixes.

    A round takes the interleave that is right for j signs, reads the transforms along it, and deals the entries out by
    the signs before them, keeping their order: that is the interleave right for more signs. Two neighbours share
    these if they were dealt to the same place and what they came from shared j, so in the end a group is an interval of
    common prefix depth or more. Suffixes are never compared. Where two signs fit one key, a round deals out by two at
    a time. End signs count as equal, and nothing is read beyond them.
    """
    used, symbols = np.unique(np.concatenate([s.symbols for s in shards]), return_inverse=True)
    firsts = np.cumsum([0] + [len(s.symbols) for s in shards[:-1]])
    back = np.concatenate([s.back + a for s, a in zip(shards, firsts)])
    # Keys to deal out by, rows to go to, and rows whose end sign hides what they came from.
    rounds = [(symbols.astype(np.uint16), back, symbols == 0)] * depth
    if len(used) <= FEW_SIGNS:
        second = symbols[back]
        pairs = np.where(second > 0, second * len(used) + symbols, 0).astype(np.uint16)
        rounds = [(pairs, back[back], (symbols == 0) | (second == 0))] * (depth // 2) + rounds[:depth % 2]
    rows = np.arange(len(symbols))
    group = np.zeros(len(symbols), np.int32)
    for keys, to, hidden in rounds:
        key = keys[rows]
        dealt = np.argsort(key, kind="stable")
        key = key[dealt]
        came = np.where(hidden[rows], np.int32(-1), group)[dealt]
        rows = to[rows[dealt]]
        np.cumsum((key[1:] != key[:-1]) | (came[1:] != came[:-1]), out=group[1:])
        group[0] = 0
    return rows, group


def least_owners(strings: np.ndarray, sizes: np.ndarray, shard: np.ndarray, owner: np.ndarray, depth: int) -> np.ndarray:
    """For every substring of the given length, the smallest owner of a string that holds it.

    strings, sizes: bytes of all strings and their lengths, each at least depth. shard: the shard of each string.
    Returned are len - depth + 1 values per string, one string after the other.
    """
    if not len(sizes):
        return np.empty(0, np.int64)
    firsts = np.cumsum(sizes) - sizes
    windows = sizes - depth + 1
    out_first = np.cumsum(windows) - windows
    order = np.argsort(shard, kind="stable")
    members = np.split(order, np.flatnonzero(np.diff(shard[order])) + 1)
    transforms = []
    for rows in members:
        each = np.repeat(firsts[rows] - (np.cumsum(sizes[rows]) - sizes[rows]), sizes[rows])
        transforms.append(ShardTransform(strings[each + np.arange(len(each))], sizes[rows]))
    rows, group = merge(transforms, depth)
    string = np.concatenate([m[t.string] for m, t in zip(members, transforms)])[rows]
    offset = np.concatenate([t.offset for t in transforms])[rows]
    whole = offset < windows[string]
    value = np.where(whole, owner[string], np.iinfo(np.int64).max)
    least = np.minimum.reduceat(value, np.flatnonzero(np.r_[True, np.diff(group) != 0]))[group]
    out = np.empty(int(windows.sum()), np.int64)
    out[out_first[string[whole]] + offset[whole]] = least[whole]
    return out
