"""SimHash near-duplicates: fingerprints linked through a Gray-ordered index of masked bit patterns."""

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.skew import join_to_unique
from .common import components, saved

#: A-Z to a-z, all other bytes as they are.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEED = 42
COUNT_AT_ONCE = 1 << 16
FAN_OUT = 8
PAIRS_AT_ONCE = 1 << 14


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """A bit is 1 if more than half the XXH64 of the word shingles, repeats included, have it. No words: 0."""
    words = (text or b"").translate(LOWER).split()  # bytes are split at ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0] + [e + 1 for e in ends]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1:])], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNT_AT_ONCE):
        part = hashes[at:at + COUNT_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprint_column(text, width: int = 3):
    """The fingerprint of a text column as a signed long."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t, width) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return of(text)


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """The place of each pattern in the Gray code: neighbours in this order differ in one bit."""
    rank = bits.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Fingerprints of several groups in Gray order below a hierarchy of masked patterns.

    A node stands for up to FAN_OUT consecutive nodes of one group. Its mask has the bits in which all
    fingerprints below agree, its pattern the values of those bits.
    """

    def __init__(self, group: np.ndarray, bits: np.ndarray):
        """group and bits must be sorted by group, then by Gray rank."""
        self.bits = bits
        first = np.arange(len(bits) + 1)
        self.levels = [(group, first, bits, np.full(len(bits), ~np.uint64(0)))]
        while len(group) and (group[1:] == group[:-1]).any():
            new = np.r_[True, group[1:] != group[:-1]]
            starts = np.flatnonzero(new)
            inside = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
            heads = np.flatnonzero(inside % FAN_OUT == 0)
            _, _, pattern, mask = self.levels[-1]
            ones = np.bitwise_and.reduceat(pattern & mask, heads)
            zeros = np.bitwise_and.reduceat(~pattern & mask, heads)
            group = group[heads]
            self.levels.append((group, np.r_[heads, len(inside)], ones, ones | zeros))

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of fingerprints of one group that differ in at most distance bits.

        Pairs of nodes are followed from the top. A pair carries the bits already compared and the differences
        counted so far; each level adds only the bits that its masks newly share. A pair over the limit is dropped
        with all below it; a pair that cannot go over the limit is linked whole, as a chain.
        """
        top = len(self.levels) - 1
        nodes = np.arange(len(self.levels[top][0]))
        none = np.zeros(len(nodes), np.uint64)
        todo = [(top, nodes, nodes, none, none.astype(np.int64))]
        while todo:
            level, a, b, seen, count = todo.pop()
            if len(a) > PAIRS_AT_ONCE:
                half = len(a) // 2
                todo += [(level, a[half:], b[half:], seen[half:], count[half:]),
                         (level, a[:half], b[:half], seen[:half], count[:half])]
                continue
            _, first, pattern, mask = self.levels[level]
            shared = mask[a] & mask[b]
            count = count + np.bitwise_count((pattern[a] ^ pattern[b]) & shared & ~seen)
            near = count <= distance
            if level == 0:
                near &= a != b
                yield a[near], b[near]
                continue
            whole = near & (count + np.bitwise_count(~shared) <= distance)
            if whole.any():
                yield self._chains(level, a[whole], b[whole])
            near &= ~whole
            a, b, shared, count = a[near], b[near], shared[near], count[near]
            if not len(a):
                continue
            # All pairs of children, each pair of the same node once.
            na, nb = first[a + 1] - first[a], first[b + 1] - first[b]
            each = np.repeat(np.arange(len(a)), na * nb)
            nth = np.arange(len(each)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
            left, right = first[a][each] + nth // nb[each], first[b][each] + nth % nb[each]
            once = left <= right
            todo.append((level - 1, left[once], right[once], shared[each][once], count[each][once]))

    def _chains(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links from the first fingerprint below each a to all others below a and b."""
        lo, hi, other_lo, other_hi = a, a + 1, b, b + 1
        for k in range(level, 0, -1):
            first = self.levels[k][1]
            lo, hi, other_lo, other_hi = first[lo], first[hi], first[other_lo], first[other_hi]
        head = np.concatenate([np.repeat(lo, hi - lo), np.repeat(lo, other_hi - other_lo)])
        tail = [np.arange(x, y) for x, y in zip(np.r_[lo, other_lo], np.r_[hi, other_hi])]
        return head, np.concatenate(tail)


def join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of a and b in place; the smallest place of a tree is its root."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def fingerprint_links(prints: DataFrame, distance: int = 2, cuts: int | None = None) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) at most distance bits apart.

    The 64 bits are cut into blocks, two more than the distance: near fingerprints agree in at least two whole blocks, so
    each is sent once for every pair of blocks to the task of that pair's values. There a Gray-ordered index finds the
    links. A task returns a spanning forest of them, never all pairs.
    """
    n = cuts or distance + 2
    edge = [64 * i // n for i in range(n + 1)]
    masks = [sum((1 << edge[i + 1]) - (1 << edge[i]) for i in chosen) for chosen in combinations(range(n), n - distance)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(signed)])
    routed = prints.select("fp", F.explode(keys).alias("at")).select("fp", "at.part", "at.key").repartition("part", "key")

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        fp = rows["fp"].to_numpy().view(np.uint64)
        part, key = rows["part"].to_numpy(), rows["key"].to_numpy()
        order = np.lexsort((gray_rank(fp), key, part))
        fp, part, key = fp[order], part[order], key[order]
        group = np.cumsum(np.r_[False, (part[1:] != part[:-1]) | (key[1:] != key[:-1])])
        several = (np.bincount(group) > 1)[group]
        fp, group = fp[several], group[several]
        root = np.arange(len(fp))
        if len(fp):
            for a, b in GrayIndex(group, fp).links(distance):
                join_roots(root, a, b)
        joined = np.flatnonzero(root != np.arange(len(fp)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(fp[joined].view(np.int64)), pa.array(fp[root[joined]].view(np.int64))], names=["a", "b"])

    return routed.mapInArrow(forests, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """Fingerprint and component of each document: doc_id, fp (signed long), component_id.

    Fingerprints at most distance bits apart are linked; a component_id is the smallest doc_id that links lead to, the
    document's own included. NULL, empty and blank texts have no words: their fingerprint is zero and is linked like any
    other. Equal texts, and rows that repeat a doc_id, share a component. A NULL doc_id never names a component unless
    it has no other. All other columns are ignored. An empty table gives no rows.
    """
    marked = saved(docs.select("doc_id", fingerprint_column(F.col("text"), width).alias("fp")), "fingerprints")
    prints = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    rooted = with_roots(prints, distance)
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.select("fp", "root").join(names, "root").select("fp", "component_id")
    return join_to_unique(marked, named, "fp").select("doc_id", "fp", "component_id")


def with_roots(prints: DataFrame, distance: int) -> DataFrame:
    """Distinct fingerprints with the root of their component, the smallest fingerprint that links lead to."""
    found = components(fingerprint_links(prints.select("fp"), distance))
    joined = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    return joined.select(*prints.columns, F.coalesce("component", "fp").alias("root"))


def one_of_each(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """All columns of one row of each component: the row with the smallest doc_id, one of them where rows repeat it.

    A component without any doc_id keeps one row too. Rows are written once with their fingerprints and a row number, the
    choice is made on fingerprints, and the chosen row numbers pick the rows.
    """
    marked = saved(docs.select(F.struct("*").alias("row"), fingerprint_column(F.col("text"), width).alias("fp"),
                               F.monotonically_increasing_id().alias("id")), "rows")
    best = F.min(F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("doc_id"), "id"))
    prints = saved(marked.groupBy("fp").agg(best.alias("best")), "distinct-fingerprints")
    chosen = with_roots(prints, distance).groupBy("root").agg(F.min("best").alias("best")).select("best.id")
    return marked.join(chosen, "id", "left_semi").select("row.*")


def hex_digits(fp):
    """A signed long as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
