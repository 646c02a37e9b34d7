"""Exact substring dedup: Burrows-Wheeler transforms of shards merged by interleave refinement."""

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .bwt import least_owners
from .common import saved

BLOCK_BYTES = 8 << 20
CHUNK = 1 << 15
#: Signs merged at once, and the shards they are dealt to: arrays that stay in a core's cache.
MERGE_BYTES = 60_000
SHARDS = 16
#: Length of an anchor. A window of 50 bytes holds 27 of them and is sent along with the one of smallest hash.
ANCHOR = 24
#: Differing pieces under one anchor, counted per block, from which on its windows are dealt out one by one.
SPLIT = 4096
LAST = np.iinfo(np.int64).max
# Odd multipliers for hashes; any would do.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165,
                0x2545F4914F6CDD1D, 0x9FB21C651E98DF25], dtype=np.uint64)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value."""
    head = np.array([a.nbytes for a in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(a.tobytes() for a in arrays))


def unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 8 * len(kinds)
    for size, kind in zip(np.frombuffer(raw, np.int64, len(kinds)), kinds):
        out.append(np.frombuffer(raw[at:at + size], kind))
        at += size
    return out


def ragged(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each run, one run after the other."""
    return np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def anchors(text: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunk by chunk: the first window's place, each window's anchor place, and the hashes of these anchors.

    The anchor is the leftmost place of smallest hash among those inside the window, so equal windows have equal anchors.
    """
    inside = window - ANCHOR + 1
    n = len(text) - window + 1
    text = np.concatenate([text, np.zeros(8, np.uint8)])
    for at in range(0, max(0, n), CHUNK):
        count = min(CHUNK, n - at)
        places = count + inside - 1
        part = text[at:at + places + ANCHOR + 7]
        words = np.ndarray((len(part) - 7,), "<u8", part, strides=(1,))
        h = words[:places] * MIX[0]
        for k in range(1, ANCHOR // 8):
            h += words[8 * k:8 * k + places] * MIX[k]
        h ^= h >> np.uint64(32)
        h *= MIX[3]
        h ^= h >> np.uint64(29)
        low = (h & ~np.uint64((1 << 20) - 1)) | np.arange(places, dtype=np.uint64)
        width = 1
        while width * 2 <= inside:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < inside:
            low = np.minimum(low[:len(low) - (inside - width)], low[inside - width:])
        best = (low[:count] & np.uint64((1 << 20) - 1)).astype(np.int64)
        yield at, best + at, h[best]


class Block:
    """Some whole documents: their bytes, and their windows grouped into runs with the same anchor."""

    def __init__(self, data: bytes, buckets: int, window: int):
        self.window, self.buckets = window, buckets
        self.owner, self.size, self.text = unpacked(data, np.int64, np.int64, np.uint8)
        self.first = np.cumsum(self.size) - self.size
        firsts, hashes, docs, lengths = [], [], [], []
        limit = self.first + self.size - window + 1  # end of the windows of each document
        for at, anchor, h in anchors(self.text, window):
            # A run begins where the anchor or the document changes, and ends there or with the document's windows.
            begins = np.empty(len(anchor), bool)
            begins[0] = True
            begins[1:] = anchor[1:] != anchor[:-1]
            lo, hi = np.searchsorted(self.first, [at, at + len(anchor)])
            begins[self.first[lo:hi] - at] = True
            heads = np.flatnonzero(begins)
            doc = np.searchsorted(self.first, heads + at, side="right") - 1
            length = np.minimum(np.append(heads[1:], len(anchor)), limit[doc] - at) - heads
            some = length > 0
            firsts.append(heads[some] + at)
            lengths.append(length[some])
            hashes.append(h[heads[some]])
            docs.append(doc[some])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        self._take(join(firsts, np.int64), join(lengths, np.int64), join(docs, np.int64), *self._dealt(join(hashes, np.uint64)))

    def _dealt(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and key of hashes."""
        return ((h % np.uint64(self.buckets)).astype(np.int64),
                ((h // np.uint64(self.buckets)) & np.uint64(0xFFFFFFFF)).astype(np.int64))

    def _take(self, first, windows, doc, bucket, key) -> None:
        order = np.argsort((bucket << 32) | key)
        self.run_first, self.run_windows, self.run_doc = first[order], windows[order], doc[order]
        self.run_bucket, self.run_key = bucket[order], key[order]

    def _mixed(self, first: np.ndarray, size: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Hashes h mixed with the bytes of stretches of text, size bytes (8 or more) from first on."""
        at = np.ndarray((len(self.text) + 1,), "<u8", np.concatenate([self.text, np.zeros(8, np.uint8)]), strides=(1,))
        for k in range(-(-int(np.max(size, initial=0)) // 8)):
            # The last word of a stretch may overlap the one before it; shorter stretches repeat it.
            words = at[np.minimum(first + np.maximum(0, np.minimum(8 * k, size - 8)), len(self.text))]
            h = (h ^ words) * MIX[k % len(MIX)]
            h = h ^ (h >> np.uint64(31))
        return h

    def distinct_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The first run of each distinct anchor, and the distinct anchor of each run."""
        new = np.r_[True, (np.diff(self.run_key) != 0) | (np.diff(self.run_bucket) != 0)] if len(self.run_key) else np.empty(0, bool)
        return np.flatnonzero(new), np.cumsum(new) - 1

    def prints(self) -> Iterator[tuple[int, bytes]]:
        """Per bucket: its distinct anchors here, whether several documents have each, and how many differing pieces it has."""
        heads, of = self.distinct_keys()
        if not len(heads):
            return
        kinds = np.ones(len(heads), np.uint32)
        rows = np.flatnonzero(np.bincount(of)[of] > 1)
        size = self.run_windows[rows] + self.window - 1
        h = self._mixed(self.run_first[rows], size, size.astype(np.uint64))
        order = np.lexsort((h, of[rows]))
        at, h = of[rows][order], h[order]
        new = np.r_[True, (at[1:] != at[:-1]) | (h[1:] != h[:-1])][:len(at)]
        kinds[np.unique(at)] = np.bincount(at[new], minlength=len(heads))[np.unique(at)]
        low, high = np.minimum.reduceat(self.run_doc, heads), np.maximum.reduceat(self.run_doc, heads)
        bucket = self.run_bucket[heads]
        for rows in np.split(np.arange(len(heads)), np.flatnonzero(np.diff(bucket)) + 1):
            yield int(bucket[rows[0]]), packed(self.run_key[heads[rows]].astype(np.uint32), low[rows] < high[rows], kinds[rows])

    def keep_repeated(self, masks: dict[int, bytes]) -> None:
        """Keep the runs whose anchor another document has too, and cut those of hot anchors into windows.

        masks: per bucket a number for each distinct anchor: 0 drops it, 1 keeps it, 1 + k deals its windows out to 2^k keys,
        by a hash of the whole window. Equal windows have equal anchors, so they meet again.
        """
        heads, of = self.distinct_keys()
        if not len(heads):
            return
        bucket = self.run_bucket[heads]
        here, counts = np.unique(bucket, return_counts=True)
        codes = np.concatenate([unpacked(masks[b], np.uint8)[0] for b in here.tolist()])[of]
        keep, hot = codes == 1, np.flatnonzero(codes > 1)
        windows = self.run_windows[hot]
        run = np.repeat(hot, windows)
        first = ragged(self.run_first[hot], windows)
        part = self._mixed(first, np.full(len(first), self.window), np.zeros(len(first), np.uint64))
        part &= (np.uint64(1) << (codes[run] - 1).astype(np.uint64)) - np.uint64(1)
        h = ((self.run_bucket[run].astype(np.uint64) * MIX[0]) ^ self.run_key[run].astype(np.uint64)) * MIX[1]
        h = ((h ^ (h >> np.uint64(32))) + part) * MIX[2]
        bucket, key = self._dealt(h ^ (h >> np.uint64(32)))
        join = lambda kept, new: np.concatenate([kept[keep], new])
        self._take(join(self.run_first, first), join(self.run_windows, np.ones(len(first), np.int64)),
                   join(self.run_doc, self.run_doc[run]), join(self.run_bucket, bucket), join(self.run_key, key))

    def pieces(self) -> tuple["Pieces", np.ndarray]:
        """Distinct pieces of text under the kept runs in the order of buckets, and the piece of each run."""
        size = self.run_windows + self.window - 1
        width = -(-int(size.max(initial=0)) // 8)
        words = np.empty((len(size), width), "<u8")
        at = np.ndarray((len(self.text) + 1,), "<u8", np.concatenate([self.text, np.zeros(8 * width + 8, np.uint8)]), strides=(1,))
        for k in range(width):
            last = np.clip(size - 8 * k, 0, 8)
            mask = np.where(last == 8, ~np.uint64(0), (np.uint64(1) << (8 * last).astype(np.uint64) % np.uint64(64)) - np.uint64(1))
            words[:, k] = at[np.minimum(self.run_first + 8 * k, len(self.text))] & mask
        return Pieces(self.run_bucket, self.run_key, size, self.owner[self.run_doc], words).distinct()


class Pieces:
    """Strings of at least a window under anchors: bucket, key, length, smallest owner, and bytes in words, padded by zeros."""

    def __init__(self, bucket, key, size, owner, words):
        self.bucket, self.key, self.size, self.owner, self.words = bucket, key, size, owner, words

    @classmethod
    def from_text(cls, bucket, key, size, owner, text) -> "Pieces":
        table = np.zeros((len(size), -(-int(size.max(initial=0)) // 8) * 8), np.uint8)
        table[np.arange(table.shape[1]) < size[:, None]] = text
        return cls(bucket, key, size, owner, table.view("<u8"))

    def text(self, rows=slice(None)) -> np.ndarray:
        """The bytes of some pieces, one after the other."""
        table = np.ascontiguousarray(self.words[rows]).view(np.uint8)
        return table[np.arange(table.shape[1]) < self.size[rows][:, None]]

    def distinct(self) -> tuple["Pieces", np.ndarray]:
        """Equal pieces as one with their smallest owner, sorted by bucket and key; and the new number of each."""
        n = len(self.size)
        if not n:
            return self, np.empty(0, np.int64)
        h = self.size.astype(np.uint64) * MIX[11]
        for k in range(self.words.shape[1]):
            h = (h ^ self.words[:, k]) * MIX[k % len(MIX)]
            h ^= h >> np.uint64(31)
        # One sort key: the number of the anchor in order, then the hash.
        by_anchor = np.argsort((self.bucket << 32) | self.key)
        new = np.r_[True, (np.diff(self.key[by_anchor]) != 0) | (np.diff(self.bucket[by_anchor]) != 0)]
        anchor = np.empty(n, np.uint64)
        anchor[by_anchor] = np.cumsum(new)
        h = (anchor << np.uint64(32)) | (h >> np.uint64(32))
        order = np.argsort(h)
        tied = h[order[1:]] == h[order[:-1]]
        same = tied & self._equal(order)
        if (same != tied).any():  # two pieces of an anchor share a hash
            order = np.lexsort((*self.words.T, self.size, h))
            same = (h[order[1:]] == h[order[:-1]]) & self._equal(order)
        heads = np.flatnonzero(np.r_[True, ~same])
        number = np.empty(n, np.int64)
        number[order] = np.cumsum(np.r_[True, ~same]) - 1
        first = order[heads]
        owner = np.minimum.reduceat(self.owner[order], heads)
        return Pieces(self.bucket[first], self.key[first], self.size[first], owner, self.words[first]), number

    def _equal(self, order: np.ndarray) -> np.ndarray:
        """Whether each piece but the first in this order equals the one before it."""
        rows = self.words[order]
        return (self.size[order[1:]] == self.size[order[:-1]]) & (rows[1:] == rows[:-1]).all(axis=1)


def first_owners(pieces: Pieces, shard: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest owner of each window of each piece, as stretches: their number per piece, lengths, owners.

    Equal pieces become one. Where all pieces of an anchor are one, its smallest owner holds for all its windows. Pieces that
    share an anchor but differ go to the transforms of their shards, which are merged.
    """
    one, number = pieces.distinct()
    n = len(one.size)
    windows = one.size - window + 1
    starts = np.cumsum(windows) - windows
    value = np.repeat(one.owner, windows)
    alone = np.ones(n, bool)
    if n > 1:
        same = (one.key[1:] == one.key[:-1]) & (one.bucket[1:] == one.bucket[:-1])
        alone[1:] &= ~same
        alone[:-1] &= ~same
    mixed = np.flatnonzero(~alone)
    if len(mixed):
        home = np.empty(n, np.int64)
        home[number[::-1]] = shard[::-1]  # the shard of its first copy
        for rows in _whole_anchors(one, mixed):
            value[ragged(starts[rows], windows[rows])] = least_owners(
                one.text(rows), one.size[rows], home[rows] % SHARDS, one.owner[rows], window)
    # Stretches of equal owners inside each piece, then for each piece asked for.
    new = np.r_[True, np.diff(value) != 0] if len(value) else np.empty(0, bool)
    new[starts] = True
    heads = np.flatnonzero(new)
    lengths, owners = np.diff(np.r_[heads, len(value)]), value[heads]
    of = np.searchsorted(starts, heads, side="right") - 1
    count = np.bincount(of, minlength=n)
    at = ragged((np.cumsum(count) - count)[number], count[number])
    return count[number], lengths[at], owners[at]


def _whole_anchors(pieces: Pieces, rows: np.ndarray) -> list[np.ndarray]:
    """Rows cut between anchors, whose pieces need no comparison, into parts of about MERGE_BYTES."""
    part = (np.cumsum(pieces.size[rows]) - pieces.size[rows]) // MERGE_BYTES
    new = np.r_[True, (np.diff(pieces.key[rows]) != 0) | (np.diff(pieces.bucket[rows]) != 0)]
    part = part[new][np.cumsum(new) - 1]  # an anchor stays in the part in which it begins
    return np.split(rows, np.flatnonzero(np.diff(part)) + 1)


def repeated_substrings(docs: DataFrame, window: int = 50, block_bytes: int = BLOCK_BYTES, buckets: int | None = None,
                        split: int = SPLIT) -> DataFrame:
    """What remains of each document: doc_id, n_bytes, starts and ends of removed runs (bytes), kept (binary).

    A byte goes if a string of window bytes that covers it also starts in a document with a smaller doc_id. Strings are judged
    on the input, overlaps count, and matches never cross documents. NULL text is empty. Rows without doc_id come after all
    others and don't remove from each other; rows that repeat a doc_id don't either. Every row gives one row. Other columns
    are ignored. An empty table gives no rows.

    Whole documents are packed into compressed blocks of about block_bytes, which are the shards. Equal windows have equal
    anchors, so everything is dealt out by anchor, in buckets whose number and size both grow with the square root of the text
    unless their number is given. A task holds one block or what one bucket received. First only fingerprints of anchors travel,
    to find those that several documents have. Then each block sends the pieces of text around these, equal ones once; a bucket
    merges the Burrows-Wheeler transforms of its shards and returns the smallest owner of every window. A passage that
    many documents share is sent once per block, and no pairs of documents are formed. An anchor with more than split
    differing pieces, such as one at the edge of a passage that stands in many texts, has its windows dealt out by a second key that equal
    windows share, a hash of the whole window, to so many keys that each gets about split of them.
    """
    blocks = _blocks(docs, block_bytes)
    if buckets is None:
        total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
        buckets = max(1, ceil(sqrt(total / (1 << 14))))

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch["block"].to_pylist(), batch["data"]):
                rows = list(Block(data.as_py(), buckets, window).prints())
                yield _rows([b for b, _ in rows], [number] * len(rows), [x for _, x in rows])

    def repeated(bucket: pa.Table) -> pa.Table:
        found = [unpacked(x, np.uint32, np.bool_, np.uint32) for x in bucket["data"].to_pylist()]
        keys, number, counts = np.unique(np.concatenate([k for k, _, _ in found]), return_inverse=True, return_counts=True)
        several = np.unique(np.concatenate([k[m] for k, m, _ in found]))
        kinds = np.bincount(number, weights=np.concatenate([n for _, _, n in found]))
        parts = np.where(kinds > split, np.ceil(np.log2(kinds * (window - ANCHOR + 1) / split)), 0)
        code = np.where((counts > 1) | np.isin(keys, several), 1 + parts, 0).astype(np.uint8)
        masks = [packed(code[np.searchsorted(keys, k)]) for k, _, _ in found]
        return pa.Table.from_batches([_rows(bucket["bucket"].to_pylist(), bucket["block"].to_pylist(), masks)])

    def opened(left: pa.Table, right: pa.Table) -> tuple[int, Block]:
        block = Block(left["data"][0].as_py(), buckets, window)
        block.keep_repeated({b: x for b, x, reply in zip(*(right[c].to_pylist() for c in ("bucket", "data", "reply"))) if not reply})
        return left["block"][0].as_py(), block

    def sent(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([_rows([], [], [])])
        number, block = opened(left, right)
        pieces, _ = block.pieces()
        names, payloads = [], []
        for rows in np.split(np.arange(len(pieces.size)), np.flatnonzero(np.diff(pieces.bucket)) + 1):
            if len(rows):
                names.append(int(pieces.bucket[rows[0]]))
                payloads.append(packed(pieces.key[rows].astype(np.uint32), pieces.size[rows].astype(np.uint16), pieces.owner[rows],
                                       pieces.text(rows)))
        return pa.Table.from_batches([_rows(names, [number] * len(names), payloads)])

    def judged(bucket: pa.Table) -> pa.Table:
        parts = [unpacked(x, np.uint32, np.uint16, np.int64, np.uint8) for x in bucket["data"].to_pylist()]
        counts = np.array([len(p[0]) for p in parts])
        key, size, owner, text = (np.concatenate([p[i] for p in parts]) for i in range(4))
        pieces = Pieces.from_text(np.zeros(len(key), np.int64), key.astype(np.int64), size.astype(np.int64), owner, text)
        number, length, first = first_owners(pieces, np.repeat(np.arange(len(parts)), counts), window)
        cut = np.cumsum(counts)[:-1]
        inner = np.r_[0, np.cumsum(number)][np.cumsum(counts)[:-1]]
        replies = [packed(n.astype(np.uint16), x.astype(np.uint16), o) for n, x, o in zip(
            np.split(number, cut), np.split(length, inner), np.split(first, inner))]
        return pa.Table.from_batches([_rows(bucket["bucket"].to_pylist(), bucket["block"].to_pylist(), replies)])

    def finished(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return kept_rows([], [], [], [], [])
        _, block = opened(left, right)
        _, number = block.pieces()
        answers = sorted((b, x) for b, x, reply in zip(*(right[c].to_pylist() for c in ("bucket", "data", "reply"))) if reply)
        parts = [unpacked(x, np.uint16, np.uint16, np.int64) for _, x in answers] or [[np.empty(0, np.int64)] * 3]
        count, length, owner = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(3))
        begin = np.cumsum(length) - length
        heads = np.cumsum(count) - count
        at = ragged(heads[number], count[number])
        run = np.repeat(np.arange(len(number)), count[number])
        goes = owner[at] < block.owner[block.run_doc[run]]
        at, run = at[goes], run[goes]
        first = block.run_first[run] + begin[at] - begin[heads[number[run]]]
        change = np.zeros(len(block.text) + 1, np.int32)
        np.add.at(change, first, 1)
        np.add.at(change, first + length[at] + window - 1, -1)
        gone = np.cumsum(change[:-1], out=change[:-1]) > 0
        rows = [], [], [], [], []
        names = left["ids"][0].as_py()
        for i, (a, n) in enumerate(zip(block.first.tolist(), block.size.tolist())):
            mine = gone[a:a + n]
            edges = np.flatnonzero(np.diff(np.r_[False, mine, False]))
            for to, x in zip(rows, (names[i], n, edges[::2], edges[1::2], block.text[a:a + n][~mine].tobytes())):
                to.append(x)
        return kept_rows(*rows)

    def kept_rows(ids, sizes, starts, ends, kept) -> pa.Table:
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(sizes, pa.int64()),
                         "starts": pa.array(starts, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64())),
                         "kept": pa.array(kept, pa.binary())})

    cell = "bucket long, block long, data binary"
    by_block = blocks.groupBy("block")
    masks = saved(blocks.mapInArrow(fingerprints, cell).groupBy("bucket").applyInArrow(repeated, cell), "masks")
    masks = masks.withColumn("reply", F.lit(False))
    pieces = by_block.cogroup(masks.groupBy("block")).applyInArrow(sent, cell)
    replies = pieces.groupBy("bucket").applyInArrow(judged, cell).withColumn("reply", F.lit(True))
    return by_block.cogroup(masks.unionByName(replies).groupBy("block")).applyInArrow(
        finished, "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary")


def _rows(buckets: list, blocks: list, data: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(blocks, pa.int64()), pa.array(data, pa.binary())],
                                      names=["bucket", "block", "data"])


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks of whole documents of about block_bytes: block, ids, n_bytes, data (order, lengths and bytes, compressed)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def block() -> pa.RecordBatch:
            owner = np.array([LAST if i is None else i for i in ids], np.int64)
            data = packed(owner, np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8))
            return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([size], pa.int64()),
                                               pa.array([data], pa.binary())], names=["ids", "n_bytes", "data"])

        for batch in batches:
            for i, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                text = text or b""
                if texts and size + len(text) > block_bytes:
                    yield block()
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(text)
                size += len(text)
        if texts:
            yield block()

    packs = docs.select("doc_id", "text").mapInArrow(pack, "ids array<long>, n_bytes long, data binary")
    return saved(packs.withColumn("block", F.monotonically_increasing_id()), "blocks")


#: The same bytes from all 50-byte strings, as hex digits, in DuckDB.
ORACLE = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS own, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
places AS (
  SELECT r, own, h, i, substr(h, 2 * i + 1, 100) AS win
  FROM (SELECT r, own, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS i FROM docs)),
first AS (SELECT win, min(own) AS least FROM places GROUP BY win HAVING min(own) < max(own)),
hit AS (SELECT r, i FROM places JOIN first USING (win) WHERE least < own),
marked AS (SELECT r, i, CASE WHEN i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -1000) + 50 THEN 1 ELSE 0 END AS new FROM hit),
numbered AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS span FROM marked),
spans AS (SELECT r, span, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY r, span),
gaps AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
kept AS (
  SELECT d.r, string_agg(substr(d.h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(d.h), 2 * max(b) + 1) AS h,
         sum(b - a) AS n_removed, count(*) AS n_spans
  FROM gaps JOIN docs d USING (r) GROUP BY d.r)
SELECT doc_id, (len(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (r)
"""
