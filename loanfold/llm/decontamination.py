"""Benchmark decontamination: an FM-index per shard of training text, searched for the windows of test items."""

import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from .common import byte_slices, saved
from .fmindex import FMIndex

#: A-Z to a-z; every byte that is no letter, digit or part of a wider character to a space.
WORDS = bytes(b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
SHARD_BYTES = 8 << 20
BLOCK_WINDOWS = 200_000
GAP = 1  # the number between runs of words; words have numbers from 2


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORDS).split()


def item_windows(benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Distinct (item, window): width consecutive words, or all words of a shorter item. NULL item_ids are named ''."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                words = words_of(text)
                found = {b" ".join(words[i:i + width]).decode() for i in range(max(1, len(words) - width + 1))} - {""}
                yield pa.RecordBatch.from_pydict(
                    {"item": pa.array([item] * len(found), pa.string()), "window": pa.array(sorted(found), pa.string())})

    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return named.mapInArrow(cut, "item string, window string").distinct()


class Phrases:
    """A block of item windows as numbers of words, grouped by length."""

    def __init__(self, pairs: list[tuple[str, str]]):
        items: dict[str, list[str]] = {}
        for item, window in pairs:
            items.setdefault(window, []).append(item)
        self.number: dict[bytes, int] = {}
        grouped: dict[int, tuple[list, list]] = {}
        for window in sorted(items):
            words = window.encode().split(b" ")
            row = [self.number.setdefault(w, len(self.number) + GAP + 1) for w in words]
            rows, owners = grouped.setdefault(len(words), ([], []))
            rows.append(row)
            owners.append(items[window])
        self.by_length = {n: (np.array(rows, dtype=np.int64), owners) for n, (rows, owners) in grouped.items()}
        self.shortest = min(self.by_length, default=0)

    def occurrences(self, numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[list[str]]]]:
        """Per length of window: the length, the places where windows occur, which window each is, and the windows' items.

        numbers: a shard's words, 0 for words of no window and between documents. Only runs of known words at least
        as long as the shortest window can hold one, so the index is built over these runs with gaps between them.
        """
        if not self.shortest:
            return
        edges = np.flatnonzero(np.diff(np.r_[False, numbers != 0, False]))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.shortest
        starts, sizes = starts[long], (ends - starts)[long]
        if not len(starts):
            return
        firsts = np.cumsum(sizes + 1) - (sizes + 1)
        origin = np.repeat(starts - firsts, sizes + 1) + np.arange(int((sizes + 1).sum()))
        text = numbers[np.minimum(origin, len(numbers) - 1)]
        text[firsts + sizes] = GAP
        index = FMIndex(text, len(self.number) + GAP + 1)
        for length, (rows, owners) in self.by_length.items():
            which, low, high = index.search(rows)
            each = np.repeat(np.arange(len(which)), high - low)
            inside = np.arange(len(each)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
            yield length, origin[index.places(low[each] + inside)], which[each], owners


def search_shard(texts: list[bytes | None], phrases: Phrases) -> list[tuple[int, list[int], list[int], list[str]]]:
    """Per text: its number of words, the starts and ends (in words) of merged hit spans, the items that occur."""
    numbers, sizes = array("i"), []
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        numbers.extend(map(phrases.number.get, words, repeat(0)))
        numbers.append(0)
    all_numbers = np.frombuffer(numbers, np.int32)
    firsts = np.cumsum(np.array(sizes) + 1) - (np.array(sizes) + 1)
    change = np.zeros(len(all_numbers) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for length, places, which, owners in phrases.occurrences(all_numbers):
        np.add.at(change, places, 1)
        np.add.at(change, places + length, -1)
        doc = np.searchsorted(firsts, places, side="right") - 1
        for d, w in np.unique(np.stack([doc, which]), axis=1).T if len(doc) else ():
            items[d].update(owners[w])
    edges = np.flatnonzero(np.diff(np.r_[False, np.cumsum(change) > 0, False]))
    starts, ends = edges[::2], edges[1::2]
    doc = np.searchsorted(firsts, starts, side="right") - 1
    found = [(n, [], [], sorted(own)) for n, own in zip(sizes, items)]
    for d, s, e in zip(doc.tolist(), (starts - firsts[doc]).tolist(), (ends - firsts[doc]).tolist()):
        found[d][1].append(s)
        found[d][2].append(e)
    return found


def merged(starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Overlapping and touching spans as one."""
    out: list[list[int]] = []
    for s, e in sorted(zip(starts, ends)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [s for s, _ in out], [e for _, e in out]


def _searched(df: DataFrame, block: list[tuple[str, str]], cut: bool) -> DataFrame:
    """Add what a block of windows finds to the columns n_words, starts, ends, items; cut: take hit spans out of the text."""
    schema = StructType([f for f in df.schema.fields if f.name in ("row", "text")])
    for name, kind in (("n_words", LongType()), ("starts", ArrayType(LongType())), ("ends", ArrayType(LongType())),
                       ("items", ArrayType(StringType()))):
        schema = schema.add(name, kind)
    shared = df.sparkSession.sparkContext.broadcast(block)  # at most about BLOCK_WINDOWS windows
    old = "items" in df.columns

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(shared.value)
        for batch in batches:
            texts = batch["text"].cast(pa.binary())
            for lo, hi in byte_slices(texts, SHARD_BYTES):
                part, raw = batch.slice(lo, hi - lo), texts.slice(lo, hi - lo).to_pylist()
                found = search_shard(raw, phrases)
                if old:
                    before = zip(*(part[c].to_pylist() for c in ("starts", "ends", "items")))
                    found = [(n, *merged(s + s0, e + e0), sorted({*i, *i0}))
                             for (n, s, e, i), (s0, e0, i0) in zip(found, before)]
                n, s, e, i = zip(*found) if found else ((), (), (), ())
                text = part["text"]
                if cut and any(s):
                    text = pa.array([remove_spans(*x) if x[1] else x[0] for x in zip(raw, s, e)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part["row"], text, pa.array(n, pa.int64()), pa.array(s, pa.list_(pa.int64())),
                     pa.array(e, pa.list_(pa.int64())), pa.array(i, pa.list_(pa.string()))], names=schema.names)

    return df.mapInArrow(search, schema)


def hits(docs: DataFrame, benchmark: DataFrame, columns: list[str], width: int = 10,
         block_windows: int = BLOCK_WINDOWS, cut: bool = False) -> DataFrame:
    """Search whole documents for item windows: row (a struct of columns), text, n_words, starts, ends, items.

    cut: the text comes back without the hit spans. starts and ends are merged hit spans in words, ascending. The benchmark is searched in blocks of about block_windows
    windows, each sent to all tasks; with more than one block, what is found so far is written between the blocks.
    Documents are neither shuffled nor joined, so copies, hot sources and repeated doc_ids need no care. A NULL or empty
    text has no words; without any item window nothing is hit.
    """
    windows = saved(item_windows(benchmark, width), "windows")
    n_blocks = max(1, -(-windows.count() // block_windows))
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text")
    for block in range(n_blocks):
        part = windows.filter(F.pmod(F.xxhash64("item", "window"), F.lit(n_blocks)) == block)
        found = _searched(found, [tuple(r) for r in part.collect()], cut and block + 1 == n_blocks)
        if block + 1 < n_blocks:
            found = saved(found, "searched")
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside any occurrence), n_items, items (sorted), contaminated."""
    found = hits(docs, benchmark, ["doc_id"], width, block_windows)
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        "items", (n_hit > 0).alias("contaminated"))


def remove_spans(text: bytes, starts: list[int], ends: list[int]) -> bytes:
    """A text without its hit words and what stands between words of one span."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORDS))]
    out, done = [], 0
    for s, e in zip(starts, ends):
        out.append(text[done:at[s][0]])
        done = at[e - 1][1]
    return b"".join([*out, text[done:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """All documents and columns, hit spans cut out of the text; n_chars, where there is one, follows the text."""
    found = hits(docs, benchmark, [c for c in docs.columns if c != "text"], width, block_windows, cut=True)
    own = {"text": F.col("text"), "n_chars": F.when(F.size("starts") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.select(*[own[c].alias(c) if c in own else F.col("row")[c].alias(c) for c in docs.columns])


#: The same figures from words numbered in DuckDB and an equality join on whole windows.
ORACLE = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
places AS (
  SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS (SELECT r, item, i, p.size FROM places p JOIN windows USING (size, win)),
per_item AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM found GROUP BY r),
per_word AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS k FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN per_item USING (r) LEFT JOIN per_word USING (r)
"""
