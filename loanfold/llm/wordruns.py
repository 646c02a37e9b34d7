"""Periodic runs of words: tiles per octave of periods, Z-values at boundaries, intervals stitched by document and period.

A run is a stretch of consecutive words with smallest period q, of at least LEAST and TIMES * q words, that no word beside it
extends. Octave 0 holds the periods 1 to 7, octave k from 1 on the periods from 8 * 2^(k-1) to below twice that.
"""

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import saved

LEAST, TIMES = 24, 3
#: Words between two boundaries in the lowest octaves.
BLOCK = 8
#: Words of the smallest tile, without its overlap.
TILE = 4096
SOLVE_AT_ONCE = 1 << 18

FACTOR = 0x9E3779B97F4A7C15  # odd, so that it has an inverse below 2^64
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def periods(octave: int) -> tuple[int, int]:
    """The first period of an octave, and the one after its last."""
    return (1, BLOCK) if octave == 0 else (BLOCK << (octave - 1), BLOCK << octave)


def spacing(octave: int) -> int:
    """Words between boundaries: any run of the octave holds a whole block that repeats one period on."""
    return max(BLOCK, periods(octave)[0])


def last_octave(n: int) -> int:
    """The last octave of which a document of n words may hold a run; -1: none."""
    if n < LEAST:
        return -1
    octave = 0
    while TIMES * periods(octave + 1)[0] <= n:
        octave += 1
    return octave


def tiles(n: int, tile_words: int = TILE) -> list[tuple[int, int, int, int]]:
    """Tiles of a document of n words: first octave, last octave, first word, end word.

    Tiles of an octave are sixteen times its boundaries' spacing long and overlap by a quarter of that; octaves whose tiles
    would be smaller share tiles of tile_words. A run that crosses from one tile to the next has the overlap to itself, which
    is enough for both to find their part, and more than a period, so that the parts can be put together.
    """
    out, octave, top = [], 0, last_octave(n)
    while octave <= top:
        to = octave
        while octave == 0 and to < top and 16 * spacing(to + 1) <= tile_words:
            to += 1
        core = max(tile_words, 16 * spacing(to))
        for start in range(0, max(1, n - core // 4), core):
            out.append((octave, to, start, min(n, start + core + core // 4)))
        octave = to + 1
    return out


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 2 * len(_powers[0]))
        _powers = tuple(np.cumprod(np.r_[np.uint64(1), np.full(n, f, np.uint64)], dtype=np.uint64)
                        for f in (FACTOR, pow(FACTOR, -1, 1 << 64)))
    return _powers


class Hashes:
    """Prefix hashes of words: equal stretches have equal hashes, unequal ones nearly never."""

    def __init__(self, words: np.ndarray):
        x = words.astype(np.uint64) + np.uint64(1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, FACTOR)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        self.up, self.down = power_tables(len(words) + 1)
        self.before = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(x * self.up[:len(x)], out=self.before[1:])

    def of_all(self, length: int, n: int) -> np.ndarray:
        """Hash of the stretch of that length from each of the first n words that have one."""
        return (self.before[length:n + 1] - self.before[:n + 1 - length]) * self.down[:n + 1 - length]

    def same(self, at: np.ndarray, period: np.ndarray, length: int) -> np.ndarray:
        """Whether the stretch of that length at each place equals the one a period on."""
        here = self.before[at + length] - self.before[at]
        return here * self.up[period] == self.before[at + period + length] - self.before[at + period]

    def match(self, at: np.ndarray, period: np.ndarray, below: int, step: int, lowest: int, end: int) -> np.ndarray:
        """How many words from each place match those a period on, fewer than below: the Z-values of the boundary.

        step 1: forwards from the place, -1: backwards from the word before it. Found by halving lengths.
        """
        found = np.zeros(len(at), np.int64)
        length = below >> 1
        while length:
            start = at + found if step > 0 else at - found - length
            inside = (start >= lowest) & (start + period + length <= end)
            ok = np.zeros(len(at), bool)
            ok[inside] = self.same(start[inside], period[inside], length)
            found[ok] += length
            length >>= 1
        return found


def exact(words: np.ndarray, start: int, end: int, period: int) -> list[tuple[int, int]]:
    """The stretches of [start, end) whose words a period apart are identical: the whole of it unless a hash was wrong."""
    same = words[start:end - period] == words[start + period:end]
    if same.all():
        return [(start, end)]
    edges = np.flatnonzero(np.diff(np.r_[False, same, False]))
    return [(start + int(a), start + int(b) + period) for a, b in zip(edges[::2], edges[1::2])]


def fragments(parts: list[tuple[np.ndarray, int, int, bool, bool]]) -> list[list[tuple[int, int, int]]]:
    """Periodic stretches of each tile as (period, start, end), places counted in the tile.

    parts: words as numbers, first and last octave, and whether the document goes on before and after. A stretch counts if it
    is long enough for a run, or if it touches an end where the document goes on. Of several periods of the same stretch
    only the smallest is given: the others are its multiples.

    All tiles are laid end to end with a word of its own between them, longest first, so that an octave works on a prefix. At
    each boundary the block that begins there is compared with those one period on, for all periods of the octave at
    once. Boundaries in a row that agree for one period are one stretch; Z-values of its first and last boundary, backwards
    and forwards, give its ends. Stretches are found by hashes and then compared word for word.
    """
    order = sorted(range(len(parts)), key=lambda i: -len(parts[i][0]))
    words = np.concatenate([x for i in order for x in (parts[i][0].astype(np.int64), [-2 - i])])
    lengths = np.array([len(parts[i][0]) for i in order])
    begins = np.cumsum(lengths + 1) - lengths - 1
    hashes = Hashes(words)
    found: list[dict[tuple[int, int], int]] = [{} for _ in parts]
    for octave in range(min(p[1] for p in parts), max(p[2] for p in parts) + 1):
        lo, hi = periods(octave)
        used = int((lengths >= max(LEAST, TIMES * lo)).sum())
        if not used:
            break
        n, size = int(begins[used - 1] + lengths[used - 1]), spacing(octave)
        starts = hashes.of_all(size, n)
        rows = -(-len(starts) // size)
        starts = np.pad(starts, (0, rows * size - len(starts))).reshape(rows, size)
        if octave == 0:
            row, column = np.nonzero(starts[:, lo:hi] == starts[:, :1])
        else:
            row, column = np.nonzero(starts[1:] == starts[:-1, :1])
        inside = row * size + lo + column + size <= n
        place = np.sort(column[inside] * (rows + 1) + row[inside])
        if not len(place):
            continue
        heads = np.flatnonzero(np.r_[True, np.diff(place) != 1])
        tails = np.r_[heads[1:], len(place)] - 1
        period = place[heads] // (rows + 1) + lo
        first = place[heads] % (rows + 1) * size
        after = (place[tails] % (rows + 1) + 1) * size
        start = first - hashes.match(first, period, size, -1, 0, n)
        end = after + hashes.match(after, period, size, 1, 0, n) + period
        by = np.lexsort((period, end, start))
        start, end, period = start[by], end[by], period[by]
        heads = np.flatnonzero(np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])])
        tails = np.r_[heads[1:], len(start)]
        tile = np.searchsorted(begins, start[heads], "right") - 1
        goes_on = np.array([p[3:] for p in parts])[np.array(order)[tile]]
        cut = goes_on[:, 0] & (start[heads] == begins[tile]) | goes_on[:, 1] & (end[heads] == begins[tile] + lengths[tile])
        wanted = np.flatnonzero(((end - start)[heads] >= np.maximum(LEAST, TIMES * period[heads])) | cut)
        for k in wanted.tolist():
            i, at = order[tile[k]], int(begins[tile[k]])
            if not parts[i][1] <= octave <= parts[i][2]:
                continue
            s, e = int(start[heads[k]]), int(end[heads[k]])
            for q in period[heads[k]:tails[k]].tolist():
                stretches = exact(words, s, e, q)
                for a, b in stretches:
                    found[i].setdefault((a - at, b - at), q)
                if stretches == [(s, e)]:  # else the hash was wrong for this period, not for the next
                    break
    return [[(q, s, e) for (s, e), q in f.items()] for f in found]


RUN = "start long, length long, period long"
PIECE = "period long, start long, end long"
READ = (f"key long, doc_id long, n_words long, text string, text_sha256 string, pieces array<struct<{PIECE}>>, "
        "tile struct<first: int, last: int, start: long, n_words: long, words: binary>")


def _read(docs: DataFrame, tile_words: int, keep_text: bool) -> DataFrame:
    """Documents with their words counted, and the tiles of those that have several; written once.

    A document that is one tile in every octave is solved where it is read. The words of a longer one become numbers, and its
    tiles rows of their own. A document in which nothing was found and no tile is open needs its text no more.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "doc_id", "n_words", "text", "text_sha256", "pieces", "tile"]
        struct = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int64()), ("n_words", pa.int64()),
                            ("words", pa.binary())])
        pieces = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pieces, struct]
        for batch in batches:
            rows: list[tuple] = []  # documents, in order
            waiting: list[tuple[int, np.ndarray, int]] = []
            held = 0

            def solved() -> pa.RecordBatch:
                found = fragments([(w, 0, top, False, False) for _, w, top in waiting]) if waiting else []
                for (i, _, _), pieces_of in zip(waiting, found):
                    key, doc_id, n, joined, _, _, _ = rows[i]
                    keep = pieces_of or keep_text
                    rows[i] = (key, doc_id, n, joined.decode() if keep else None,
                               None if pieces_of else hashlib.sha256(joined).hexdigest(), pieces_of, None)
                made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                waiting.clear()
                rows.clear()
                return made

            texts = batch["text"].cast(pa.binary())
            for key, doc_id, text in zip(batch["key"].to_pylist(), batch["doc_id"].to_pylist(), texts):
                listed = (text.as_py() or b"").split()  # bytes are split at ASCII white space only
                n, joined = len(listed), b" ".join(listed)
                top = last_octave(n)
                if top < 0:
                    rows.append((key, doc_id, n, joined.decode() if keep_text else None, hashlib.sha256(joined).hexdigest(), [], None))
                    continue
                seen: dict[bytes, int] = {}
                numbers = np.fromiter(map(seen.setdefault, listed, range(n)), np.int32, n)
                cut = tiles(n, tile_words)
                if all(start == 0 and end == n for _, _, start, end in cut):
                    waiting.append((len(rows), numbers, top))
                    rows.append((key, doc_id, n, joined, None, None, None))
                    held += n
                else:
                    rows.append((key, doc_id, n, joined.decode(), None, [], None))
                    for first, last, start, end in cut:
                        rows.append((key, None, None, None, None, None, {
                            "first": first, "last": last, "start": start, "n_words": n, "words": numbers[start:end].tobytes()}))
                        held += end - start
                        if held > SOLVE_AT_ONCE:
                            yield solved()
                            held = 0
                if held > SOLVE_AT_ONCE:
                    yield solved()
                    held = 0
            if rows:
                yield solved()

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return saved(keyed.mapInArrow(read, READ), "word-runs")


def _solved(tile_rows: DataFrame) -> DataFrame:
    """Pieces of each tile, places counted in the document."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, first, last, start, n, words in zip(*(c.to_pylist() for c in batch.columns)):
                numbers = np.frombuffer(words, np.int32)
                found = fragments([(numbers, first, last, start > 0, start + len(numbers) < n)])[0]
                if found:
                    period, a, b = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(found), pa.int64()), pa.array(period, pa.int64()),
                         pa.array(np.array(a, np.int64) + start), pa.array(np.array(b, np.int64) + start)],
                        names=["key", "period", "start", "end"])

    dealt = tile_rows.select("key", "tile.first", "tile.last", "tile.start", "tile.n_words", "tile.words")
    return dealt.repartition("key", "first", "start").mapInArrow(solve, f"key long, {PIECE}")


def stitched(pieces: DataFrame) -> DataFrame:
    """Runs of each document (key) from pieces found in its tiles: key, runs (by start, then period).

    Pieces of one document and period that share a period's words or more are parts of one run. A run that two periods share
    is that of the smaller one. Nothing is gathered but the pieces of one document and period, and the runs of one document.
    """
    by = Window.partitionBy("key", "period").orderBy("start", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") > reach - F.col("period"), F.lit(True))
    numbered = pieces.distinct().withColumn("begins", begins.cast("long"))
    numbered = numbered.withColumn("nth", F.sum("begins").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("key", "period", "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    long_enough = whole.filter(F.col("end") - F.col("start") >= F.greatest(F.lit(LEAST), F.col("period") * TIMES))
    smallest = long_enough.groupBy("key", "start", "end").agg(F.min("period").alias("period"))
    run = F.struct("start", (F.col("end") - F.col("start")).alias("length"), "period")
    ordered = F.sort_array(F.collect_list(F.struct("start", "period", run.alias("run"))))
    return smallest.groupBy("key").agg(ordered.alias("found")).select("key", F.transform("found", lambda x: x["run"]).alias("runs"))


def collapsed_words(listed: list[str], found: list[tuple[int, int, int]]) -> list[str]:
    """Words without those that a run (start, length, period) holds after its first period."""
    change = np.zeros(len(listed) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return list(compress(listed, np.cumsum(change[:-1]) == 0))


def periodic_runs(docs: DataFrame, keep_text: bool = False, tile_words: int = TILE) -> DataFrame:
    """Runs of each document: doc_id, n_words, runs (start, length, period; by start, then period), text_sha256, text.

    Words are the stretches between ASCII white space of the whole text. text is the collapsed text: the words left when each
    run keeps its first period only, one space between them; text_sha256 its digest. text is NULL unless keep_text is set, as
    most documents have no run and need not be written again.

    NULL, empty and blank texts have no words and no runs. Every row is read by itself: repeated and NULL doc_ids stay rows
    of their own. All other columns are ignored. An empty table gives no rows. tile_words changes the spread, never the result.
    """
    read = _read(docs, tile_words, keep_text)
    whole = read.filter("tile IS NULL")
    pieces = whole.select("key", F.inline("pieces")).unionByName(_solved(read.filter("tile IS NOT NULL")))
    runs = stitched(pieces)
    none = F.array().cast(f"array<struct<{RUN}>>")
    plain = whole.filter("text_sha256 IS NOT NULL").select("doc_id", "n_words", none.alias("runs"), "text_sha256", "text")
    changed = whole.filter("text_sha256 IS NULL").select("key", "doc_id", "n_words", "text").join(runs, "key", "left")
    changed = changed.select("doc_id", "n_words", F.coalesce("runs", none).alias("runs"), "text")

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, runs_of in zip(batch["text"].to_pylist(), batch["runs"].to_pylist()):
                texts.append(" ".join(collapsed_words(text.split(" "), [(r["start"], r["length"], r["period"]) for r in runs_of])))
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(digests, pa.string()), pa.array(texts if keep_text else [None] * len(texts), pa.string())],
                names=["doc_id", "n_words", "runs", "text_sha256", "text"])

    done = changed.mapInArrow(collapse, f"doc_id long, n_words long, runs array<struct<{RUN}>>, text_sha256 string, text string")
    return plain.unionByName(done)


def strongest(runs):
    """The run of the greatest exact length / period; of equal ones the first. NULL without runs."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def listing(runs):
    """Every run as start,length,period and a line end."""
    return F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n")))), "")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by the CRC-32 of its doc_id, is made periodic from some word on.

    With h the checksum of the decimal doc_id and g = floor(h / 10), documents with h % 10 = 0 and n > 0 words repeat the
    1 + floor((n - a) / (3 + g % 8)) words from word a = g % n up to their end. A NULL doc_id changes nothing.
    """

    @F.arrow_udf("string")
    def planted(sums: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for h, text in zip(sums.to_pylist(), texts.cast(pa.binary()).to_pylist()):
            listed = (text or b"").split()
            n, g = len(listed), (h or 0) // 10
            if n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                listed[a:] = (listed[a:a + p] * (-(-(n - a) // p)))[:n - a]
            out.append(b" ".join(listed).decode())
        return pa.array(out, pa.string())

    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & F.col("text").isNotNull()
    marked = docs.select("doc_id", "text", h.alias("h"), chosen.alias("chosen"))
    changed = planted(F.when(F.col("chosen"), F.col("h")), F.when(F.col("chosen"), F.col("text")))
    return marked.select("doc_id", F.when(F.col("chosen"), changed).otherwise(F.col("text")).alias("text"))
