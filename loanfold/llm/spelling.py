"""Spelling variants: words one edit apart, joined by chunks of one word and positional grams of the other."""

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.skew import join_to_unique
from .common import saved

#: A-Z to a-z, all other bytes as they are.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Code points of the shortest word, occurrences of the rarest one, times that a form is more frequent than its variant.
LENGTH, OCCURRENCES, TIMES = 7, 2, 10
#: Pieces of a word, of which one edit leaves all but one as they are. The halves are the two disjoint chunks.
PIECES = 8
WORDS_AT_ONCE = 1 << 18
#: Code points up to which the built-in edit distance is used; its time grows with the square of the length.
SHORT = 256

ORACLE = r"""
    WITH RECURSIVE
    steps AS (SELECT i AS byte, i::BIGINT AS value, 0 AS step FROM range(256) r(i)
        UNION ALL SELECT byte, CASE WHEN value % 2 = 1 THEN xor(value // 2, 3988292384) ELSE value // 2 END, step + 1 FROM steps WHERE step < 8),
    crc AS (SELECT list(value ORDER BY byte) AS t FROM steps WHERE step = 8),
    runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
    lowered AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs),
    counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS digits
        FROM lowered WHERE length(run) >= 7 GROUP BY doc_id, run),
    summed AS (SELECT run, n, xor(list_reduce(list_transform(range(1, length(digits) // 2 + 1), lambda i: ('0x' || substr(digits, (2 * i - 1)::BIGINT, 2))::BIGINT),
        lambda acc, byte: xor(acc // 256, t[(xor(acc, byte) % 256 + 1)::BIGINT]), 4294967295::BIGINT), 4294967295) AS h FROM counted, crc),
    words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
        FROM summed GROUP BY 1 HAVING sum(n) >= 2 AND length(word) >= 7),
    cut AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
    near AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
        UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM words)
        UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM words)),
    ranked AS (SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS nth FROM near JOIN words ON words.word = other),
    formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN other END AS form,
        CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND nth = 1),
    walk AS (SELECT word, word AS reached FROM formed UNION ALL SELECT walk.word, form FROM walk JOIN formed ON formed.word = reached WHERE form IS NOT NULL)
    SELECT formed.word, n, n_near, form, form_n, reached AS root FROM formed JOIN walk ON walk.word = formed.word
    WHERE reached IN (SELECT word FROM formed WHERE form IS NULL)"""


def with_planted_deletions(doc_id: int | None, run: str) -> str:
    """The run without one code point where 31 divides the CRC-32 of doc_id:run; a NULL doc_id is empty text."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, change: Callable[[int | None, str], str] | None = None) -> DataFrame:
    """Words of whole texts with their occurrences: word, n.

    Words are the maximal runs of a-z, A-Z and U+00C0 to U+00FF, A-Z in lower case, of LENGTH code points or more and with
    OCCURRENCES or more in all texts. change: what a run of a document is written as before it counts; it may shorten it.
    A task adds up what it has read and sends on sums.
    """
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % LENGTH)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary())):
                found = pattern.findall((text.as_py() or b"").translate(LOWER).decode())
                if change is None:
                    total.update(found)
                else:
                    for run, n in Counter(found).items():
                        word = change(doc_id, run)
                        if len(word) >= LENGTH:
                            total[word] += n
                if len(total) >= WORDS_AT_ONCE:
                    yield out()
        if total:
            yield out()

    sums = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return sums.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= OCCURRENCES)


def _keyed(words: DataFrame, longer: bool) -> DataFrame:
    """Each word once per piece, with a key of all that lies outside the piece.

    longer: the word as one that has a code point more than the word it meets: its piece is one longer, and what follows the piece
    is met shifted by one.
    """
    size = F.length("word") - (1 if longer else 0)
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda k: F.struct(
        F.floor(k * size / PIECES).cast("int").alias("start"),
        F.floor((k + 1) * size / PIECES).cast("int").alias("end")))
    each = words.filter(size >= LENGTH).select("word", "n", size.alias("size"), F.explode(pieces).alias("at"))
    each = each.filter("at.start < at.end").select("word", "n", "size", "at.start", "at.end")
    before = F.substring("word", F.lit(1), F.col("start"))
    after = F.substring("word", F.col("end") + (2 if longer else 1), F.length("word"))
    return each.select("word", "n", "start", "end", F.xxhash64("size", "start", before, after).alias("key"))


def one_edit(a, b):
    """Whether b is a with exactly one code point replaced or inserted. Linear in the length."""
    differs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: ~x.eqNullSafe(y))
    at, length = F.array_position(differs, True).cast("int"), F.length(b)
    rest = F.substring(a, at + F.length(a) - F.length(b) + 1, length) == F.substring(b, at + 1, length)
    return F.when(length <= SHORT, F.levenshtein(a, b, 1) == 1).otherwise((at > 0) & rest)


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs of words of which one becomes the other by exactly one inserted, deleted or replaced code point: a, n_a, b, n_b.

    The shorter word (of equal ones each) is cut into two disjoint chunks. One edit leaves one of them whole, and it stands in
    the longer word at the same place or one on; so the longer word gives its grams of a chunk's length at the places within one of
    a chunk's, all others can meet no chunk. A chunk alone would be shared by too many words. The edit lies in the other half,
    and the same holds for the halves of that half, and once more for theirs: a key is the chunk and the parts of the other half
    that stay, and leaves out an eighth of the word. Keys are hashes; words that share one are compared in whole.

    Each pair comes once: replaced code points lie in one piece, and an insertion between two pieces is left to the first.
    """
    short, long = _keyed(words, False), _keyed(words, True)
    shared = (F.col("x.key") == F.col("y.key")) & (F.col("x.start") == F.col("y.start"))
    start, end, length = F.col("x.start"), F.col("x.end"), F.length("y.word")

    def compared(pairs: DataFrame, shift: int) -> DataFrame:
        before = F.substring("x.word", F.lit(1), start) == F.substring("y.word", F.lit(1), start)
        after = F.substring("x.word", end + 1, length) == F.substring("y.word", end + 1 + shift, length)
        edited = one_edit(F.substring("x.word", start + 1, end - start), F.substring("y.word", start + 1, end - start + shift))
        return pairs.filter(before & after & edited).select(
            F.col("x.word").alias("a"), F.col("x.n").alias("n_a"), F.col("y.word").alias("b"), F.col("y.n").alias("n_b"))

    same = short.alias("x").join(short.alias("y"), shared & (F.col("x.word") < F.col("y.word")))
    plus = short.alias("x").join(long.alias("y"), shared)
    earlier = (start > 0) & (F.substring("x.word", start + 1, length) == F.substring("y.word", start + 2, length))
    return compared(same, 0).unionByName(compared(plus.filter(~earlier), 1))


def variants(words: DataFrame) -> DataFrame:
    """Words with the forms they are variants of: word, n, n_near, form, form_n, root.

    words: word, n, each word once. n_near counts the words one edit away. form is the most frequent of them, of equal ones the
    first by code points, if it is at least TIMES as frequent as the word; else NULL, and form_n with it. root is where forms
    lead to, the word itself if it has none. Other columns are ignored. An empty table gives no rows.
    """
    words = saved(words.select("word", F.col("n").cast("long").alias("n")), "words")
    pairs = saved(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("less"), "other"))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    more = -F.col("best.less") >= TIMES * F.col("n")
    formed = saved(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(more, F.col("best.other")).alias("form"),
        F.when(more, -F.col("best.less")).alias("form_n")), "word-forms")
    ends = _ends(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def _ends(links: DataFrame) -> DataFrame:
    """Where each word's links lead to in the end. Each round goes twice as far; n grows tenfold per link, so there are few."""
    while True:
        links = saved(links, "word-roots")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if links.join(further, "root", "left_semi").isEmpty():
            return links
        links = join_to_unique(links, further, "root").select("word", F.coalesce("beyond", "root").alias("root"))
