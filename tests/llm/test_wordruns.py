import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanfold.llm import queries, wordruns
from tests.llm.helpers import documents


def plain_runs(words):
    """Every maximal stretch of every period, longest enough, of its smallest period."""
    n, best = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in best.items())


def split(text):
    for c in "\t\n\x0b\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_row(doc_id, text):
    """The contract's columns, by the letter."""
    words = split(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = None
    for s, length, q in runs:
        if top is None or length * top[2] > top[1] * q:
            top = (s, length, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def texts(seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(150):
        words = [rng.choice("abcdefgh") if k % 3 else f"w{rng.randrange(3000)}" for _ in range(rng.choice((0, 5, 24, 80, 300, 900)))]
        for _ in range(rng.randrange(4)):  # periodic stretches, some overlapping, some with one word changed
            p, times, at = rng.choice((1, 2, 3, 5, 7, 8, 9, 16, 31, 64, 90)), rng.choice((2, 3, 4, 9)), rng.randrange(len(words) + 1)
            words[at:at] = [f"w{rng.randrange(3000)}" for _ in range(p)] * times + words[at:at + rng.randrange(3)]
            if rng.random() < 0.3:
                words[rng.randrange(len(words))] = "changed"
        out.append(rng.choice((" ", "\t", "  \n")).join(words))
    fib = ["a", "ab"]
    while len(fib[-1]) < 1200:
        fib.append(fib[-1] + fib[-2])
    out += [" ".join(fib[-1]), "x " * 2000, "\xa0x y  " * 40, " ".join(bin(i).count("1") % 2 * "t" or "s" for i in range(2048)),
            "a b " * 300 + "a " * 300 + "b c d " * 90]
    return out


@pytest.mark.parametrize("tile_words", [128, 4096])
def test_pieces_make_the_runs(spark, tile_words):
    """Tiles of any size, put together, hold the runs that a plain search finds."""
    rows = list(enumerate(texts()))
    found = wordruns.periodic_runs(documents(spark, rows), keep_text=True, tile_words=tile_words).collect()
    assert len(found) == len(rows)
    for r in found:
        words = split(rows[r.doc_id][1])
        runs = plain_runs(words)
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        assert r.text == " ".join(w for i, w in enumerate(words) if i not in gone)
        assert r.text_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def contract(df):
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("extra", [False, True])
def test_query_as_by_brute_force(spark, extra):
    rows = list(enumerate(texts(2) * 2)) + [(None, "a b " * 30), (7, None), (7, None), (8, ""), (9, " \n"), (None, None), (11, "q " * 24), (11, "q " * 23)]
    found = contract(queries.runs_of(documents(spark, rows, extra)))
    assert found == sorted((plain_row(*r) for r in rows), key=repr)


def test_given_documents_as_by_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len((r.text or "").split()) < 1500]
    found = contract(queries.op11_wordruns(spark, "/root/testdata/sf0.001").join(
        spark.createDataFrame([(r.doc_id,) for r in short], "doc_id long"), "doc_id"))
    assert len(found) == len(short) and found == sorted((plain_row(*r) for r in short), key=repr)


def test_long_text(spark):
    rng = random.Random(4)
    body = [f"w{rng.randrange(10**6)}" for _ in range(100_000)]
    words = body * 3 + ["z"] * 30_000 + body[:50_000]
    row = wordruns.periodic_runs(documents(spark, [(1, " ".join(words))])).first()
    assert [tuple(r) for r in row.runs] == [(0, 300_000, 100_000), (300_000, 30_000, 1)]


def test_long_text_goes_to_several_tasks(spark):
    rng = random.Random(5)
    docs = documents(spark, [(1, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60_000)))])
    tiles = wordruns._read(docs, 1024, False).filter("tile IS NOT NULL")
    sizes = tiles.select(F.length("tile.words").alias("n"), "tile.last").collect()
    assert len(sizes) > 60 and max(r.n for r in sizes if r.last == 4) <= 4 * 1280


def test_wrong_hashes_do_no_harm(monkeypatch):
    """With hashes that take everything for equal, the words still decide."""
    rng = np.random.default_rng(1)
    words = np.r_[rng.integers(0, 50, 60), np.tile(rng.integers(0, 50, 9), 5), rng.integers(0, 50, 60)]
    right = wordruns.fragments([(words, 0, wordruns.last_octave(len(words)), False, False)])[0]
    monkeypatch.setattr(wordruns.Hashes, "of_all", lambda self, length, n: np.zeros(n + 1 - length, np.uint64))
    monkeypatch.setattr(wordruns.Hashes, "same", lambda self, at, period, length: np.ones(len(at), bool))
    found = wordruns.fragments([(words, 0, wordruns.last_octave(len(words)), False, False)])[0]
    assert set(right) <= set(found) and len(right) == 1


def test_empty_table(spark):
    assert wordruns.periodic_runs(documents(spark, [(1, "a")]).filter("false")).collect() == []
