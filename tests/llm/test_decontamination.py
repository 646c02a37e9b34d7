import random
import re

import numpy as np
import pytest

from loanfold.llm import decontamination as dc
from loanfold.llm.fmindex import FMIndex
from tests.llm.helpers import documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, note string"


def words(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [(m[0], m.span()) for m in WORD.finditer(lower)]


def plain(rows, items, width=10):
    windows = {}
    for item, text in items:
        w = [x for x, _ in words(text)]
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        w = [x for x, _ in words(text)]
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in df.collect()), key=repr)


def fixture():
    rng = random.Random(11)
    vocabulary = ["one", "Two", "three3", "vier", "fünf", "ßix", "7", "eight"]
    long_items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(10, 25)))) for i in range(12)]
    items = long_items + [(20, "short ITEM"), (21, "short, item!"), (22, ""), (23, None), (None, "nameless thing here"), (20, "short ITEM")]
    rows = []
    for i in range(60):
        parts = rng.choices(vocabulary + ["other", "word"], k=rng.randrange(0, 60))
        if i % 3 == 0:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(long_items)[1].upper().replace(" ", "-\n"))
        if i % 7 == 0:
            parts += ["Short", "item", "short", "item"]
        rows.append((i, ", ".join(parts)))
    rows += [(60, None), (61, ""), (62, "..."), (None, "a nameless  thing here"), (3, rows[3][1]), (63, long_items[0][1] + " " + long_items[0][1]),
             (64, "x " * 50_000 + long_items[1][1])]
    return rows, items


@pytest.mark.parametrize("block,shard", [(200_000, 8 << 20), (40, 300)])
def test_as_by_brute_force(spark, monkeypatch, block, shard):
    monkeypatch.setattr(dc, "SHARD_BYTES", shard)
    rows, items = fixture()
    benchmark = spark.createDataFrame([(*x, "n") for x in items], ITEMS)
    found = dc.contamination(documents(spark, rows, extra=True), benchmark, block_windows=block)
    assert result(found) == plain(rows, items)


@pytest.mark.parametrize("block", [200_000, 40])
def test_spans_are_cut_and_other_rows_stay(spark, block):
    rows, items = fixture()
    docs = documents(spark, rows, extra=True)
    clean = dc.decontaminated(docs, spark.createDataFrame([(*x, "n") for x in items], ITEMS), block_windows=block)
    assert clean.columns == docs.columns
    kept = clean.collect()
    hit = {(r[0], r[1]) for r in plain(rows, items) if r[5]}
    before = {(i, len(words(t))): t for i, t in rows if (i, len(words(t))) not in hit}
    texts = [(r.doc_id, r.text) for r in kept]
    assert len(kept) == len(rows) and all((i, t) in texts for (i, _), t in before.items())
    assert all(r.n_chars == len(r.text or "") for r in kept)
    alone = dc.remove_spans(b"Ab, one. Two; three ... z", [1], [4])
    assert alone == b"Ab,  ... z"


@pytest.mark.parametrize("items", [[], [(1, None), (2, " .")]])
def test_nothing_to_look_for(spark, items):
    benchmark = spark.createDataFrame([(*x, "n") for x in items], ITEMS)
    assert result(dc.contamination(documents(spark, [(1, "a b c"), (2, None)]), benchmark)) == [
        (1, 3, 0, 0, "", False), (2, 0, 0, 0, "", False)]
    assert dc.contamination(documents(spark, []).filter("false"), benchmark).collect() == []


def test_index_finds_all_places():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 5, 400)
    phrases = rng.integers(1, 6, (60, 3))
    index = FMIndex(text, 6)
    which, low, high = index.search(phrases)
    found = {int(w): sorted(index.places(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high)}
    every = {k: [i for i in range(398) if (text[i:i + 3] == p).all()] for k, p in enumerate(phrases)}
    assert found == {k: v for k, v in every.items() if v}
