import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loanfold.llm import queries, spelling
from tests.llm.helpers import documents, rows_of

UPPER = {i: i + 32 for i in range(65, 91)}


def plain_counts(rows, planted):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if planted and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], counts[form[w]] if form[w] else None, root))
    return sorted(out, key=repr)


def texts(seed=3):
    """Many words of few letters, so that edits meet, with frequencies from 1 to thousands."""
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        words = []
        for _ in range(60):
            w = "".join(rng.choices("aabé", k=rng.choice((7, 7, 8, 9, 12))))
            words += [w] * rng.choice((1, 1, 2, 20, 250))
        rng.shuffle(words)
        rows.append((i, rng.choice((" ", ", ", "1")).join(words)))
    rows += [(100, "Received " * 2000 + "recieved " * 3 + "receved receivedÀ " * 2), (101, "Àà×÷abcd " * 3 + "Àà×÷abceĀ " * 2),
             (102, None), (102, ""), (None, "nobodys nobodys nobodyx " * 2), (103, "ab" * 100_000 + " " + "ab" * 100_000 + " " + ("ab" * 100_000 + "x ") * 2),
             (104, "aaaaaaaa " * 3 + "aaaaaaaaa " * 40 + "aaaaaaa " * 500)]
    return rows


def named(df):
    return sorted((tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()), key=repr)


@pytest.mark.parametrize("extra", [False, True])
def test_as_by_brute_force(spark, extra):
    rows = texts()
    found = named(queries.variants_of(documents(spark, rows, extra)))
    assert found == plain_variants(plain_counts(rows, True))
    assert len({r[3] for r in found}) > 5 and any(r[5] not in (r[0], r[3]) for r in found)


def test_without_planted_deletions(spark):
    rows = texts(8)
    words = spelling.word_counts(documents(spark, rows))
    assert {r.word: r.n for r in words.collect()} == plain_counts(rows, False)
    assert named(spelling.variants(words)) == plain_variants(plain_counts(rows, False))


def test_each_pair_once(spark):
    rng = random.Random(4)
    words = {"".join(rng.choices("ab", k=rng.randrange(7, 20))) for _ in range(700)} | {"a" * k for k in range(7, 30)}
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    found = rows_of(spelling.near_pairs(frame).select(F.least("a", "b"), F.greatest("a", "b")))
    ordered = sorted(words)
    assert found == sorted(((a, b) for i, a in enumerate(ordered) for b in ordered[i + 1:] if one_edit(a, b)), key=repr)


def test_long_chain_of_forms(spark):
    """Each word is ten times as frequent as the one before it: the root is at the far end."""
    chain = [("abcdefgh" + "z" * k, 2 * 10 ** k) for k in range(17)]
    found = {r.word: r for r in spelling.variants(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert {r.root for r in found.values()} == {chain[-1][0]} and found[chain[-1][0]].form is None
    assert all(found[w].form == chain[k + 1][0] and found[w].form_n == chain[k + 1][1] for k, (w, _) in enumerate(chain[:-1]))


def test_equal_frequencies_and_empty_table(spark):
    words = [("variantb", 100), ("varianta", 100), ("variantc", 10), ("other", 5)]
    found = {r.word: r.form for r in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert found == {"varianta": None, "variantb": None, "variantc": "varianta", "other": None}
    assert queries.variants_of(documents(spark, [(1, "a")]).filter("false")).collect() == []
