import math
import random
import zlib

import numpy as np
import pytest

from loanfold.llm import quality
from tests.llm.helpers import documents

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = ["the", "river", "ran", "over", "old", "stones", "and", "trees", "grew", "there"]
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = " ".join(rng.choices(words, k=rng.randrange(20, 80))) + "."
        rows.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_fold_and_accuracy(spark):
    rows, labels = corpus(400)
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    flipped = [(i, 1 - y if i in held else y, 0) for i, y, _ in labels]  # labels of the fold must not matter
    docs = documents(spark, rows, extra=True)
    found = {r.doc_id: r for r in quality.quality(docs, spark.createDataFrame(labels, LABELS)).collect()}
    again = {r.doc_id: r for r in quality.quality(docs, spark.createDataFrame(flipped, LABELS)).collect()}
    assert {i for i, r in found.items() if r.held_out} == held
    assert found == again
    truth = {i: y for i, y, _ in labels}
    assert np.mean([found[i].predicted == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())


def test_no_label_but_one(spark):
    rows, labels = corpus(300)
    found = quality.quality(documents(spark, rows), spark.createDataFrame([x for x in labels if x[1]], LABELS)).collect()
    truth = {i: y for i, y, _ in labels}
    by = {y: np.mean([r.score for r in found if truth[r.doc_id] == y]) for y in (0, 1)}
    assert by[0] < by[1]


@pytest.mark.parametrize("labels", [[], [(1, None, None)], [(None, 1, 1)], [(1, 0, 0), (1, 1, 0)]])
def test_odd_rows(spark, labels):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "x" * 300_000), (2, "x"), (3, "\n\n \n")]
    found = quality.quality(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [True]


def test_empty_table(spark):
    docs = documents(spark, []).filter("false")
    assert quality.quality(docs, spark.createDataFrame([(1, 1, 0)], LABELS)).collect() == []


def test_features_do_not_depend_on_the_piece_size(monkeypatch):
    text = "Ab, c! 12\nÄ ".encode() * 50
    whole = quality.features(text)
    monkeypatch.setattr(quality, "COUNT_AT_ONCE", 37)
    assert np.allclose(whole, quality.features(text))


def test_one_doc_id_with_many_rows_takes_its_share_of_a_bounded_sample(spark, monkeypatch):
    rows, labels = corpus(300)
    ids = [i for i, y, _ in labels if y and zlib.crc32(str(i).encode()) % 5]
    # One doc_id that is learnt from holds a third of the rows, half of them equal; another one's rows are all equal.
    rows += [(ids[0], "MUCH JUNK" + "!" * k) for k in range(100)] + [(ids[0], "MUCH JUNK")] * 100 + [(ids[1], rows[ids[1]][1])] * 100
    for i in ids[:6]:
        rows += [(i, rows[i][1])] * 30
    seen = []
    plain = quality.fit
    monkeypatch.setattr(quality, "fit", lambda p, u, *more: (seen.append((p, u)), plain(p, u, *more))[1])
    quality.learn(documents(spark, rows), spark.createDataFrame(labels, LABELS), sample=60)
    (half, same), (positive, unlabelled) = seen  # the fit for the prior, and the last one
    assert np.array_equal(half, positive[::2]) and np.array_equal(same, unlabelled)
    assert len(positive) == len(unlabelled) == 60
    assert len(np.unique(unlabelled, axis=0)) >= 55
    quality.learn(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    distinct = {r for r in rows if zlib.crc32(str(r[0]).encode()) % 5}
    good = {i for i, y, _ in labels if y}
    assert [len(x) for x in seen[3]] == [sum(i in good for i, _ in distinct), len(distinct)]


def plain_risk(positive, unlabelled, prior):
    loss = lambda z: math.log1p(math.exp(-z))
    first = prior * sum(loss(z) for z in positive) / len(positive)
    second = sum(loss(-z) for z in unlabelled) / len(unlabelled) - prior * sum(loss(-z) for z in positive) / len(positive)
    return first, second


@pytest.mark.parametrize("prior,shift", [(0.3, 0.0), (0.8, 1.0), (0.9, -3.0)])
def test_slope_of_the_risk_by_differences(prior, shift):
    rng = np.random.default_rng(3)
    positive, unlabelled = rng.normal(1, 1, 7), rng.normal(shift, 1, 5)
    slope = quality.risk_slope(positive, unlabelled, prior)
    first, second = plain_risk(positive, unlabelled, prior)
    for k in range(12):
        moved = np.concatenate([positive, unlabelled])
        moved[k] += 1e-6
        a, b = plain_risk(moved[:7], moved[7:], prior)
        # Above zero the slope of the whole risk, below it that of the second part turned round.
        expected = (a - first + b - second if second >= 0 else second - b) / 1e-6
        assert slope[k] == pytest.approx(expected, abs=1e-5)


def test_statistics_prior_and_scores_by_brute_force(spark, monkeypatch):
    rows, labels = corpus(500, seed=5)
    rows += [(600, None), (601, ""), (None, "not learnt from"), (602, "x" * 70_000), (603, rows[3][1]), (3, rows[3][1])]
    labels += [(600, 1, 0), (602, 1, 0), (602, 0, 0)]
    fitted = []
    plain = quality.fit
    monkeypatch.setattr(quality, "fit", lambda *given: (fitted.append((given, plain(*given))), fitted[-1][1])[1])
    model = quality.learn(documents(spark, rows, extra=True), spark.createDataFrame(labels, LABELS), sample=70)
    learnt = [t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 5]
    table = np.array([quality.features((t or "").encode()) for t in learnt])
    assert np.allclose(model.mean, table.mean(axis=0), atol=1e-4)
    assert np.allclose(model.scale, table.std(axis=0) + 1e-3, atol=1e-3)

    def score(model, x):
        w, b, v, c = model.weights
        x = [min(5.0, max(-5.0, (f - m) / s)) for f, m, s in zip(x, model.mean, model.scale)]
        hidden = [math.tanh(sum(f * r for f, r in zip(x, w[:, h])) + b[h]) for h in range(len(b))]
        return 1 / (1 + math.exp(-(sum(h * r for h, r in zip(hidden, v)) + c[0])))

    (_, first), (given, last) = fitted
    positives = sorted(score(first, x) for x in given[0][1::2])
    ratios = []
    for level in np.quantile(positives, quality.LEVELS):
        share = max(1, sum(p >= level - 1e-12 for p in positives)) / len(positives)
        above = sum(score(first, x) >= level - 1e-12 for x in table) / len(table)
        width = math.sqrt(math.log(40) / 2) * (len(table) ** -0.5 + len(positives) ** -0.5) / share
        ratios.append((above / share + width, above / share))
    assert last.prior == pytest.approx(min(0.99, min(ratios)[1]), abs=3 / len(table))
    good = sum(y for i, y, _ in labels[:500]) / 500
    assert abs(last.prior - good) < 0.15
    docs = documents(spark, rows)
    found = docs.select("text", quality.score_column(docs.text, model).alias("score")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.score == pytest.approx(score(model, quality.features((r.text or "").encode())), abs=1e-9)


def test_sums_do_not_depend_on_partitions(spark):
    rows, _ = corpus(200)
    one, many = (quality.spread(documents(spark, rows).repartition(k)) for k in (1, 9))
    assert one[0] == many[0] == 200
    assert np.array_equal(one[1], many[1]) and np.array_equal(one[2], many[2])
    assert quality.spread(documents(spark, []).filter("false"))[0] == 0
