"""Text quality from trusted positives and unlabelled text: non-negative unbiased risk (positive-unlabelled learning)."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.skew import join_to_unique
from .common import saved

#: Byte classes: each punctuation mark is a class of its own, as junk shows in marks and in letter case.
LETTER_LOW, LETTER_UP, DIGIT, SPACE, LINE, WIDE, OTHER = range(7)
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASSES = 7 + len(MARKS)
COUNT_AT_ONCE = 1 << 22


def _byte_classes() -> np.ndarray:
    kind = np.full(256, OTHER, np.uint16)
    kind[ord("a"):ord("z") + 1], kind[ord("A"):ord("Z") + 1], kind[ord("0"):ord("9") + 1] = LETTER_LOW, LETTER_UP, DIGIT
    kind[[9, 32]], kind[[10, 11, 12, 13]], kind[128:] = SPACE, LINE, WIDE
    kind[list(MARKS)] = 7 + np.arange(len(MARKS))
    return kind


KIND = _byte_classes()


def features(text: bytes | None) -> np.ndarray:
    """Figures of a whole text: byte classes, their neighbours, word lengths, repeated words and lines. Empty: zeros."""
    raw = np.frombuffer(text or b"", np.uint8)
    pairs = np.zeros(CLASSES * CLASSES)
    for at in range(0, len(raw), COUNT_AT_ONCE):
        kinds = KIND[raw[at:at + COUNT_AT_ONCE + 1]]
        pairs += np.bincount(kinds[:-1] * np.uint16(CLASSES) + kinds[1:], minlength=CLASSES * CLASSES)
    pairs = pairs.reshape(CLASSES, CLASSES)
    shares = pairs.sum(axis=1) / max(1.0, pairs.sum())
    # Of each class, how often it follows itself, a small letter, a capital or a space: doubled marks, capitals in a row.
    after = pairs[[LETTER_LOW, LETTER_UP, SPACE]].T / max(1.0, pairs.sum())
    words = (text or b"").split()
    n = len(words)
    distinct = len(set(words))
    again = sum(map(bytes.__eq__, words, words[1:])) if n > 1 else 0
    lines = [x for x in (text or b"").split(b"\n") if x.strip()]
    long_words = sum(len(w) > 24 for w in words)
    figures = [np.log1p(n), len(raw) / max(1, n), distinct / max(1, n), again / max(1, n), long_words / max(1, n),
               np.log1p(len(lines)), np.log1p(n / max(1, len(lines))), len(set(lines)) / max(1, len(lines)), float(n == 0)]
    return np.concatenate([np.sqrt(shares), np.sqrt(np.diag(pairs) / max(1.0, pairs.sum())), np.sqrt(after.ravel()), figures])


WIDTH = len(features(b""))


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    """Scaling of the features and a network with one hidden layer. Without weights all texts score the prior."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: list[np.ndarray] | None = None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -5, 5)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        w, b, v, c = self.weights
        return _sigmoid(np.tanh(self.scaled(x) @ w + b) @ v + c)


def risk_slope(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Slope of the risk by the outputs of positives and unlabelled rows, a batch of each, with the logistic loss.

    The risk is prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)). Where the second part is negative, the slope
    is that of the part itself turned round, so that a step goes up it and the network does not learn the positives by heart.
    """
    negative = np.logaddexp(0, unlabelled).mean() - prior * np.logaddexp(0, positive).mean()
    down = np.concatenate([-prior * _sigmoid(positive) / len(positive), _sigmoid(unlabelled) / len(unlabelled)])
    if negative < 0:
        return -down
    return down + np.concatenate([-prior * _sigmoid(-positive) / len(positive), np.zeros(len(unlabelled))])


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, mean: np.ndarray, scale: np.ndarray, hidden: int = 16,
        epochs: int = 40, batch: int = 512, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Model:
    """Minimise the non-negative risk (see risk_slope) over batches of positives and unlabelled rows."""
    if not len(positive) or not len(unlabelled):
        return Model(prior)
    rng = np.random.default_rng(seed)
    model = Model(prior, mean, scale)
    p, u = model.scaled(positive), model.scaled(unlabelled)
    params = [rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    first, second = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    step = 0
    for _ in range(epochs):
        for _ in range(max(1, len(u) // batch)):
            step += 1
            x = np.concatenate([p[rng.integers(0, len(p), batch)], u[rng.integers(0, len(u), batch)]])
            inner = np.tanh(x @ params[0] + params[1])
            g = inner @ params[2] + params[3]
            slope = risk_slope(g[:batch], g[batch:], prior)
            back = np.outer(slope, params[2]) * (1 - inner ** 2)
            grads = [x.T @ back, back.sum(axis=0), inner.T @ slope, np.array([slope.sum()])]
            for k, grad in enumerate(grads):
                grad = grad + decay * params[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad ** 2
                params[k] = params[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    model.weights = params
    return model


#: Figures are summed as whole numbers of this unit, in two limbs, so that sums do not depend on the order of rows.
UNIT, LIMB = 1 << 16, 1 << 24


def spread(texts: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, and mean and standard deviation of each figure over all rows of a frame with a text column."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = np.rint(np.array([features(t) for t in batch["text"].cast(pa.binary()).to_pylist()]) * UNIT).astype(np.int64)
            high, low = q // LIMB, q % LIMB
            sums = [np.full(WIDTH, len(q)), *(x.sum(axis=0) for x in (high, low, high * high, high * low, low * low))]
            yield pa.RecordBatch.from_arrays([pa.array(range(WIDTH), pa.int32()), *(pa.array(x, pa.int64()) for x in sums)],
                                             names=["figure", *SUMS])

    parts = texts.select("text").mapInArrow(partial, "figure int, " + ", ".join(f"{c} long" for c in SUMS))
    totals = parts.groupBy("figure").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in SUMS])
    rows = totals.orderBy("figure").collect()  # a row per figure
    if not rows:
        return 0, np.zeros(WIDTH), np.ones(WIDTH)
    n = int(rows[0].n)
    total = [int(r.high) * LIMB + int(r.low) for r in rows]
    square = [(int(r.high2) * LIMB + 2 * int(r.both)) * LIMB + int(r.low2) for r in rows]
    mean = np.array([t / (n * UNIT) for t in total])
    variance = np.array([(n * s - t * t) / (n * UNIT) ** 2 for s, t in zip(square, total)])
    return n, mean, np.sqrt(variance)


SUMS = "n", "high", "low", "high2", "both", "low2"
LEVELS = np.linspace(0.05, 0.95, 19)


def shares_above(texts: DataFrame, model: Model, levels: np.ndarray, n: int) -> np.ndarray:
    """Of all n rows of a frame with a text column, the share whose score reaches each level."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in batch["text"].cast(pa.binary()).to_pylist()]
            score = model.score(np.array(rows).reshape(-1, WIDTH))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(levels)), pa.int32()), pa.array([int((score >= t).sum()) for t in levels], pa.int64())],
                names=["level", "n"])

    counts = texts.select("text").mapInArrow(partial, "level int, n long").groupBy("level").agg(F.sum("n").alias("n"))
    found = {r.level: r.n for r in counts.collect()}  # a row per level
    return np.array([found.get(k, 0) for k in range(len(levels))]) / max(1, n)


def smallest_ratio(positive: np.ndarray, unlabelled: np.ndarray, m: int, n: int) -> float:
    """Class prior: ratio of the shares of n unlabelled and m positive rows that reach a level, where it is surely smallest.

    The level is that of the smallest ratio plus its confidence width (95 %), which grows where few positives are left.
    """
    positive = np.maximum(1 / m, positive)
    width = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(n) + 1 / np.sqrt(m)) / positive
    ratio = unlabelled / positive
    return float(np.clip(ratio[np.argmin(ratio + width)], 0.01, 0.99))


def is_held_out(doc_id, folds: int = 5):
    """True for the fold whose labels are never learnt from; a row without doc_id belongs to it."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == 0, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, sample: int = 8000, folds: int = 5) -> Model:
    """Fit on trusted positives and unlabelled rows outside the held-out fold.

    Trusted positives are rows of documents that are only ever labelled 1; labels 0 serve for nothing else. Unlabelled are all
    rows; their labels are not looked at. Mean and spread of the figures are those of all unlabelled rows. The class prior is
    the surely smallest ratio, over levels of the scores of a first fit with prior 0.5 and every other positive, of the share of all
    unlabelled rows and that of the remaining positives that reach the level. Only the steps of the fit, and the levels, see a sample: at most sample rows of either kind,
    rows with equal doc_id and text once, those of the smallest hashes of both, so a doc_id with many texts has the share in it
    that it has among such rows. Only the sample's figures, sample times two rows of fixed width, and a row per figure and per level
    reach the driver.
    """
    marked = labels.filter(~is_held_out(F.col("doc_id"), folds)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rank = F.xxhash64("doc_id", "hash"), F.col("doc_id"), F.col("hash")
    hashed = docs.filter(~is_held_out(F.col("doc_id"), folds)).select("doc_id", F.xxhash64("text").alias("hash"), "text")
    rows = saved(hashed.select("doc_id", "hash").distinct(), "rows")

    def chosen(df: DataFrame, kind: int) -> DataFrame:
        return df.select("doc_id", "hash").orderBy(*rank).limit(sample).withColumn("kind", F.lit(kind))

    positive = join_to_unique(rows, marked.filter("quality = 1").select("doc_id"), ["doc_id"], "inner")
    # At most two rows per sampled row, 20 bytes each: small whatever docs holds.
    picked = chosen(positive, 1).unionByName(chosen(rows, 0))

    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array([features(t) for t in texts.cast(pa.binary()).to_pylist()], pa.list_(pa.float64()))

    # Equal rows of a sampled one become one again before their figures are taken.
    texts = hashed.join(F.broadcast(picked), ["doc_id", "hash"]).groupBy("kind", "doc_id", "hash").agg(F.min("text").alias("text"))
    figures = texts.select("kind", "doc_id", "hash", measured("text").alias("x")).toPandas().sort_values(
        ["kind", "doc_id", "hash"], kind="stable")
    part = [np.array(figures.x[figures.kind == k].tolist(), dtype=float).reshape(-1, WIDTH) for k in (1, 0)]
    if not len(part[0]) or not len(part[1]):
        return Model(0.5)
    n, mean, deviation = spread(hashed)
    scale = deviation + 1e-3
    # Every other positive is kept from the first fit, as its own positives score too high.
    model = fit(part[0][::2], part[1], 0.5, mean, scale)
    scores = model.score(part[0][1::2] if len(part[0]) > 1 else part[0])
    levels = np.quantile(scores, LEVELS)
    reached = np.array([np.mean(scores >= t) for t in levels])
    prior = smallest_ratio(reached, shares_above(hashed, model, levels, n), len(scores), n)
    return fit(*part, prior, mean, scale)


def score_column(text, model: Model):
    """The score of a text column, 0 to 1: higher means likelier of good quality."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        rows = [features(t) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(model.score(np.array(rows).reshape(-1, WIDTH)))

    return scored(text)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = 8000, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score and predicted (1 where score >= threshold) of each document.

    Scores use the text alone. NULL and empty texts have the figures of an empty text and are scored like any other;
    rows that repeat a doc_id are scored each by its own text. NULL labels are no labels, and a document labelled both 0
    and 1 is no trusted positive. Without positives or documents to learn from, every score is 0.5. Other columns are ignored. An empty table gives no rows.
    """
    model = learn(docs, labels, sample, folds)
    scored = docs.select("doc_id", is_held_out(F.col("doc_id"), folds).alias("held_out"),
                         score_column(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
