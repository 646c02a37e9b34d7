"""Mixing sources to target weights: hash-random order, prefix sums of sizes, exact cuts, repeated epochs."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.sequence import global_sequence
from .common import saved

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Number of words between ASCII white space; a NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_order(doc_id: str, text: str, seed: str):
    """A number below 2^60 from a hash of seed, doc_id and text."""
    parts = F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")))
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts)), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """One row per source: source_no (by code point from 1, NULL last), n_docs, source_size, target.

    Weights are dealt to the sources in order, again and again. The sizes of all sources are shared by weight;
    a source stops at max_epochs times its size, and what it leaves is shared by the others until none is above.
    """
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")).withColumn("last", F.col("source").isNull())
    numbered = global_sequence(totals, ["last", "source"], "source_no")
    turn = F.pmod(F.col("source_no") - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")).cast("long")
    numbered = saved(numbered.select("source", "source_no", "n_docs", "source_size", weight.alias("weight")), "sources")
    cap = F.col("source_size") * max_epochs
    total, all_weights = numbered.agg(F.sum("source_size"), F.sum("weight")).first()
    left, share = total or 0, all_weights or 0
    while share:
        level = F.lit(float(left)) * F.col("weight") / F.lit(float(share))
        full = numbered.filter(cap.cast("double") <= level).agg(F.sum(cap), F.sum("weight")).first()
        now = (total - (full[0] or 0), all_weights - (full[1] or 0))
        if now == (left, share):
            break
        left, share = now
    target = cap.cast("double")
    if share:
        target = F.least(target, F.lit(float(left)) * F.col("weight") / F.lit(float(share)))
    return numbered.withColumn("target", target)


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """How many words of each document a mix takes: doc_id, source, size, source_size, target, taken.

    Documents of a source are put in the order of a hash of seed, doc_id and text, so that rows that share a doc_id, or
    have none, lie apart like any others. The order is cut into as many equal
    ranges of the hash as the square root of the source's documents, so that neither a range nor the list of a
    source's ranges is large, however large the source is. Sums inside ranges and over ranges give each document
    the words before it. The target, rounded to whole words, takes whole epochs first; the rest takes documents
    in order, and cuts the last one. So a source's taken words equal its rounded target.

    NULL texts have size 0, NULL sources are a source of their own, NULL doc_ids and texts are hashed as empty text.
    Rows of equal doc_id and text follow each other. All other columns of docs are ignored. An empty table gives no rows.
    """
    sized = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                              hash_order("doc_id", "text", seed).alias("order")), "sized")
    sources = source_targets(sized, weights, max_epochs)
    wide = F.ceil(F.sqrt("n_docs"))
    placed = sized.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.*", "source_no", "source_size", "target",
        F.floor(F.col("order").cast("double") / F.lit(float(1 << 60)) * wide).cast("long").alias("slice"))
    sums = placed.groupBy("source_no", "slice").agg(F.sum("size").alias("slice_size"))
    earlier = Window.partitionBy("source_no").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_no", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_no", "slice").orderBy("order", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = placed.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, ["source_no", "slice"])
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("offset") - F.col("inner")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return ranked.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def epochs_of(mixed: DataFrame) -> DataFrame:
    """One row per document and epoch of a mix: doc_id, source, epoch from 1, and the words to take from its start."""
    n = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    some = mixed.filter(F.col("taken") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(1), n)))
    words = F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    return some.select("doc_id", "source", "epoch", words.alias("words"))


#: The same rows from one sorted window per source.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS pos
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS s,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source),
steps AS (
  SELECT *, sum(s) OVER () - coalesce(3 * sum(s) OVER before, 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS share
  FROM sources WINDOW before AS (ORDER BY s::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
settled AS (SELECT rest::DOUBLE AS rest, share::DOUBLE AS share FROM steps
            WHERE 3 * s >= rest::DOUBLE * w / share::DOUBLE ORDER BY share DESC LIMIT 1),
targets AS (
  SELECT source, s, least((3 * s)::DOUBLE, (SELECT rest FROM settled) * w / (SELECT share FROM settled)) AS target
  FROM sources),
summed AS (
  SELECT d.*, t.s AS source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY pos, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size
             + greatest(0, least(budget - (budget // source_size) * source_size - earlier, size)) ELSE 0 END)::BIGINT AS taken
FROM summed
"""
