"""Exact duplicates by a content sort: range partitions of whole texts, sorted, and every text compared with the one before it."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from .common import saved

#: White space that is not one space already: what normalising has to touch.
UNEVEN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
#: Leading bytes that splitters compare before they compare digests. Sampled splitters stay this small, however long texts are.
HEAD = 64

ORACLE = r"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
    FROM t"""


def normalised(text):
    """The text with one space for each run of ASCII white space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN, " ")


def copies(docs: DataFrame) -> DataFrame:
    """The copies of each document: doc_id, keep_id, group_size, kept, text_sha256, one row for each row of docs.

    Texts are equal when they are identical after normalised(). Of equal texts the row with the smallest doc_id is kept, one of
    them where rows repeat it; a NULL doc_id is kept only where its group has no other. NULL and empty texts are one group, a
    blank text is one space. All other columns are ignored. An empty table gives no rows.
    """
    return _stitched(_local_groups(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))).drop("row")


def one_of_each(docs: DataFrame) -> DataFrame:
    """All columns of the row that copies() keeps of each group."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct("*").alias("row"))
    return _stitched(_local_groups(rows)).filter("kept").select("row.*")


def _local_groups(docs: DataFrame) -> DataFrame:
    """Rows with the figures of their group in their partition, after the sort.

    Spark's range partitioning samples its splitters from (first bytes, digest, doc_id): order by content, small keys, and a
    large group of copies is cut between doc_ids, so that no partition has to hold it. Spark's sort spills to disk. Neighbours
    are compared in whole. A partition's first and last group may go on in the partitions beside it and are marked as edges.

    Columns: doc_id, text_sha256, keep_id, group_size (of the group in this partition), first (whether the row begins it), edge,
    part (number of the partition), row (where docs has it: of first rows only). Written once, without texts.
    """
    carried = "row" in docs.columns
    text = docs.withColumn("text", normalised(F.col("text")))
    text = text.withColumns({"sha": F.sha2("text", 256), "head": F.substring(F.col("text").cast("binary"), 1, HEAD)})
    ranged = text.repartitionByRange("head", "sha", F.col("doc_id").asc_nulls_last())
    ordered = ranged.sortWithinPartitions("head", "sha", F.col("doc_id").asc_nulls_last())
    columns = ["doc_id", "sha", "text", *(["row"] if carried else [])]
    schema = StructType([
        StructField("doc_id", LongType()), StructField("text_sha256", StringType()), StructField("keep_id", LongType()),
        StructField("group_size", LongType()), StructField("first", BooleanType()), StructField("edge", BooleanType()),
        StructField("part", IntegerType()), *([StructField("row", docs.schema["row"].dataType)] if carried else [])])

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        begun = None  # the open group: arrays of its doc_ids, its digest, its first row
        edge = True  # the first group of the partition
        last = None

        def out(ids: pa.Array, sha: pa.Array, starts: np.ndarray, sizes: np.ndarray, at_edge: bool, row: pa.Array | None):
            n = int(sizes.sum())
            group = np.repeat(np.arange(len(sizes)), sizes)
            first = np.zeros(n, bool)
            first[starts] = True
            arrays = [ids, sha.take(pa.array(group)), ids.take(pa.array(starts[group])), pa.array(sizes[group], pa.int64()),
                      pa.array(first), pa.array(np.full(n, at_edge)), pa.array(np.full(n, part, np.int32))]
            if carried:
                arrays.append(row.take(pa.array(group, mask=~first)))
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        def closed(at_edge: bool):
            ids, sha, row = begun
            whole = pa.concat_arrays(ids)
            return out(whole, sha, np.zeros(1, np.int64), np.array([len(whole)]), at_edge, row)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            text, ids, sha = batch["text"], batch["doc_id"], batch["sha"]
            same = np.zeros(n, bool)
            same[0] = last is not None and text[0].as_py() == last
            same[1:] = pc.equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
            last = text[n - 1].as_py()
            starts = np.flatnonzero(~same)
            goes_on = int(starts[0]) if len(starts) else n
            if goes_on:
                begun[0].append(ids[:goes_on])
            if not len(starts):
                continue
            if begun:
                yield closed(edge)
                edge = False
            if len(starts) > 1:  # groups that begin and end in this batch
                lo, hi = int(starts[0]), int(starts[-1])
                if edge:  # the very first group ends here
                    nxt = int(starts[1])
                    yield out(ids[lo:nxt], sha[lo:lo + 1], np.zeros(1, np.int64), np.array([nxt - lo]), True,
                              batch["row"][lo:lo + 1] if carried else None)
                    edge, lo, starts = False, nxt, starts[1:]
                if len(starts) > 1:
                    heads = pa.array(starts[:-1])
                    yield out(ids[lo:hi], sha.take(heads), starts[:-1] - lo, np.diff(starts), False,
                              batch["row"].take(heads) if carried else None)
            at = int(starts[-1])
            begun = [ids[at:]], sha[at:at + 1], batch["row"][at:at + 1] if carried else None
        if begun:
            yield closed(True)

    return saved(ordered.select(*columns).mapInArrow(grouped, schema), "content-sorted")


def _stitched(rows: DataFrame) -> DataFrame:
    """Groups cut by partition edges put together: each partition has two edge groups at most, so what is broadcast is bounded."""
    best = F.min(F.struct(F.col("keep_id").isNull().alias("none"), "keep_id", "part"))
    spans = rows.filter("edge AND first").groupBy("text_sha256").agg(best.alias("best"), F.sum("group_size").alias("total"))
    spans = spans.select(F.col("text_sha256").alias("of"), "best", "total")
    joined = rows.join(F.broadcast(spans), F.when(F.col("edge"), F.col("text_sha256")) == F.col("of"), "left")
    return joined.select(
        "doc_id", F.when(F.col("edge"), F.col("best.keep_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("total", "group_size").alias("group_size"),
        (F.col("first") & (~F.col("edge") | (F.col("best.part") == F.col("part")))).alias("kept"), "text_sha256",
        *([F.col("row")] if "row" in rows.columns else [F.lit(None).alias("row")]))
