"""Helpers shared by the corpus operators."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpointed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage is cut, and no later step computes it again.

    What is written stays until the session's folder goes, as results are read from it; session.scratch() removes it earlier.
    """
    return checkpointed(df, name)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (a, b): one row (node, component), component the smallest node.

    Alternating large-star and small-star steps: every step only links a node to a smaller one of its own
    component, so the table never holds more rows than edges, and the rounds grow with the logarithm of
    the longest chain. Each round is written to the shared folder. Nodes without an edge don't appear.
    """
    links = saved(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        # Large star: link every larger neighbour of a node, and the node itself, to its smallest neighbour.
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        up = low.filter("low < a").select("a", F.col("low").alias("b"))
        star = large.unionByName(up).filter("a != b").distinct()
        # Small star: link a node's smaller neighbours, and the node itself, to the smallest of them.
        least = star.groupBy("a").agg(F.min("b").alias("low"))
        small = star.join(least, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = saved(small.unionByName(least.select("a", F.col("low").alias("b"))).distinct(), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    root = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return root.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def byte_slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """First and end rows of slices of a binary column that hold about limit bytes each; a larger text is a slice alone."""
    sizes = np.array([len(t or b"") for t in texts.to_pylist()], dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(sizes)]
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist())
