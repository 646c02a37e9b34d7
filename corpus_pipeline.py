"""The corpus pipeline over documents: quality, near duplicates, benchmark passages, secrets, mixing.

Each stage works on all rows that the one before kept, and all but the last return the columns of documents. NULL and
empty texts, NULL and repeated doc_ids, NULL sources and empty tables pass every stage as its operator defines.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanfold.llm import decontamination, mixing, quality, secrets, simhash
from loanfold.llm.common import saved, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more; it learns from the labels of the other four folds."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score_column(F.col("text"), model) >= 0.3)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the words inside any occurrence of a benchmark window cut out of their texts."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by [SECRET]."""
    return secrets.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that a mix at the target weights takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
]

#: A trained classifier and XXH64 fingerprints have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
