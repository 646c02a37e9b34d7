"""Small frames for the tests of corpus operators."""

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows, extra: bool = False) -> DataFrame:
    """Rows (doc_id, text[, source]) as documents; extra: with columns whose names clash with those that operators use."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        for name in ("size", "order", "slice", "fp", "component_id", "words", "spans", "score", "target", "key", "part", "n", "id"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df.repartition(3)


def rows_of(df: DataFrame):
    return sorted((tuple(r) for r in df.collect()), key=repr)
