"""Table lifecycle: refresh, create once, clone, append, layout, audit stamp, retention."""

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.dates import batch_id, moment, months_before
from ..operators.history import RETENTION_MONTHS, SNAPSHOT_KEY, new_rows
from .publish import add_new_rows, columns_of, drop_partitions, partition_columns, publish, publish_partitions, recover


def full_refresh(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table by the rows of df.

    A failed build leaves the old rows. A table with partitions that keeps its columns gets them one by one, and loses those that
    df has no rows of.
    """
    spark = df.sparkSession
    recover(spark, table)
    if partition_by and spark.catalog.tableExists(table):
        declared = [(f.name.lower(), f.dataType.simpleString(), f.name in partition_by) for f in df.schema]
        if partition_columns(spark, table) == list(partition_by) and sorted(declared) == sorted(columns_of(spark, table)):
            publish_partitions(df, table, only=True)
            return
    writer = df.write.format("parquet")
    publish(spark, writer.partitionBy(*partition_by) if partition_by else writer, table)


def bucketed_refresh(df: DataFrame, table: str, key: str, buckets: int, sort_keys: Sequence[str] = ()) -> None:
    """Replace a table by df in buckets of a key, so that later joins and groupings on it need no shuffle.

    Rows are dealt out by the key first, so that each task writes the one file of its bucket. Files are sorted by the key and
    the sort keys, or by the sort keys as given if the key is among them: with another key first, a read by the bucket's key opens one
    bucket and a read by the other key skips row groups.
    """
    order = list(sort_keys) if key in sort_keys else [key, *sort_keys]
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(*order)
    publish(df.sparkSession, writer, table)


def ensure_table(spark: SparkSession, table: str, schema: str, partition_by: Sequence[str] = ()) -> bool:
    """Create an empty table with declared columns, or bring an existing one in line. True when it was created.

    Columns that an existing table lacks are added at its end and are NULL in its rows; columns it has beyond the declared
    ones stay. A column of another type, or other partitions, cannot be mended without rewriting rows: both raise.
    """
    recover(spark, table)
    if not spark.catalog.tableExists(table):
        full_refresh(spark.createDataFrame([], schema), table, partition_by)
        return True
    declared, have = StructType.fromDDL(schema), {name: kind for name, kind, _ in columns_of(spark, table)}
    wrong = [f"{f.name} is {have[f.name.lower()]}, declared {f.dataType.simpleString()}" for f in declared
             if have.get(f.name.lower(), f.dataType.simpleString()) != f.dataType.simpleString()]
    parts = partition_columns(spark, table)
    if parts != list(partition_by):
        wrong.append(f"partitions are {parts}, declared {list(partition_by)}")
    if wrong:
        raise ValueError(f"{table}: " + "; ".join(wrong))
    missing = [f for f in declared if f.name.lower() not in have]
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing) + ")")
    return False


def empty_clone(df: DataFrame, extra: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """The columns of df after the extra ones (name, type), without rows."""
    return df.select(*[F.lit(None).cast(kind).alias(name) for name, kind in extra], *df.columns).limit(0)


def append_by_name(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Append the listed columns, matched by name, to the table's partitions if it has any."""
    writer = df.select(*columns).write.mode("append").format("parquet")
    partitions = partition_columns(df.sparkSession, table)
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(table)


def append_new(df: DataFrame, table: str, keys: Sequence[str] = SNAPSHOT_KEY, within=None) -> None:
    """Append rows whose key the table lacks. Partitions get them whole: each is published with its old rows and the new ones.

    within: a predicate on the table that holds for every key of df; it prunes the partitions compared.
    """
    if partition_columns(df.sparkSession, table):
        add_new_rows(df, table, keys, within)
        return
    target = df.sparkSession.table(table)
    append_by_name(new_rows(df, target if within is None else target.filter(within), keys), table, target.columns)


def drop_expired(spark: SparkSession, table: str, column: str, as_of: date, months: int = RETENTION_MONTHS) -> int:
    """Drop the partitions of a date column older than the given number of months; no data is rewritten.

    Returns how many went. The list handled here is one entry per day kept.
    """
    cutoff = spark.range(1).select(months_before(as_of, months).cast("string")).first()[0]
    names = [row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    days = {name: name.split("=", 1)[1] for name in names if name.startswith(f"{column}=")}
    return drop_partitions(spark, table, [n for n, day in days.items() if day < cutoff and not day.startswith("__")])


def layout(df: DataFrame, key: str, sort_keys: Sequence[str] = ()) -> DataFrame:
    """Bring the rows of a key together and sort them, for writing.

    Rebalancing lets Spark merge small partitions and split one that a large key has blown up, and it
    needs no sampling pass over df.
    """
    order = list(dict.fromkeys([key, *sort_keys]))
    return df.hint("rebalance", F.col(key)).sortWithinPartitions(*order)


def cluster(df: DataFrame, keys: Sequence[str], files: int | None = None, cuts: int = 256) -> DataFrame:
    """Lay rows out for reads by any one of several keys: files and row groups hold a narrow range of each.

    Each key is cut into ranges of about equal rows (approximate quantiles, one pass over the keys; a few hundred values come to the
    driver, whatever the size). The bits of the range numbers are interleaved, and rows are range-partitioned and sorted by
    the result. With n files a read by one of k keys opens about n ^ (1 - 1/k) of them. NULL keys are in the last range.
    Keys are numbers, dates or timestamps.
    files: about how many to write, as many as Spark's shuffle has partitions by default. cuts: a power of two.
    """
    bits = cuts.bit_length() - 1
    shares = [i / cuts for i in range(1, cuts)]
    points = df.agg(*[F.percentile_approx(c, shares, 20 * cuts).alias(c) for c in keys]).first()

    def range_of(c: str, lo: int, hi: int) -> Column:
        """Number of the range between two, by halving."""
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(c) < F.lit(points[c][mid]), range_of(c, lo, mid)).otherwise(range_of(c, mid + 1, hi))

    keys = [c for c in keys if points[c]]  # without those that are NULL in all rows
    place = F.lit(0).cast("long")
    for k, c in enumerate(keys):
        number = range_of(c, 0, cuts - 1).cast("long")
        for i in range(bits):
            place = place + F.shiftleft(F.shiftright(number, i).bitwiseAND(F.lit(1)), i * len(keys) + k)
    placed = df.withColumn("_place", place)
    ranged = placed.repartitionByRange(files, "_place") if files else placed.repartitionByRange("_place")
    return ranged.sortWithinPartitions("_place", *keys).drop("_place")


def audit_stamp(df: DataFrame, run_ts: datetime, prefix: str = "silver", separator: str = "_") -> DataFrame:
    """Load time and batch id of the run."""
    return df.select("*", moment(run_ts).alias(f"{prefix}_loaded_at"),
                     batch_id(run_ts, separator).alias(f"{prefix}_batch_id"))
