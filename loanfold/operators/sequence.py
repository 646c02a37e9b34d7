"""Numbers over a whole table, ordered text lists and month series, each without a one-task step."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from ..session import settled


def global_sequence(df: DataFrame, by: Sequence[str], name: str, start=0, partitions: int | None = None) -> DataFrame:
    """Number all rows from start + 1 in the order of by.

    Rows are range-partitioned and sorted, numbered inside each partition, and shifted by the sizes of
    the partitions before. The numbered rows are checkpointed, because both the sizes and the rows must
    come from the same partitioning; this runs a job. Only one row per partition goes through a single
    task. start: a number or a column.
    """
    by = [by] if isinstance(by, str) else list(by)
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    local = ranged.sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    local = local.select(
        "*", F.shiftright("_id", 33).cast("int").alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_pos")
    ).drop("_id")
    local = settled(local)
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    start = F.lit(start) if isinstance(start, int) else start
    numbered = local.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, (F.col("_offset") + F.col("_pos") + 1 + start).cast("long")).drop(
        "_part", "_pos", "_offset"
    )


def ordered_list(df: DataFrame, key: str, value: str, name: str, separator: str = ",",
                 slices: int | None = None) -> DataFrame:
    """The values of a key as one text in ascending order.

    Values are range-partitioned by (key, value): a large key is sorted and joined slice by slice in
    several tasks, and the last step only concatenates the finished texts of a key.
    """
    listed = df.filter(F.col(value).isNotNull()).select(key, value)
    spread = listed.repartitionByRange(slices, key, value) if slices else listed.repartitionByRange(key, value)
    pieces = (
        spread.select(key, value, F.spark_partition_id().alias("_slice"))
        .groupBy(key, "_slice")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(value)), lambda v: v.cast("string")), separator)
             .alias("_text"))
    )
    in_order = F.sort_array(F.collect_list(F.struct("_slice", "_text")))
    return pieces.groupBy(key).agg(
        F.array_join(F.transform(in_order, lambda p: p["_text"]), separator).alias(name)
    )


def month_series(df: DataFrame, as_of: date, months: int, name: str) -> DataFrame:
    """Repeat each row once per month, from the given number of months back up to the month of as_of."""
    last = F.lit(as_of.replace(day=1))
    return df.withColumn(
        name, F.explode(F.sequence(F.add_months(last, -months), last, F.expr("interval 1 month")))
    )
