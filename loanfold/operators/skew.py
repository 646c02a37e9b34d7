"""Many-to-one joins on keys of which one may hold a large share of all rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def hot_keys(df: DataFrame, on: Sequence[str], shares: int) -> DataFrame:
    """Keys that hold more than one of so many equal shares of the rows, with the number of shares each fills.

    Fewer than shares keys can do so, whatever df holds.
    """
    counts = df.select(*on).na.drop().groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    full = F.ceil(F.col("_n") * shares / total)
    return counts.filter(F.col("_n") * shares > total).select(*on, full.cast("int").alias("_salts"))


def join_to_unique(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                   counted: DataFrame | None = None, shares: int | None = None) -> DataFrame:
    """Join many rows to a side that is unique on the key, with hot keys spread over several tasks.

    A key is hot when it holds more than a task's equal share of the rows (shares: the number of shuffle
    partitions by default). Its rows on the left are split by a hash of the row, and its single row on the right is
    repeated once per share it fills. As the rule is relative, the plan is the same at every size, the hot keys are
    fewer than the shares and their copies fewer than twice the shares. Rows with a NULL key are spread the same way.

    counted: where to look for hot keys, the left side by default. Any list of keys gives the right
    result, so pass a plain scan with the key columns when left is costly to compute twice.
    Select the wanted columns of left first: the salt is a hash of the whole row.
    """
    on = [on] if isinstance(on, str) else list(on)
    shares = shares or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left if counted is None else counted, on, shares))  # fewer rows than shares
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | F.col(c).isNull()
    row = F.pmod(F.xxhash64(*left.columns), F.lit(1 << 20))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    salted_left = left.join(hot, on, "left").withColumn(
        "_salt", F.when(no_key, row).otherwise(F.pmod(row, salts)).cast("int")).drop("_salts")
    salted_right = right.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def join_where_keyed(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left-join a side that is unique on the key; rows without a key skip the join and get NULLs.

    For keys that most rows lack: those rows are neither shuffled nor gathered in the task of the NULL key. Both parts read left, so
    it should be a scan or a step that is written already; its filter on the key reaches the scan.
    """
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name != key]
    keyed = left.filter(F.col(key).isNotNull()).join(right, key, "left")
    order = [*left.columns, *[c for c in right.columns if c != key]]
    return keyed.select(*order).unionByName(left.filter(F.col(key).isNull()).select("*", *nothing).select(*order))


def with_group_value(df: DataFrame, key, value, name: str) -> DataFrame:
    """Attach an aggregate of the row's group. Aggregates first, so no group is gathered in one task."""
    on = [key] if isinstance(key, str) else list(key)
    return join_to_unique(df, df.groupBy(*on).agg(value.alias(name)), on)
