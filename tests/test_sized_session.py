"""Large input gets more shuffle partitions than the session has; small input and the session itself are left alone."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loanfold import session
from loanfold.bindings import REGISTRY
from loanfold.bindings.raw import raw_tables
from loanfold.bindings.registry import Inputs

PARTITIONS = "spark.sql.shuffle.partitions"
QUERIES = ("c29_non_starter", "g10_early_warning", "g11_branch_historical_chained", "g1_loan_details", "g2_customer",
           "g7_employee_chained", "g8_branch_chained")


def write_tables(spark, path: str, orders: int) -> str:
    """Four lineitems an order; every tenth order is active and owes its first two instalments."""
    lines = spark.range(4 * orders).select(
        F.expr("id div 4").alias("l_orderkey"), (F.col("id") % 1000).alias("l_partkey"), (F.col("id") % 90).alias("l_suppkey"),
        (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"), (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        F.round(F.rand(1) * 1e5, 2).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.1).alias("l_tax"),
        F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.timestamp_add("DAY", (F.col("id") % 4).cast("int"), F.lit(datetime(1998, 1, 1))).alias("l_shipdate"))
    heads = spark.range(orders).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 500).alias("o_custkey"), F.when(F.col("id") % 10 == 0, "F").otherwise("O").alias("o_orderstatus"),
        F.round(F.rand(2) * 1e5, 2).alias("o_totalprice"), F.lit(datetime(1997, 1, 1)).alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    small = {
        "events": ([(i, datetime(2024, 1, 1 + i), i, "purchase", 5.0, "{}") for i in range(9)],
                   "event_id long, ts timestamp, user_id long, event_type string, value double, props string"),
        "customer": ([(i, f"c{i}", i, 1.0, "AUTO") for i in range(9)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(i, f"s{i}", i, 1.0) for i in range(9)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(i, f"n{i}", i % 5) for i in range(25)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(i, f"r{i}") for i in range(5)], "r_regionkey int, r_name string"),
    }
    for name, df in {"lineitem": lines, "orders": heads, **{n: spark.createDataFrame(*t) for n, t in small.items()}}.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("small")), 40)


def shuffled_to(df) -> set[int]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return {int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\)", text)}


def test_large_input_is_dealt_to_more_partitions_with_the_same_rows(spark, tmp_path):
    folder, before = write_tables(spark, str(tmp_path), 600_000), spark.conf.get(PARTITIONS)
    df = REGISTRY["c29_non_starter"].run(spark, folder)
    assert min(shuffled_to(df)) > int(before)
    plain = REGISTRY["c29_non_starter"].run(spark, folder, raw_tables(spark, folder))
    assert shuffled_to(plain) == {int(before)}
    assert df.count() and sorted(df.collect()) == sorted(plain.collect())
    assert spark.conf.get(PARTITIONS) == before


@pytest.mark.parametrize("name", QUERIES)
def test_queries_over_loans_are_dealt_out_by_the_size_of_their_input(spark, small, monkeypatch, name):
    before = int(spark.conf.get(PARTITIONS))
    monkeypatch.setattr(session, "BYTES_A_PARTITION", 512)
    df = REGISTRY[name].run(spark, small)
    assert int(df.sparkSession.conf.get(PARTITIONS)) > before
    df.collect()


def test_small_input_keeps_the_session(spark, small):
    assert Inputs(spark, small).spark is spark
    assert Inputs(spark, f"{small}/none").spark is spark


def test_a_sized_session_keeps_the_settings(spark, small, monkeypatch):
    monkeypatch.setattr(session, "BYTES_A_PARTITION", 512)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_001)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        sized = Inputs(spark, small).spark
        assert sized.conf.get("spark.sql.maxMetadataStringLength") == "10001"
        assert sized.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
        assert int(sized.conf.get("spark.sql.files.maxPartitionBytes")) == 1 << 20
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("given, held", [("-1", "-1"), ("256k", "262144"), ("10MB", "1048576")])
def test_a_sized_session_broadcasts_no_more_than_the_one_given(spark, small, monkeypatch, given, held):
    monkeypatch.setattr(session, "BYTES_A_PARTITION", 512)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", given)
    try:
        assert Inputs(spark, small).spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == held
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == given
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
