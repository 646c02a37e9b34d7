"""The whole refresh over raw tables derived from the smallest test tables, into a catalog database."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from loanfold.bindings.raw import AS_OF, RUN_TS, raw_tables
from loanfold.bindings.tables_and_rows import scratch_database
from loanfold.plans import early_warning
from loanfold.plans.refresh import SILVER, refresh
from loanfold.session import shared_folder
from loanfold.sources import sinks
from loanfold.sources.tables import Tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return raw_tables(spark, SF_DIR)


@pytest.fixture(scope="module")
def database(spark, raw):
    name = scratch_database(spark)
    refresh(spark, raw, name, AS_OF, RUN_TS)
    return name


def test_all_tables_are_built(spark, database):
    names = {t.name for t in spark.catalog.listTables(database)}
    assert names == {*SILVER, "slv_early_warning"}
    assert all(spark.table(f"{database}.{n}").count() > 0 for n in names)


@pytest.mark.parametrize("table, key", [
    ("slv_loan_details", ["loan_application_id"]), ("slv_customer", ["applicant_id"]),
    ("slv_contract_perf_monthly", ["loan_application_id", "snapshot_date"]), ("slv_asset", ["property_detail_id"]),
    ("slv_channel_partner", ["dsa_id"]), ("slv_enquiry", ["lead_id"]), ("slv_loan_processing", ["loan_application_id"]),
    ("slv_employee", ["employee_id", "branch_id"]), ("slv_branch", ["branch_id"]), ("slv_collections_daily", ["loan_due_status_id"]),
    ("slv_branch_historical", ["branch_id", "snapshot_date"]), ("slv_early_warning", ["loan_application_id", "signal_date"]),
])
def test_grain(spark, database, table, key):
    rows = spark.table(f"{database}.{table}")
    assert rows.count() == rows.select(*key).distinct().count()


def test_values_of_the_chain(spark, database):
    """Tables read what was built before them, and nothing is left beside them."""
    loans = spark.table(f"{database}.slv_loan_details")
    daily = spark.table(f"{database}.slv_collections_daily").join(loans.select("loan_application_id", F.col("is_employee_loan").alias("of")),
                                                                   "loan_application_id", "left")
    assert daily.filter("NOT is_employee_loan <=> of").count() == 0
    branches = spark.table(f"{database}.slv_branch")
    months = spark.table(f"{database}.slv_branch_historical")
    figures = ["total_pos", "active_loan_count", "active_employee_count", "total_loans_originated"]
    assert months.select("branch_id", *figures).distinct().exceptAll(branches.select("branch_id", *figures)).count() == 0
    assert not [t.name for t in spark.catalog.listTables(database) if t.name.endswith(("__new", "__old"))]


def test_failed_refresh_keeps_the_old_table(spark):
    table = f"{scratch_database(spark)}.t"
    sinks.full_refresh(spark.range(5), table)
    with pytest.raises(Exception):
        sinks.full_refresh(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), table)
    assert spark.table(table).count() == 5
    sinks.bucketed_refresh(spark.range(7), table, "id", 3)
    assert spark.table(table).count() == 7


def test_days_in_any_order_have_ids_of_their_own(spark, raw, database):
    """The day before, then the day after: as many ids as rows, and nothing of the numbering stays in the shared folder."""
    folder = f"{shared_folder(spark)}/loanfold"
    before = set(os.listdir(folder))
    for day in (date(1998, 6, 29), date(1998, 7, 1)):
        refresh(spark, raw, database, day, datetime(day.year, day.month, day.day, 1), names=["slv_early_warning"])
    assert set(os.listdir(folder)) == before
    rows = spark.table(f"{database}.slv_early_warning")
    days = rows.groupBy("signal_date").agg(F.count(F.lit(1)).alias("n"), F.min("ews_id").alias("low"), F.max("ews_id").alias("high")).collect()
    assert len(days) == 3 and all(r.high - r.low + 1 == r.n for r in days)
    assert rows.count() == rows.select("ews_id").distinct().count()
    assert [r.signal_date.day for r in sorted(days, key=lambda r: r.low)] == [30, 29, 1]


def test_second_run_of_a_day_adds_nothing(spark, raw, database):
    table = spark.table(f"{database}.slv_early_warning")
    before = table.count()
    refresh(spark, raw, database, AS_OF, datetime(1998, 6, 30, 23), names=["slv_early_warning"])
    spark.catalog.refreshTable(f"{database}.slv_early_warning")
    assert spark.table(f"{database}.slv_early_warning").count() == before


def test_next_day_continues_ids_and_compares_scores(spark, raw, database):
    refresh(spark, raw, database, date(1998, 7, 1), datetime(1998, 7, 1, 1), names=["slv_early_warning"])
    rows = spark.table(f"{database}.slv_early_warning")
    assert rows.count() == rows.select("ews_id").distinct().count()
    today = rows.filter(F.col("signal_date") == F.lit(date(1998, 7, 1)))
    assert today.filter(F.col("previous_month_ews_score").isNull()).count() == 0
    assert {r[0] for r in today.select("snapshot_type").distinct().collect()} == {"CURRENT_DAY"}


def test_retention_drops_whole_partitions(spark, database):
    table = f"{database}.slv_early_warning"
    days = {r[0] for r in spark.table(table).select("signal_date").distinct().collect()}
    assert sinks.drop_expired(spark, table, "signal_date", date(1999, 12, 29)) == 0
    assert sinks.drop_expired(spark, table, "signal_date", date(1999, 12, 31)) == 1  # 29 June
    assert sinks.drop_expired(spark, table, "signal_date", date(2000, 1, 1)) == 1
    left = {r[0] for r in spark.table(table).select("signal_date").distinct().collect()}
    assert left < days


def test_layout_sorts_files_and_keeps_keys_together(spark, tmp_path):
    rows = spark.range(20_000).select((F.col("id") % 500).alias("k"), (F.col("id") * 7919 % 20_011).alias("v"))
    sinks.layout(rows, "k", ["v"]).write.option("maxRecordsPerFile", 0).parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t")).withColumn("f", F.input_file_name())
    assert back.groupBy("k").agg(F.count_distinct("f").alias("n")).filter("n > 1").count() == 0
    for path in [r.f for r in back.select("f").distinct().collect()]:
        got = [(r.k, r.v) for r in spark.read.parquet(path).collect()]
        assert got == sorted(got)


def test_tables_by_folder_have_lower_case_names(spark, tmp_path):
    spark.range(3).select(F.col("id").alias("LoanID")).write.parquet(str(tmp_path / "tblx"))
    assert Tables.from_folder(spark, str(tmp_path))["TBLX"].columns == ["loanid"]


def test_early_warning_declares_all_columns(spark, database):
    assert set(spark.table(f"{database}.slv_early_warning").columns) == set(early_warning.COLUMNS)
