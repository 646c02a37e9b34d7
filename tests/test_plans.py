"""Plans: filters and columns reach the files, spines are shuffled once, nothing is gathered in one task."""

import re

import pytest

from loanfold.bindings import REGISTRY
from loanfold.bindings.raw import AS_OF, RAW, RUN_TS, raw_tables
from loanfold.bindings.registry import Inputs
from loanfold.bindings.tables_and_rows import scratch_database
from loanfold.functions.dates import on_day
from loanfold.operators import loans, receipts, scoring
from loanfold.plans import collections_daily, early_warning, loan_details
from loanfold.plans.refresh import refresh
from loanfold.sources.tables import Tables

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Derived raw tables as files, so that plans start at real scans."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    folder = str(tmp_path_factory.mktemp("raw"))
    derived = raw_tables(spark, SF_DIR)
    for name in RAW:
        derived[name].write.parquet(f"{folder}/{name}")
    return Tables.from_folder(spark, folder)


def test_filters_and_columns_reach_the_scan(raw):
    text = plan(receipts.cleared_receipts(raw["tblloanapplicationmanualreceipt"]).select("loanapplicationid", "collectedamount"))
    assert "EqualTo(statustypedetailid,219)" in text and "EqualTo(isactive,1)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"loanapplicationid", "collectedamount", "statustypedetailid", "isactive"}
    charges = raw["tblloanapplicationchargedetails"]
    assert "GreaterThanOrEqual(chargedate" in plan(charges.filter(on_day("chargedate", AS_OF)))


def test_newest_rows_read_only_carried_columns(raw):
    text = plan(loans.newest_decision(raw["tblloanapplicationruleengineresponse"], ["finalfoir"]))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "propertyvalue" not in schema and "finalfoir" in schema
    assert text.count("WindowGroupLimit") == 2


def test_loan_spine_is_shuffled_once(spark, raw):
    """Each loan-level side brings one exchange, the spine one more; lookups do not move it."""
    text = plan(loan_details.build(raw, raw, AS_OF, RUN_TS))
    by_loan = re.findall(r"Exchange hashpartitioning\(loanapplicationid#\d+L?, \d+\)", text)
    sides = 11  # reschedule, acceptance, tenure, due status, spread, waivers, links (counts, texts), checks, decision, disbursal, additional
    assert len(by_loan) <= sides + 3
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text


# The only one-task steps besides totals: the list of partition sizes.
ONE_TASK = {"w10_global_sequence", "g10_early_warning", "g10_early_warning_chained"}


def gathered_rows(text: str) -> list[str]:
    """One-task exchanges that receive more than one partial total per task."""
    lines = text.split("\n")
    below = [(x, lines[i + 1]) for i, x in enumerate(lines) if "Exchange SinglePartition" in x]
    return [x for x, y in below if not re.search(r"Aggregate\(keys=\[\], functions=\[partial_", y)]


@pytest.mark.parametrize("name", [n for n in REGISTRY if not n.startswith(("s3", "s4", "s5", "s6", "s7", "s8", "s10", "s2"))])
def test_no_cross_join_no_python_no_single_task(spark, name):
    text = plan(REGISTRY[name].run(spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in text
    if name not in ONE_TASK:
        assert gathered_rows(text) == []


@pytest.mark.parametrize("name", list(RAW))
def test_inputs_are_whole_tables(spark, name):
    """Each derived table has a row for every row of its source, payments and charges for every event of their type."""
    inputs = Inputs(spark, SF_DIR)
    first = RAW[name].split("UNION ALL")[0]
    source = re.search(r"FROM \{+(\w+)\}+", first).group(1)
    cut = re.search(r"WHERE (.*)", first)
    cut = cut.group(1) if cut else "true"
    assert re.fullmatch(r"true|event_type (?:= '\w+'|IN \([^)]*\))|l_returnflag <> 'R'|isactive = 1", cut)
    if "GROUP BY" in first:
        return  # one row per month of a loan
    rows = inputs.raw[source] if source.startswith("tbl") else inputs[source]
    assert inputs.raw[name].count() >= rows.filter(cut).count()


def test_history_is_pruned_to_month_ends_and_the_newest_day(spark, tmp_path):
    """On a history partitioned by day, the previous score reads month ends only, the largest id one day only."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    inputs = Inputs(spark, SF_DIR)
    inputs.raw["slv_early_warning"].write.partitionBy("signal_date").parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    text = plan(scoring.previous_scores(history, AS_OF))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "last_day(signal_date" in filters and "< 1998-06-30" in filters
    silver = Tables(lambda name: history if name == "slv_early_warning" else inputs.raw[name])
    text = early_warning.build(inputs.raw, silver, AS_OF, RUN_TS)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"signal_date#\d+ = scalar-subquery", text) and "max(signal_date" in text


def test_built_loans_are_joined_without_a_shuffle(spark):
    """The refresh writes loan tables in buckets: collections and early warning read the loans where they lie."""
    derived = raw_tables(spark, SF_DIR)
    database = scratch_database(spark)
    refresh(spark, derived, database, AS_OF, RUN_TS, names=["slv_loan_details", "slv_contract_perf_monthly"])
    built = Tables.from_catalog(spark, database)
    silver = Tables(lambda name: built[name] if name in ("slv_loan_details", "slv_contract_perf_monthly") else derived[name])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (collections_daily.build(derived, silver, AS_OF, RUN_TS), early_warning.flags(derived, silver, AS_OF)):
            lines = plan(df).split("\n")
            scans = [i for i, x in enumerate(lines) if "FileScan parquet" in x and "slv_loan_details" in x]
            assert scans
            for i in scans:
                depth = lines[i].index("FileScan")
                above = []
                for x in reversed(lines[:i]):
                    at = len(x) - len(x.lstrip(" :+-*"))
                    if at < depth:
                        depth = at
                        above.append(x.strip(" :+-"))
                joined = next(k for k, x in enumerate(above) if "Join" in x)
                assert not [x for x in above[:joined] if "Exchange" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
