"""Operators on hand-made rows: NULLs, blanks, ties, bucket edges, month ends, hot keys, reruns."""

from collections import Counter
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from loanfold.functions import dates, flags, numbers, text
from loanfold.operators import (
    backfill, customers, dedup, history, loans, lookup, portfolio, receipts, scoring, sequence, signals, skew,
)

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def values(df, column):
    return [r[column] for r in df.collect()]


def one(spark, expression, schema, row):
    return frame(spark, schema, row).select(expression.alias("v")).first().v


# --- dedup -------------------------------------------------------------------------------------------------

def test_null_version_never_wins_by_default(spark):
    rows = frame(spark, "k int, t int, v string", (1, None, "null"), (1, 3, "new"), (1, 2, "old"), (2, None, "only"))
    got = {r.k: r.v for r in dedup.newest_per_key(rows, "k", "t").collect()}
    assert got == {1: "new", 2: "only"}
    first = dedup.newest_per_key(rows, "k", "t", nulls="first")
    assert {r.k: r.v for r in first.collect()} == {1: "null", 2: "only"}


def test_ties_are_settled_by_the_carried_columns(spark):
    rows = frame(spark, "k int, t int, v string", (1, 5, "a"), (1, 5, "c"), (1, 5, "b"))
    for order in (["v"], [F.col("v").desc()]):
        assert dedup.newest_per_key(rows.orderBy(*order), "k", "t", carry=["v"]).first().v == "c"


@SLOW
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), max_size=25))
def test_one_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = {r.k: (r.t, r.v) for r in dedup.newest_per_key(df, "k", "t").collect()}
    want = {}
    for k, t, v in rows:
        want[k] = max(want.get(k, ((-1, 0), -1)), ((t if t is not None else -1, 0), v))
    assert got == {k: (t[0] if t[0] >= 0 else None, v) for k, (t, v) in want.items()}


def test_rank_stays_below_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.newest_per_key(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_newest_as_columns_leaves_missing_ones_null(spark):
    rows = frame(spark, "k int, t int, v int", (1, 1, 10), (1, 2, 20), (2, 1, 5))
    got = {r.k: (r.a, r.b, r.c) for r in dedup.newest_as_columns(rows, "k", "t", "v", ["a", "b", "c"]).collect()}
    assert got == {1: (20, 10, None), 2: (5, None, None)}


# --- joins on hot keys -------------------------------------------------------------------------------------

@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_keys_are_spread_without_changing_the_join(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"), "id")
    right = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = left.join(right, "k", how).select("k", "id", "v")
    salted = skew.join_to_unique(left, right, "k", how, shares=30).select("k", "id", "v")
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))


def test_hot_keys_need_salts_in_proportion(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in skew.hot_keys(df, ["k"], shares=10).collect()] == [(1, 4)]
    even = spark.range(100_000).select((F.col("id") % 500).alias("k"))
    assert skew.hot_keys(even, ["k"], shares=500).count() == 0


def test_every_hot_key_is_split(spark):
    many = spark.range(100_000).select((F.col("id") % 100).alias("k"), "id")  # 100 keys of one percent each
    hot = {r.k: r._salts for r in skew.hot_keys(many, ["k"], shares=350).collect()}
    assert hot == dict.fromkeys(range(100), 4)
    right = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = skew.join_to_unique(many, right, "k", shares=350)
    assert joined.count() == 100_000 and joined.filter("v <> 2 * k").count() == 0
    row = F.pmod(F.xxhash64("k", "id"), F.lit(1 << 20))
    assert many.groupBy("k", F.pmod(row, F.lit(4)).alias("salt")).count().groupBy("k").count().filter("count = 4").count() == 100


def test_group_value(spark):
    df = frame(spark, "k int, v int", (1, 1), (1, 9), (2, 3))
    got = skew.with_group_value(df, "k", F.max("v"), "top")
    assert sorted(map(tuple, got.collect())) == [(1, 1, 9), (1, 9, 9), (2, 3, 3)]


def test_rows_without_a_key_skip_the_join(spark):
    """95 % of the keys are NULL: no task of the shuffle gets them, and none is lost."""
    left = spark.range(0, 40_000, 1, 8).selectExpr("id", "if(id % 20 = 0, id div 20, NULL) AS k")
    right = spark.range(0, 1000).selectExpr("id AS k", "id * 2 AS v")
    for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(setting, "-1")
    try:
        found = skew.join_where_keyed(left, right, "k")
        rows = found.select("*", F.spark_partition_id().alias("p")).collect()
        assert found.columns == ["id", "k", "v"] and len(rows) == 40_000 and len({r.id for r in rows}) == 40_000
        assert all(r.v == (r.k * 2 if r.k is not None and r.k < 1000 else None) for r in rows)
        parts = [r.p for r in rows if r.k is None]
        assert max(parts.count(p) for p in set(parts)) <= 5000  # as many as a scan task has
        assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert skew.join_where_keyed(left.filter("k IS NULL"), right, "k").filter("v IS NOT NULL").count() == 0


# --- lookups -----------------------------------------------------------------------------------------------

TYPES = "typedetailid int, typedetaildescription string, isactive int"


def test_decode_keeps_the_number_of_rows(spark):
    types = frame(spark, TYPES, (1, "one", 1), (1, "uno", 1), (2, "two", 0))
    df = frame(spark, "a int, b int", (1, 2), (2, 1), (None, 9), (1, 1))
    got = lookup.decode(df, types, {"a_text": "a", "b_text": "b"})
    assert got.count() == 4
    assert sorted(values(lookup.decode(df, types, {"t": "a"}, active_only=True), "t"), key=str) == [None, None, "uno", "uno"]


def test_decode_by_dictionary_and_by_join_agree(spark, monkeypatch):
    """Many codes in each slot, unknown, NULL and negative codes, codes of other types; no join unless the table is too large."""
    types = spark.range(-50, 5000).selectExpr("cast(id * 7 AS int) AS typedetailid", "concat('text ', id) AS typedetaildescription", "cast(id % 2 AS int) AS isactive")
    types = types.unionByName(frame(spark, TYPES, (None, "none", 1), (3, None, 1)))
    df = spark.range(0, 40_000).selectExpr("cast(id - 399 AS int) AS a", "if(id % 5 = 0, NULL, id) AS b", "cast(id AS string) AS c",
                                           "if(id % 2 = 0, 'x', cast(id AS string)) AS d")
    labels = {"a_text": "a", "b_text": "b", "c_text": "c"}
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    found = lookup.decode(df, types, labels)
    assert "Join" not in plan(found) and found.filter("a_text IS NOT NULL AND b_text IS NOT NULL").count() > 1000
    assert lookup.decode(df, types, {"d_text": "d"}).filter("d = 'x' AND d_text IS NOT NULL").count() == 0
    once = found.collect()
    monkeypatch.setattr(lookup, "MOST_CODES", 100)
    joined = lookup.decode(df, types.select("*"), labels)  # another table object: counted anew
    assert "Join" in plan(joined) and sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, once), key=repr)


def test_attach_may_replace_a_column(spark):
    df = frame(spark, "k int, name string", (1, "mine"))
    dim = frame(spark, "id int, name string", (1, "theirs"))
    got = lookup.attach(df, dim, ("k", "id"), {"name": "name"})
    assert got.columns == ["k", "name"] and got.first().name == "theirs"


# --- text --------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("raw, strip, want", [
    ("12.50", "trim", "12.50"), (" 7 ", "trim", "7.00"), ("x", "trim", None), (None, "trim", None), ("", "trim", None),
    ("1,234.5", "trim", None), ("1,234.5", "noise", "1234.50"), ("Rs. 90", "noise", None), ("Rs 90", "noise", "90.00"),
    ("45%", "percent", "45.00"), (" 45 % ", "percent", "45.00"), ("-3", "trim", "-3.00"), ("3\n", "trim", None),
    ("1-2", "noise", None),
])
def test_safe_decimal(spark, raw, strip, want):
    got = one(spark, text.safe_decimal("s", 20, 2, strip), "s string", (raw,))
    assert (None if got is None else str(got)) == want


def test_safe_decimal_out_of_range_is_null(spark):
    assert one(spark, text.safe_decimal("s", 4, 2), "s string", ("123456",)) is None
    assert one(spark, text.safe_int("s"), "s string", ("99999999999",)) is None


def test_coordinates(spark):
    assert str(one(spark, text.signed_coordinate("s", "S"), "s string", ("12.5 s",))) == "-12.50000000"
    assert str(one(spark, text.signed_coordinate("s", "S"), "s string", ("12.5 N",))) == "12.50000000"
    assert one(spark, text.signed_coordinate("s", "W"), "s string", ("west",)) is None


@pytest.mark.parametrize("parts, name, address", [
    (("A", "B", "C"), "A B C", "A, B, C"), ((" A ", "", None), "A", "A"), (("", "B", "C"), "B C", ", B, C"),
    ((None, " ", ""), None, ""),
])
def test_names_and_addresses(spark, parts, name, address):
    schema = "a string, b string, c string"
    assert one(spark, text.join_name("a", "b", "c"), schema, parts) == name
    assert one(spark, text.join_address("a", "b", "c"), schema, parts) == address


def test_flags(spark):
    for raw, yes, no in [("1", True, False), (" true", True, False), ("N", False, True), (None, None, True), ("x", False, False)]:
        assert one(spark, flags.truthy_text("s"), "s string", (raw,)) is yes
        assert one(spark, flags.null_or_no("s"), "s string", (raw,)) is no
    for raw, tri, two in [(1, True, True), (0, False, False), (2, None, False), (None, None, False)]:
        assert one(spark, flags.tri_state("s"), "s int", (raw,)) is tri
        assert one(spark, flags.two_state("s"), "s int", (raw,)) is two


# --- dates -------------------------------------------------------------------------------------------------

def test_fiscal_year_and_month_end():
    assert dates.fiscal_year_start(date(1998, 3, 31)) == date(1997, 4, 1)
    assert dates.fiscal_year_start(date(1998, 4, 1)) == date(1998, 4, 1)
    assert dates.snapshot_type(date(2024, 2, 29)) == "MONTH_END"
    assert dates.snapshot_type(date(2024, 2, 28)) == "CURRENT_DAY"
    assert dates.last_day_of_month(date(2023, 12, 5)) == date(2023, 12, 31)


def test_month_arithmetic(spark):
    d = "d date"
    assert one(spark, dates.add_months_eom("d", 1), d, (date(2024, 2, 29),)) == date(2024, 3, 31)
    assert one(spark, dates.add_months_eom("d", -1), d, (date(2024, 3, 30),)) == date(2024, 2, 29)
    assert one(spark, F.add_months("d", 1), d, (date(2024, 2, 29),)) == date(2024, 3, 29)


def test_month_of_no_month_is_null(spark):
    assert one(spark, dates.month_of("y", "m"), "y int, m int", (1998, 6)) == date(1998, 6, 1)
    assert one(spark, dates.month_of("y", "m"), "y int, m int", (1998, 13)) is None
    assert one(spark, dates.month_of("y", "m"), "y int, m int", (None, 1)) is None


def test_day_ranges(spark):
    rows = frame(spark, "t timestamp", (datetime(2024, 1, 31),), (datetime(2024, 1, 31, 23, 59, 59),), (datetime(2024, 2, 1),), (None,))
    assert values(rows.select(dates.on_day("t", date(2024, 1, 31)).alias("v")), "v") == [True, True, False, None]
    assert values(rows.select(dates.in_month_of("t", date(2024, 1, 5)).alias("v")), "v") == [True, True, False, None]


# --- numbers -----------------------------------------------------------------------------------------------

def test_ratios(spark):
    schema = "a double, b double"
    assert str(one(spark, numbers.percentage("a", "b"), schema, (1.0, 3.0))) == "33.33"
    assert one(spark, numbers.percentage("a", "b"), schema, (1.0, 0.0)) is None
    assert str(one(spark, numbers.percentage("a", "b"), schema, (None, 2.0))) == "0.00"
    assert one(spark, numbers.share("a", "b"), schema, (1.0, 0.0)) == 0.0
    assert one(spark, numbers.share("a", "b"), schema, (1.0, None)) is None
    assert one(spark, numbers.rate_of_positive("a", "b"), schema, (1.0, 0.0)) is None


def test_sums_of_nothing(spark):
    rows = frame(spark, "k int, v double", (1, None), (1, None))
    got = rows.groupBy("k").agg(numbers.money_sum("v").alias("m"), numbers.sum_if(F.col("v") > 0, "v").alias("z"),
                                numbers.sum_if_any(F.col("v") > 0, "v").alias("n"), numbers.any_true(F.col("v") > 0).alias("b")).first()
    assert (str(got.m), got.z, got.n, got.b) == ("0.00", 0.0, None, False)


# --- portfolio ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("days, label", [
    (None, None), (-1, None), (0, "0"), (1, "SMA-0"), (30, "SMA-0"), (31, "SMA-1"), (60, "SMA-1"), (61, "SMA-2"), (90, "SMA-2"),
    (91, "NPA (Sub-standard)"), (365, "NPA (Sub-standard)"), (366, "Doubtful 1 (D1)"), (730, "Doubtful 1 (D1)"),
    (731, "Doubtful 2 (D2)"), (1095, "Doubtful 2 (D2)"), (1096, "Doubtful 3 (D3)"), (5000, "Doubtful 3 (D3)"),
])
def test_dpd_bucket_edges(spark, days, label):
    assert one(spark, portfolio.dpd_bucket("d"), "d int", (days,)) == label


def test_pos_after_sell(spark):
    for sell, own, want in [(50.0, 20.0, 50), (0.0, 20.0, 20), (None, 20.0, 20), (None, None, 100), (2.5, None, 2.5)]:
        got = one(spark, portfolio.pos_after_sell("p", "s", "o"), "p double, s double, o double", (100.0, sell, own))
        assert float(got) == want


def test_staff_is_counted_once_per_employee(spark):
    rows = frame(spark, "employee_id int, base_branch_id int, is_active boolean, is_resigned string, designation_name string",
                 (1, 5, True, None, "fos"), (1, 5, True, None, "fos"), (2, 5, True, "0", "clerk"), (3, 5, True, "TRUE", "FOS"), (4, 5, False, None, "FOS"))
    assert tuple(portfolio.staff_count(rows).first()) == (5, 2, 1)


def test_activity_counts_loans_apart_from_statuses(spark):
    day = date(2024, 1, 5)
    stamp = datetime(2024, 1, 5, 10)
    ld = frame(spark, "loan_application_id int, branch_id int, login_date date, last_sanction_date timestamp, last_booked_date timestamp, last_disbursal_date timestamp",
               (1, 9, day, stamp, None, stamp), (2, 9, None, None, None, None))
    st_ = frame(spark, "loanapplicationid int, loanstatustypedetailid int, createdon timestamp, isactive int",
                (1, 1619, stamp, 1), (1, 1619, stamp, 1), (1, 5, stamp, 1), (2, 1619, stamp, 0))
    got = portfolio.branch_activity(ld, st_, day).first().asDict()
    assert got["total_loans_originated"] == 2 and got["total_logins"] == 1 and got["total_loans_disbursal_cancelled"] == 2


# --- loans and receipts ------------------------------------------------------------------------------------

def test_ordered_list_equals_plain_sort_for_a_hot_key(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).alias("k"), (F.col("id") * 7919 % 2003).alias("v"))
    got = {r.k: r.t for r in sequence.ordered_list(rows, "k", "v", "t", slices=8).collect()}
    want = {}
    for r in rows.collect():
        want.setdefault(r.k, []).append(r.v)
    assert got == {k: ",".join(map(str, sorted(v))) for k, v in want.items()}


def test_links_without_an_id_are_flagged_but_not_listed(spark):
    rows = frame(spark, "loanapplicationid int, linkedloanapplicationid int, isactive int", (1, None, 1), (2, 5, 1), (2, 3, 1), (3, 4, 0))
    got = {r.loanapplicationid: (r.is_link_loan, r.linked_loan_count, r.linked_loans) for r in loans.linked_loans(rows).collect()}
    assert got == {1: (True, 0, None), 2: (True, 2, "3,5")}


def test_loans_with_only_presented_payments_are_kept(spark):
    manual = frame(spark, "loanapplicationid int, statustypedetailid int, statusupdateddate timestamp, collectedamount double, collectedthroughtypedetailid long, draftreceiptid long, isactive int",
                   (1, 219, datetime(2024, 1, 2), 5.0, 1, 10, 1), (1, 219, datetime(2024, 1, 1), None, 2, 10, 1))
    shown = frame(spark, "loanapplicationid int, statustypedetailid int, statusdate timestamp, pdcachamount double, isactive int",
                  (2, 2066, datetime(2024, 1, 3), 7.5, 1), (1, 9, datetime(2024, 1, 9), 100.0, 1))
    types = frame(spark, TYPES, (2, "two", 1))
    got = {r.loanapplicationid: r for r in receipts.receipt_summary(manual, shown, types).collect()}
    assert float(got[2].total_receipt_amount) == 7.5 and got[2].receipt_count == 0 and got[2].last_paid_mode is None
    assert float(got[1].total_receipt_amount) == 5.0 and got[1].receipt_count == 1 and got[1].last_paid_mode == "two"


def test_npa_flag(spark):
    for linked, own, want in [(None, None, False), (" ", 0, False), ("5", 0, True), (None, 1, True)]:
        assert one(spark, receipts.npa_flag("l", "o"), "l string, o int", (linked, own)) is want


def test_overdue_edges(spark):
    for due, cleared, want in [(date(2024, 1, 4), None, True), (date(2024, 1, 5), 0, False), (date(2024, 1, 4), 1, False), (None, 0, False)]:
        assert one(spark, receipts.is_overdue("d", "c", date(2024, 1, 5)), "d date, c int", (due, cleared)) is want


def test_main_applicant_wins_over_a_newer_one(spark):
    rows = frame(spark, "loan_application_id int, is_main_applicant boolean, record_modified_at timestamp, entity_id int",
                 (1, True, datetime(2020, 1, 1), 7), (1, False, datetime(2024, 1, 1), 8), (2, False, datetime(2020, 1, 1), 9), (2, False, datetime(2021, 1, 1), 4))
    assert {r.loan_application_id: r.entity_id for r in customers.main_applicant(rows, ["entity_id"]).collect()} == {1: 7, 2: 4}


# --- signals and score -------------------------------------------------------------------------------------

@pytest.mark.parametrize("m, label", [
    ((0, 0, 0), "Stable"), ((0, 5, 0), "Improving"), ((0, None, 4), "Improving"), ((5, 0, 0), "Worsening"), ((9, 5, 1), "Worsening"),
    ((1, 5, 9), "Improving"), ((91, 91, 91), "Stable"), ((90, 90, 90), "Improving"), ((5, None, None), "Stable"), ((5, 9, 1), "Stable"),
    ((None, None, None), "Stable"), ((0, None, None), "Stable"),
])
def test_trend(spark, m, label):
    assert one(spark, signals.trend_label("a", "b", "c"), "a int, b int, c int", m) == label


def test_stress_reaches_all_loans_of_an_entity(spark):
    cust = frame(spark, "loan_application_id int, entity_id int, is_main_applicant boolean, record_modified_at timestamp",
                 *[(i, e, True, datetime(2020, 1, 1)) for i, e in ((1, 7), (2, 7), (3, 8), (4, None))])
    monthly = frame(spark, "loan_application_id int, max_dpd int", (1, 30), (3, 0), (4, 90))
    got = {r.loan_application_id: r.multi_loan_stress for r in signals.multi_loan_stress(cust, monthly).collect()}
    assert got == {1: True, 2: True, 3: False}


def loans_frame(spark, *rows):
    return frame(spark, "loan_application_id int, loanstatus_typedetail_id int", *rows)


MONTHLY = "loanapplicationid int, summaryyear int, summarymonth int, deliquencybktdetailid int, isactive int"


def test_bucket_flags_any_or_latest_month(spark):
    rows = frame(spark, MONTHLY, (1, 2024, 1, 2570, 1), (1, 2024, 2, 1, 1), (2, 2024, 2, 2571, 0), (3, 2024, 1, 2572, 1))
    ever = {r.loan_application_id: (r.in_sma1, r.in_sma2, r.in_sma1_or_worse) for r in signals.bucket_flags(rows).collect()}
    assert ever == {1: (True, False, True), 3: (False, False, True)}
    latest = {r.loan_application_id: r.in_sma1 for r in signals.bucket_flags(rows, latest_month_only=True).collect()}
    assert latest[1] is False


def test_missing_mandate_is_flagged(spark):
    buckets = signals.bucket_flags(frame(spark, MONTHLY, *[(i, 2024, 1, 2570, 1) for i in (1, 2, 3, 4)]))
    ld = loans_frame(spark, (1, 189), (2, 189), (3, 189), (4, 190))
    ach = frame(spark, "loanapplicationid int, registered int, registeredstatustypedetailid int, isactive int",
                (2, 1, 1991, 1), (3, 0, 5, 1), (2, 0, 5, 0))
    assert sorted(values(signals.ach_not_registered(ld, ach, buckets, date(2024, 6, 1)), "loan_application_id")) == [1, 3]


def test_non_starter_needs_both_first_dues_unpaid(spark):
    due = lambda loan, day, paid=None, cleared=None, amount=10.0: (loan, day, date(2024, 1, day), amount, paid, cleared, 1)
    schedule = frame(spark, "loanapplicationid int, payscheduleid int, duedate date, dueamount double, paymentreceiveddate date, clearenceflag int, isactive int",
                     due(1, 1), due(1, 2, cleared=0), due(1, 3, date(2024, 1, 3)), due(2, 1), due(2, 2, date(2024, 1, 2)), due(2, 3),
                     due(3, 1), due(4, 1), due(4, 2), due(5, 1), due(5, 2, amount=0.0), due(5, 3))
    la = frame(spark, "loanapplicationid int, statustypedetailid int, isactive int", (1, 189, 1), (2, 189, 1), (3, 189, 1), (4, 190, 1), (5, 189, 1))
    got = signals.unpaid_first_dues(schedule, la, date(2024, 2, 1))
    assert sorted(values(got, "loan_application_id")) == [1, 5]


def test_bounces_are_not_multiplied_by_due_status_rows(spark):
    ld = loans_frame(spark, (1, 189), (2, 189))
    charge = lambda loan, day: (loan, 1561, 1, datetime(2024, 4, day))
    charges = frame(spark, "loanapplicationid int, chargesfortypedetailid int, typedetailchargeid int, chargedate timestamp",
                    *[charge(1, d) for d in (1, 2)], *[charge(2, d) for d in (1, 2, 3, 4)])
    due = frame(spark, "loanapplicationid int, deliquencybktdetailid int", (1, 2570), (1, 2570), (2, 2570))
    assert values(signals.fiscal_year_bounces(ld, charges, due, date(2024, 6, 1)), "loan_application_id") == [2]
    assert values(signals.fiscal_year_bounces(ld, charges, due, date(2025, 6, 1)), "loan_application_id") == []


def test_consecutive_bounces(spark):
    rows = frame(spark, "k int, t int, bad boolean", (1, 1, True), (1, 2, False), (1, 3, True), (1, 4, True), (2, 1, True), (3, 1, True), (3, 2, False))
    got = {r.k: r.consecutive_bounces for r in signals.consecutive_bounces(rows, "k", ["t"], F.col("bad")).collect()}
    assert got == {1: 2, 2: 1}


FLAG_NAMES = list(scoring.FLAG_WEIGHTS)


@SLOW
@given(st.lists(st.tuples(st.sampled_from([None, "Stable", "Worsening", "Improving"]), *[st.one_of(st.none(), st.booleans())] * len(FLAG_NAMES)), min_size=1, max_size=30))
def test_score_is_bounded_and_graded(spark, rows):
    df = spark.createDataFrame(rows, "dpd_trend_direction string, " + ", ".join(f"{f} boolean" for f in FLAG_NAMES))
    got = df.withColumn("s", scoring.risk_score()).withColumn("g", scoring.risk_grade("s")).withColumn("i", scoring.indicator_text()).collect()
    for r in got:
        weight = {"Worsening": 20, "Stable": 10}.get(r.dpd_trend_direction, 0) + sum(w for f, w in scoring.FLAG_WEIGHTS.items() if r[f])
        assert r.s == min(100, weight) and r.g is not None and r.i is not None


@pytest.mark.parametrize("score, grade", [(0, "Green"), (25, "Green"), (26, "Amber"), (50, "Amber"), (51, "Red"), (75, "Red"), (76, "Critical"), (100, "Critical")])
def test_grade_edges(spark, score, grade):
    assert one(spark, scoring.risk_grade("s"), "s int", (score,)) == grade
    plain = one(spark, scoring.recommended_action("s", "n"), "s int, n boolean", (score, None))
    flagged = one(spark, scoring.recommended_action("s", "n"), "s int, n boolean", (score, True))
    assert flagged == plain + " Flag for collateral re-valuation."


def test_score_moves_against_an_earlier_month_end(spark):
    now = frame(spark, "loan_application_id int, ews_risk_score int", (1, 50), (2, 50), (3, 50), (4, 50))
    old = frame(spark, "loan_application_id int, ews_risk_score int, signal_date date, snapshot_type string",
                (1, 40, date(2024, 1, 31), "MONTH_END"), (1, 90, date(2023, 12, 31), "MONTH_END"), (2, 60, date(2024, 1, 31), "MONTH_END"),
                (3, 50, date(2024, 1, 31), "MONTH_END"), (3, 1, date(2024, 2, 29), "MONTH_END"), (4, 9, date(2024, 2, 10), "CURRENT_DAY"))
    got = {r.loan_application_id: (r.score_variance, r.score_trend) for r in scoring.with_score_trend(now, old, date(2024, 2, 29)).collect()}
    assert got == {1: (10, "WORSENING"), 2: (-10, "IMPROVING"), 3: (0, "STABLE"), 4: (None, "NEW")}


# --- sequences, backfill, history --------------------------------------------------------------------------

def test_global_sequence(spark):
    df = spark.range(500).select((F.col("id") * 37 % 501).alias("v"))
    got = sequence.global_sequence(df, "v", "n", start=10, partitions=5).orderBy("n").collect()
    assert [r.n for r in got] == list(range(11, 511))
    assert [r.v for r in got] == sorted(r.v for r in got)


def test_backfill_has_every_month_once(spark):
    branches = frame(spark, "b int", (1,), (2,))
    events = frame(spark, "b int, at timestamp, done date", (1, datetime(2024, 3, 31, 23), date(2024, 2, 1)), (1, datetime(2024, 3, 1), None), (1, datetime(2020, 1, 1), None))
    counts = backfill.monthly_counts(events, "b", {"starts": "at", "ends": "done"}, date(2024, 3, 15), 24, month="m")
    got = {(r.b, r.m): (r.starts, r.ends) for r in backfill.monthly_backfill(branches, "b", [counts], date(2024, 3, 15), month="m").collect()}
    assert len(got) == 50 and min(m for _, m in got) == date(2022, 3, 1)
    assert got[1, date(2024, 3, 1)] == (2, 0) and got[1, date(2024, 2, 1)] == (0, 1) and got[2, date(2024, 3, 1)] == (0, 0)


def test_retention_keeps_the_cutoff_day(spark):
    rows = frame(spark, "d date", (date(2023, 1, 14),), (date(2023, 1, 15),), (None,))
    assert sorted(values(history.retain(rows, "d", date(2024, 7, 15)), "d"), key=str) == [date(2023, 1, 15), None]


def test_latest_of_type(spark):
    rows = frame(spark, "t string, d date", ("C", date(2024, 1, 1)), ("C", date(2024, 1, 2)), ("M", date(2020, 1, 1)), (None, date(2019, 1, 1)))
    assert history.keep_latest_of_type(rows, "t", "C", "d").count() == 3
