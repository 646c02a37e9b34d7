"""Aggregations, windows, sorts and set operations."""

from pyspark.sql import functions as F

from ..functions.dates import in_month_of
from ..functions.numbers import any_true, count_if, max_if, money_sum, percentage, rate_of_positive, share, sum_if, sum_if_any
from ..operators.dedup import (
    first_per_key, newest_as_columns, newest_per_key, one_per_key, preferred_per_key,
)
from ..operators.loans import check_flags
from ..operators.sequence import global_sequence, month_series, ordered_list
from ..operators.skew import with_group_value
from .raw import AS_OF
from .registry import Inputs, query


def _cents(c):
    return F.col(c).cast("decimal(18,2)")


@query("a1_count", "SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1")
def _(t: Inputs):
    return t["lineitem"].groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("a2_count_distinct", "SELECT l_suppkey, COUNT(DISTINCT l_orderkey) AS loans, COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def _(t):
    return t["lineitem"].groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("loans"), F.count_distinct("l_partkey").alias("parts"))


@query("a3_sum_min_max", """
    SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, MIN(o_orderdate) AS first_date,
           MAX(o_orderdate) AS last_date FROM orders GROUP BY 1""")
def _(t):
    return t["orders"].groupBy("o_custkey").agg(F.sum(_cents("o_totalprice")).alias("total"), F.min("o_orderdate").alias("first_date"),
                                                F.max("o_orderdate").alias("last_date"))


@query("a4_conditional_count", """
    SELECT l_orderkey, COUNT(*) FILTER (WHERE l_linestatus = 'O') AS open_rows,
           COUNT(*) FILTER (WHERE l_linestatus = 'O' AND l_shipdate > DATE '1998-06-30') AS to_come FROM lineitem GROUP BY 1""")
def _(t):
    is_open = F.col("l_linestatus") == "O"
    return t["lineitem"].groupBy("l_orderkey").agg(
        count_if(is_open).alias("open_rows"), count_if(is_open & (F.col("l_shipdate") > F.lit(AS_OF))).alias("to_come"))


@query("a5_conditional_sum_zero", """
    SELECT l_orderkey, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS unpaid
    FROM lineitem GROUP BY 1""")
def _(t):
    return t["lineitem"].groupBy("l_orderkey").agg(sum_if(F.col("l_returnflag") == "R", _cents("l_extendedprice")).alias("unpaid"))


@query("a6_conditional_sum_null", """
    SELECT l_orderkey, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 END) AS BIGINT) AS unpaid FROM lineitem GROUP BY 1""")
def _(t):
    return t["lineitem"].groupBy("l_orderkey").agg(sum_if_any(F.col("l_returnflag") == "R", F.lit(1)).alias("unpaid"))


@query("a7_conditional_max", """
    SELECT l_suppkey, MAX(l_extendedprice) FILTER (WHERE year(l_shipdate) = 1998 AND month(l_shipdate) = 6) AS this_month FROM lineitem GROUP BY 1""")
def _(t):
    return t["lineitem"].groupBy("l_suppkey").agg(max_if(in_month_of("l_shipdate", AS_OF), "l_extendedprice").alias("this_month"))


@query("a8_money_sum", """
    SELECT user_id, CAST(COALESCE(SUM(CASE WHEN event_id % 3 = 0 THEN 0.00 ELSE CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS total
    FROM events GROUP BY 1""")
def _(t):
    rows = t["events"].withColumn("amount", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return rows.groupBy("user_id").agg(money_sum("amount").alias("total"))


@query("a9_having_count", "SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1 HAVING COUNT(*) > 12")
def _(t):
    return t["events"].filter("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 12")


@query("a10_ordered_list", "SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS loans FROM orders GROUP BY 1")
def _(t):
    return ordered_list(t["orders"], "o_custkey", "o_orderkey", "loans")


@query("a11_any_true", "SELECT l_orderkey, MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 AS has_unpaid FROM lineitem GROUP BY 1")
def _(t):
    return t["lineitem"].groupBy("l_orderkey").agg(any_true(F.col("l_returnflag") == "R").alias("has_unpaid"))


@query("a12_existence_flag", """
    SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 50) AS has_large FROM orders""")
def _(t):
    large = t["lineitem"].filter("l_quantity >= 50").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("has_large", F.lit(True))
    return t["orders"].select("o_orderkey").join(large, "o_orderkey", "left").fillna(False, ["has_large"])


@query("a13_rank_pivot", """
    SELECT o_custkey, MAX(CASE WHEN rn = 1 THEN o_totalprice END) AS m1, MAX(CASE WHEN rn = 2 THEN o_totalprice END) AS m2,
           MAX(CASE WHEN rn = 3 THEN o_totalprice END) AS m3
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) GROUP BY 1""")
def _(t):
    return newest_as_columns(t["orders"], "o_custkey", "o_orderdate", "o_totalprice", ["m1", "m2", "m3"], ties=["o_orderkey"])


@query("a14_safe_percentage", """
    SELECT l_suppkey, ROUND(CAST(bad AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) * 100, 2) AS npa_pct FROM (
        SELECT l_suppkey, SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS bad,
               SUM(CASE WHEN l_suppkey % 5 = 0 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS total FROM lineitem GROUP BY 1)""")
def _(t):
    total = F.when(F.col("l_suppkey") % 5 == 0, 0).otherwise(_cents("l_extendedprice"))
    summed = t["lineitem"].groupBy("l_suppkey").agg(
        sum_if(F.col("l_returnflag") == "R", _cents("l_extendedprice")).alias("bad"), F.sum(total).alias("total"))
    return summed.select("l_suppkey", percentage("bad", "total").alias("npa_pct"))


@query("a15_guarded_ratio", """
    SELECT l_suppkey, CASE WHEN total = 0 THEN 0 ELSE CAST(part AS DOUBLE) / CAST(total AS DOUBLE) * 100 END AS efficiency_pct,
           CASE WHEN n > 0 THEN CAST(late AS DOUBLE) / CAST(n AS DOUBLE) * 100 END AS dpd_rate_pct FROM (
        SELECT l_suppkey, SUM(CASE WHEN l_suppkey % 5 = 0 THEN 0 ELSE l_quantity END) AS total, SUM(l_linenumber) AS part,
               COUNT(*) FILTER (WHERE l_suppkey % 7 <> 0) AS n, COUNT(*) FILTER (WHERE l_quantity > 25) AS late FROM lineitem GROUP BY 1)""")
def _(t):
    summed = t["lineitem"].groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_suppkey") % 5 == 0, 0).otherwise(F.col("l_quantity"))).alias("total"),
        F.sum("l_linenumber").alias("part"), count_if(F.col("l_suppkey") % 7 != 0).alias("n"),
        count_if(F.col("l_quantity") > 25).alias("late"))
    return summed.select("l_suppkey", share("part", "total").alias("efficiency_pct"), rate_of_positive("late", "n").alias("dpd_rate_pct"))


@query("a16_preaggregate_two_facts", """
    SELECT o_orderkey, COALESCE(n_lines, 0) AS n_lines, COALESCE(n_events, 0) AS n_events FROM orders
    LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    LEFT JOIN (SELECT user_id, COUNT(*) AS n_events FROM events GROUP BY 1) ON user_id = o_orderkey""")
def _(t):
    lines = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    events = t["events"].groupBy(F.col("user_id").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_events"))
    return t["orders"].select("o_orderkey").join(lines, "o_orderkey", "left").join(events, "o_orderkey", "left").fillna(0)


@query("a17_sum_of_nullable_terms", """
    SELECT l_suppkey, CAST(SUM(l_quantity + CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END) AS DOUBLE) AS arrears FROM lineitem GROUP BY 1""")
def _(t):
    extra = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber"))
    return t["lineitem"].groupBy("l_suppkey").agg(F.sum(F.col("l_quantity") + extra).alias("arrears"))


@query("a18_max_code_flags", """
    SELECT loanapplicationid, COALESCE(top <> 0, FALSE) AS tvr_overall_flag, COALESCE(top = 4, FALSE) AS tvr_flag_4,
           CASE WHEN top = 3 THEN 'Bribe' END AS tvr_flag_3bribe
    FROM (SELECT loanapplicationid, MAX(tvrchecklistid) AS top FROM tblloanapplicationtvrchecklist WHERE isactive = 1 GROUP BY 1)""")
def _(t):
    return check_flags(t.raw["tblloanapplicationtvrchecklist"])


@query("a19_separate_maxima", "SELECT user_id, MAX(event_type) AS last_mode, MAX(ts) AS last_date, MAX(value) AS last_amount FROM events GROUP BY 1")
def _(t):
    return t["events"].groupBy("user_id").agg(F.max("event_type").alias("last_mode"), F.max("ts").alias("last_date"),
                                              F.max("value").alias("last_amount"))


@query("a20_distinct_by_group", "SELECT l_orderkey, l_linenumber, MAX(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2")
def _(t):
    return one_per_key(t["lineitem"], ["l_orderkey", "l_linenumber"], ["l_partkey"])


_NEWEST = "ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)"


@query("w1_latest_per_key", f"SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders QUALIFY {_NEWEST} = 1")
def _(t):
    return newest_per_key(t["orders"], "o_custkey", "o_orderdate", carry=["o_orderkey", "o_totalprice"])


@query("w2_latest_per_composite_key", """
    SELECT user_id, event_type, ts, event_id, value FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1""")
def _(t):
    return newest_per_key(t["events"], ["user_id", "event_type"], "ts", carry=["event_id", "value"])


@query("w3_latest_then_join", f"""
    SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT o_custkey, o_orderkey, {_NEWEST} AS rn FROM orders) ON o_custkey = c_custkey AND rn = 1""")
def _(t):
    newest = newest_per_key(t["orders"], "o_custkey", "o_orderdate", carry=["o_orderkey"])
    loans = newest.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return t["customer"].select("c_custkey").join(loans, "c_custkey", "left")


@query("w4_tie_break", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def _(t):
    return newest_per_key(t["lineitem"], "l_orderkey", ["l_linenumber", "l_partkey"], carry=["l_suppkey"])


@query("w5_nulls_last", """
    SELECT o_custkey, d, o_orderkey FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END AS d FROM orders)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY d DESC NULLS LAST, o_orderkey DESC) = 1""")
def _(t):
    rows = t["orders"].select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate")).alias("d"))
    return newest_per_key(rows, "o_custkey", "d", carry=["o_orderkey"])


@query("w6_priority_order", """
    SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey
    ORDER BY CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END, o_orderdate DESC, o_orderkey DESC) = 1""")
def _(t):
    rows = t["orders"].select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return preferred_per_key(rows, "o_custkey", F.col("o_orderpriority") == "1-URGENT", "o_orderdate", ["o_orderkey"]).drop("o_orderdate")


@query("w7_newest_n", f"SELECT o_custkey, o_orderdate, o_orderkey, CAST({_NEWEST} AS INT) AS rn FROM orders QUALIFY rn <= 3")
def _(t):
    return newest_per_key(t["orders"], "o_custkey", "o_orderdate", carry=["o_orderkey"], n=3, rank_as="rn")


@query("w8_first_n", """
    SELECT o_custkey, o_orderdate, o_orderkey, CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INT) AS rn
    FROM orders QUALIFY rn <= 2""")
def _(t):
    return first_per_key(t["orders"].select("o_custkey", "o_orderdate", "o_orderkey"), "o_custkey", "o_orderdate", ["o_orderkey"], n=2, rank_as="rn")


@query("w9_qualify_form", """
    SELECT user_id, ts, value FROM events WHERE event_type = 'purchase' QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""")
def _(t):
    return newest_per_key(t["events"].filter("event_type = 'purchase'"), "user_id", "ts", carry=["value"])


@query("w10_global_sequence", "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS ews_id FROM orders")
def _(t):
    return global_sequence(t["orders"].select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "ews_id").drop("o_orderdate")


@query("w11_group_max", "SELECT event_id, MAX(ts) OVER (PARTITION BY user_id) AS last_ts FROM events")
def _(t):
    return with_group_value(t["events"].select("event_id", "user_id", "ts"), "user_id", F.max("ts"), "last_ts").select("event_id", "last_ts")


@query("t1_total_order", "SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def _(t):
    return t["supplier"].select("s_suppkey", "s_name", "s_acctbal").orderBy(F.col("s_acctbal").desc(), "s_suppkey")


@query("t2_top_one_subquery", """
    SELECT s_suppkey, (SELECT MAX(l_shipdate) FROM lineitem WHERE l_suppkey = s_suppkey) AS last_ship FROM supplier""")
def _(t):
    newest = newest_per_key(t["lineitem"].select("l_suppkey", "l_shipdate"), "l_suppkey", "l_shipdate", ties=[])
    return t["supplier"].select(F.col("s_suppkey").alias("l_suppkey")).join(newest, "l_suppkey", "left").select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_shipdate").alias("last_ship"))


@query("t3_top_k_per_key", """
    SELECT l_suppkey, l_orderkey, l_extendedprice FROM lineitem
    QUALIFY ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey DESC) <= 5""")
def _(t):
    return newest_per_key(t["lineitem"], "l_suppkey", "l_extendedprice", carry=["l_orderkey"], n=5)


@query("u1_union_all_tagged", """
    SELECT event_id AS id, user_id, value, 'presentation' AS paytype FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, user_id, value, 'manualreceipt' FROM events WHERE event_type = 'purchase'""")
def _(t):
    def part(kind, tag):
        return t["events"].filter(F.col("event_type") == kind).select(
            F.col("event_id").alias("id"), "user_id", "value", F.lit(tag).alias("paytype"))

    return part("click", "presentation").unionByName(part("purchase", "manualreceipt"))


@query("u2_month_spine", """
    SELECT c_custkey, CAST(m AS DATE) AS run_date FROM customer
    CROSS JOIN generate_series(DATE '1996-06-01', DATE '1998-06-01', INTERVAL 1 MONTH) AS g(m)""")
def _(t):
    return month_series(t["customer"].select("c_custkey"), AS_OF, 24, "run_date")
