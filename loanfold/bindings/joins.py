"""Joins."""

from pyspark.sql import functions as F

from ..operators.dedup import newest_per_key
from ..operators.history import new_rows
from ..operators.lookup import attach, decode, roll_up
from ..operators.receipts import attach_receipts, instalment_payments, receipts_union
from ..operators.sequence import month_series
from ..operators.signals import entity_stress
from ..operators.skew import join_to_unique, join_where_keyed
from .raw import AS_OF
from .registry import Inputs, query


@query("j1_left_join", "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0")
def _(t: Inputs):
    customers = t["customer"].filter("c_custkey % 2 = 0")
    return join_to_unique(t["orders"].select("o_orderkey", F.col("o_custkey").alias("c_custkey")),
                          customers.select("c_custkey", "c_name"), "c_custkey").select("o_orderkey", "c_name")


@query("j2_composite_left_join", """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, f.n AS returned FROM lineitem l
    LEFT JOIN (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) f
    ON f.l_orderkey = l.l_orderkey AND f.l_linenumber = l.l_linenumber""")
def _(t):
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    returned = lines.filter("l_returnflag = 'R'").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("returned"))
    return lines.drop("l_returnflag").join(returned, ["l_orderkey", "l_linenumber"], "left")


@query("j3_inner_join", "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0")
def _(t):
    rich = t["customer"].filter("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    orders = t["orders"].select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return join_to_unique(orders, rich, "c_custkey", "inner").select("o_orderkey", "c_mktsegment")


@query("j4_left_join_filtered_side", """
    SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (
        SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'
        QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o
    ON o.o_custkey = c_custkey AND o.o_orderkey % 2 = 0""")
def _(t):
    newest = newest_per_key(t["orders"].filter("o_orderstatus = 'F'"), "o_custkey", "o_orderdate", carry=["o_orderkey"])
    return attach(t["customer"].select("c_custkey"), newest.filter("o_orderkey % 2 = 0"), ("c_custkey", "o_custkey"),
                  {"o_orderkey": "o_orderkey"})


@query("j5_inner_join_residual", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND l_shipdate < o_orderdate + INTERVAL 30 DAY
    AND o_orderstatus = 'F'""")
def _(t):
    loans = t["orders"].filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate")
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    early = F.col("l_shipdate") < F.col("o_orderdate") + F.expr("interval 30 days")
    return lines.join(loans, lines["l_orderkey"] == loans["o_orderkey"]).filter(early).select("l_orderkey", "l_linenumber", "l_partkey")


@query("j6_code_decode", """
    SELECT o_orderkey, a.typedetaildescription AS category, b.typedetaildescription AS scheme, c.typedetaildescription AS interest
    FROM tblloanapplication l
    JOIN orders ON o_orderkey = l.loanapplicationid
    LEFT JOIN tbltypedetail a ON a.typedetailid = l.refinanceschemeid
    LEFT JOIN tbltypedetail b ON b.typedetailid = l.loanschemetypedetailid AND b.isactive = 1
    LEFT JOIN tbltypedetail c ON c.typedetailid = l.interesttypetypedetailid AND c.isactive = 1""")
def _(t):
    loans = t.raw["tblloanapplication"].select(F.col("loanapplicationid").alias("o_orderkey"), "refinanceschemeid",
                                               "loanschemetypedetailid", "interesttypetypedetailid")
    types = t.raw["tbltypedetail"]
    df = decode(loans, types, {"category": "refinanceschemeid"})
    df = decode(df, types, {"scheme": "loanschemetypedetailid", "interest": "interesttypetypedetailid"}, active_only=True)
    return df.select("o_orderkey", "category", "scheme", "interest")


@query("j7_snowflake_chain", """
    SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def _(t):
    return roll_up(
        t["supplier"].select("s_suppkey", "s_nationkey"),
        (t["nation"], ("s_nationkey", "n_nationkey"), {"n_name": "n_name", "n_regionkey": "n_regionkey"}),
        (t["region"], ("n_regionkey", "r_regionkey"), {"r_name": "r_name"}),
    ).select("s_suppkey", "n_name", "r_name")


@query("j8_two_roles", """
    SELECT l_orderkey, l_linenumber, l_partkey, b.n_name AS buyer_nation, s.n_name AS seller_nation FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN nation b ON b.n_nationkey = c_nationkey LEFT JOIN nation s ON s.n_nationkey = s_nationkey""")
def _(t):
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    lines = lines.join(t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    buyers = t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    lines = join_to_unique(lines, buyers, "o_custkey", "inner", counted=t["orders"].select("o_custkey"))
    sellers = t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    lines = join_to_unique(lines, sellers, "l_suppkey", "inner", counted=t["lineitem"].select("l_suppkey"))
    nation = t["nation"]
    lines = attach(lines, nation, ("c_nationkey", "n_nationkey"), {"buyer_nation": "n_name"})
    lines = attach(lines, nation, ("s_nationkey", "n_nationkey"), {"seller_nation": "n_name"})
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "buyer_nation", "seller_nation")


@query("j9_bridge_join", """
    SELECT u.userid, e.employeename, b.branchid FROM tbluser u JOIN tblemployee e ON e.entityid = u.entityid
    LEFT JOIN tbluserbranch b ON b.userid = u.userid WHERE u.isactive = 1""")
def _(t):
    users = t.raw["tbluser"].filter("isactive = 1").select("userid", "entityid")
    staff = t.raw["tblemployee"].select("entityid", "employeename")
    return users.join(staff, "entityid").join(t.raw["tbluserbranch"].select("userid", "branchid"), "userid", "left").select(
        "userid", "employeename", "branchid")


@query("j10_coalesced_key_join", """
    WITH paid AS (
        SELECT loanapplicationid, payscheduleid, paytype, COALESCE(presentationdetailid, receiptid) AS id
        FROM tblloanpaymentadjust WHERE isactive = 1 AND payscheduleid IS NOT NULL),
    got AS (
        SELECT presentationdetailid AS id, 'presentation' AS paytype, loanapplicationid, pdcachamount AS amount
        FROM tblloanapplicationpresentationdetail JOIN tblloanapplicationpresentationbatch USING (presentationid)
        WHERE tblloanapplicationpresentationdetail.isactive = 1 AND tblloanapplicationpresentationbatch.isactive = 1 AND statustypedetailid = 2066
        UNION ALL
        SELECT receiptid, 'manualreceipt', loanapplicationid, collectedamount FROM tblloanapplicationmanualreceipt
        WHERE isactive = 1 AND statustypedetailid = 219 AND feesfortypedetailid = 1861)
    SELECT s.loanapplicationid, s.payscheduleid, p.paytype, p.id, CAST(g.amount AS DOUBLE) AS collected_amount
    FROM tblloanapplicationpayschedule s JOIN paid p USING (loanapplicationid, payscheduleid)
    LEFT JOIN got g ON g.loanapplicationid = s.loanapplicationid AND g.paytype = p.paytype AND g.id = p.id
    WHERE s.isactive = 1 AND s.duedate <= DATE '1998-06-30'""")
def _(t):
    paid = instalment_payments(t.raw["tblloanapplicationpayschedule"], t.raw["tblloanpaymentadjust"], AS_OF).select(
        "loanapplicationid", "payscheduleid", "paytype", "id")
    got = receipts_union(t.raw["tblloanapplicationpresentationdetail"], t.raw["tblloanapplicationpresentationbatch"],
                         t.raw["tblloanapplicationmanualreceipt"], t.raw["tbltypedetail"])
    return attach_receipts(paid, got).select("loanapplicationid", "payscheduleid", "paytype", "id", "collected_amount")


@query("j11_filter_on_right_side", """
    SELECT o_orderkey, l_partkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linestatus = 'O' AND l_quantity > 40""")
def _(t):
    lines = t["lineitem"].filter("l_linestatus = 'O' and l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return t["orders"].select("o_orderkey").join(lines, "o_orderkey")


@query("j12_join_before_dedup", """
    SELECT loanapplicationid, loantechnicalfiringid, agencyid FROM tblloantechnicalfiring f WHERE isactive = 1 AND EXISTS (
        SELECT 1 FROM tblloantechnicalreportvetting v WHERE v.loanapplicationid = f.loanapplicationid
        AND v.loantechnicalfiringid = f.loantechnicalfiringid AND v.isactive = 1)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY loanapplicationid ORDER BY lastmodifiedon DESC NULLS LAST) = 1""")
def _(t):
    key = ["loanapplicationid", "loantechnicalfiringid"]
    vetted = t.raw["tblloantechnicalreportvetting"].filter("isactive = 1").select(*key)
    fired = t.raw["tblloantechnicalfiring"].filter("isactive = 1").join(vetted, key, "left_semi")
    return newest_per_key(fired, "loanapplicationid", "lastmodifiedon", carry=["loantechnicalfiringid", "agencyid"]).drop("lastmodifiedon")


@query("j13_month_spine_join", """
    SELECT n_nationkey, CAST(m AS DATE) AS snapshot_date FROM nation
    CROSS JOIN generate_series(DATE '1996-06-01', DATE '1998-06-01', INTERVAL 1 MONTH) AS g(m)""")
def _(t):
    return month_series(t["nation"].select("n_nationkey"), AS_OF, 24, "snapshot_date")


@query("j14_key_and_date_join", """
    SELECT o.o_custkey, o.o_orderdate, o.o_orderkey, b.n AS same_day FROM orders o
    LEFT JOIN (SELECT o_custkey, o_orderdate, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2) b
    ON b.o_custkey = o.o_custkey AND b.o_orderdate = o.o_orderdate""")
def _(t):
    orders = t["orders"].select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    active = orders.filter("o_orderstatus = 'F'").groupBy("o_custkey", "o_orderdate").agg(F.count(F.lit(1)).alias("same_day"))
    return orders.drop("o_orderstatus").join(active, ["o_custkey", "o_orderdate"], "left")


@query("j15_entity_self_join", """
    SELECT a.o_orderkey, MAX(b.o_totalprice) > 450000 AS any_large FROM orders a JOIN orders b ON b.o_custkey = a.o_custkey GROUP BY 1""")
def _(t):
    orders = t["orders"].select("o_orderkey", "o_custkey", (F.col("o_totalprice") - 450000).alias("over"))
    worst = orders.select("o_orderkey", "over")
    return entity_stress(orders.select("o_orderkey", "o_custkey"), worst, "o_orderkey", "o_custkey", "over").withColumnRenamed(
        "multi_loan_stress", "any_large")


@query("j16_linked_row_join", """
    SELECT a.o_orderkey, b.o_orderdate AS linked_date FROM orders a LEFT JOIN orders b ON b.o_orderkey = a.o_orderkey - a.o_orderkey % 3 AND a.o_orderkey % 3 <> 0""")
def _(t):
    orders = t["orders"]
    link = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") - F.col("o_orderkey") % 3)
    linked = orders.select(F.col("o_orderkey").alias("link"), F.col("o_orderdate").alias("linked_date"))
    return join_where_keyed(orders.select("o_orderkey", link.alias("link")), linked, "link").select("o_orderkey", "linked_date")


@query("j16_rarely_linked", """
    SELECT a.event_id, b.event_type AS linked_type FROM events a LEFT JOIN events b ON b.event_id = a.event_id // 20 AND a.event_id % 20 = 0""")
def _(t):
    """A link that 95 % of the rows lack."""
    events = t["events"]
    link = F.when(F.col("event_id") % 20 == 0, F.expr("event_id div 20"))
    linked = events.select(F.col("event_id").alias("link"), F.col("event_type").alias("linked_type"))
    return join_where_keyed(events.select("event_id", link.alias("link")), linked, "link").select("event_id", "linked_type")


@query("j17_anti_join", """
    SELECT event_id, user_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id AND p.event_type = e.event_type AND p.value > 100)""")
def _(t):
    return new_rows(t["events"].select("event_id", "user_id", "event_type"), t["events"].filter("value > 100"),
                    ["user_id", "event_type"]).select("event_id", "user_id")


@query("j18_latest_value", """
    SELECT c_custkey, (SELECT o_totalprice FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'
                       ORDER BY o_orderdate DESC, o_totalprice DESC LIMIT 1) AS last_price FROM customer""")
def _(t):
    newest = newest_per_key(t["orders"].filter("o_orderstatus = 'F'"), "o_custkey", "o_orderdate", carry=["o_totalprice"])
    return attach(t["customer"].select("c_custkey"), newest, ("c_custkey", "o_custkey"), {"last_price": "o_totalprice"})
