"""Scalar functions."""

from datetime import date

from pyspark.sql import functions as F

from ..functions import dates, flags, text
from ..operators.portfolio import pos_after_sell
from ..sources.sinks import audit_stamp
from .raw import AS_OF, RUN_TS
from .registry import Inputs, query

# Names with blanks and gaps, made from customer rows.
_NAME_SQL = """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE ' ' || c_mktsegment END AS a,
    CASE c_custkey % 3 WHEN 0 THEN 'Mid ' WHEN 1 THEN '' END AS b, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS c FROM customer"""


def _names(t: Inputs):
    k = F.col("c_custkey")
    return t["customer"].select(
        "c_custkey",
        F.when(k % 4 == 0, "  ").when(k % 4 > 1, F.concat(F.lit(" "), "c_mktsegment")).alias("a"),
        F.when(k % 3 == 0, "Mid ").when(k % 3 == 1, "").alias("b"),
        F.when(k % 5 != 0, F.col("c_name")).alias("c"))


@query("f1_trim_upper", f"SELECT c_custkey, TRIM(a) AS trimmed, UPPER(b) AS upper_case, UPPER(TRIM(a)) AS clean FROM ({_NAME_SQL})")
def _(t):
    return _names(t).select("c_custkey", text.trimmed("a").alias("trimmed"), F.upper("b").alias("upper_case"),
                            text.upper_trimmed("a").alias("clean"))


@query("f2_blank_to_null", f"SELECT c_custkey, NULLIF(TRIM(a), '') AS a, NULLIF(TRIM(b), '') AS b FROM ({_NAME_SQL})")
def _(t):
    return _names(t).select("c_custkey", text.blank_to_null("a").alias("a"), text.blank_to_null("b").alias("b"))


@query("f3_concat", f"SELECT c_custkey, a || '_' || c AS label FROM ({_NAME_SQL})")
def _(t):
    return _names(t).select("c_custkey", F.concat("a", F.lit("_"), "c").alias("label"))


@query("f4_join_name", f"""
    SELECT c_custkey, NULLIF(array_to_string(list_filter([TRIM(a), TRIM(b), TRIM(c)], lambda x: x IS NOT NULL AND x <> ''), ' '), '') AS full_name
    FROM ({_NAME_SQL})""")
def _(t):
    return _names(t).select("c_custkey", text.join_name("a", "b", "c").alias("full_name"))


@query("f5_join_address", f"""
    SELECT c_custkey, TRIM(COALESCE(TRIM(a), '') || CASE WHEN COALESCE(TRIM(b), '') = '' THEN '' ELSE ', ' || TRIM(b) END
           || CASE WHEN COALESCE(TRIM(c), '') = '' THEN '' ELSE ', ' || TRIM(c) END) AS address FROM ({_NAME_SQL})""")
def _(t):
    return _names(t).select("c_custkey", text.join_address("a", "b", "c").alias("address"))


@query("f6_lpad", "SELECT o_orderkey, LPAD(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS mm FROM orders")
def _(t):
    return t["orders"].select("o_orderkey", F.lpad(F.month("o_orderdate").cast("string"), 2, "0").alias("mm"))


@query("f7_replace", "SELECT p_partkey, TRIM(REPLACE(CAST(p_size AS VARCHAR) || ' %', '%', '')) AS pct FROM part")
def _(t):
    return t["part"].select("p_partkey", text.strip_percent(F.concat(F.col("p_size").cast("string"), F.lit(" %"))).alias("pct"))


@query("f8_regexp_replace", "SELECT p_partkey, regexp_replace(p_brand || '.5 (' || p_name || ')', '[^0-9.\\-]', '', 'g') AS digits FROM part")
def _(t):
    noisy = F.concat("p_brand", F.lit(".5 ("), "p_name", F.lit(")"))
    return t["part"].select("p_partkey", text.strip_noise(noisy).alias("digits"))


@query("f9_regex_match", "SELECT p_partkey, p_brand, regexp_matches(p_brand, '[12][0-9]*$') AS low_brand FROM part")
def _(t):
    return t["part"].select("p_partkey", "p_brand", F.col("p_brand").rlike("[12][0-9]*$").alias("low_brand"))


@query("f10_ilike", "SELECT p_partkey, p_name ILIKE '%S%' AS has_s, p_type ILIKE '%w%' AS has_w FROM part")
def _(t):
    return t["part"].select("p_partkey", F.col("p_name").ilike("%S%").alias("has_s"), F.col("p_type").ilike("%w%").alias("has_w"))


@query("f11_coalesce", f"SELECT c_custkey, COALESCE(c, a, b, 'none') AS label, COALESCE(CASE WHEN c_custkey % 2 = 0 THEN c_custkey END, 100) AS pct FROM ({_NAME_SQL})")
def _(t):
    pct = F.coalesce(F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")), F.lit(100))
    return _names(t).select("c_custkey", F.coalesce("c", "a", "b", F.lit("none")).alias("label"), pct.alias("pct"))


@query("f12_greatest_dates", """
    SELECT o_orderkey, GREATEST(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END,
                                CASE WHEN o_orderkey % 2 = 0 THEN TIMESTAMP '1998-06-30 00:00:00' END) AS last_paid_date FROM orders""")
def _(t):
    k = F.col("o_orderkey")
    run = F.lit(AS_OF).cast("timestamp_ntz")
    return t["orders"].select("o_orderkey", F.greatest(F.when(k % 3 != 0, F.col("o_orderdate")), F.when(k % 2 == 0, run)).alias("last_paid_date"))


@query("f13_least", "SELECT l_orderkey, l_linenumber, l_partkey, LEAST(CAST(l_quantity AS INT) * 3, 100) AS score FROM lineitem")
def _(t):
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", F.least(F.col("l_quantity").cast("int") * 3, F.lit(100)).alias("score"))


@query("f14_round", "SELECT l_orderkey, l_partkey, CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS price FROM lineitem")
def _(t):
    return t["lineitem"].select("l_orderkey", "l_partkey", F.round(F.col("l_extendedprice").cast("decimal(18,2)"), 1).alias("price"))


@query("f15_run_date", """
    SELECT o_orderkey, DATE '1998-06-30' AS run_date, TIMESTAMP '1998-06-30 18:30:15' AS silver_loaded_at,
           '19980630_183015' AS silver_batch_id FROM orders""")
def _(t):
    return audit_stamp(t["orders"].select("o_orderkey", F.lit(AS_OF).alias("run_date")), RUN_TS)


@query("f16_to_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _(t):
    return t["events"].select("event_id", F.to_date("ts").alias("day"))


@query("f17_days_between", "SELECT l_orderkey, l_partkey, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def _(t):
    loans = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return t["lineitem"].select("l_orderkey", "l_partkey", "l_shipdate").join(loans, "l_orderkey").select(
        "l_orderkey", "l_partkey", dates.days_between("l_shipdate", "o_orderdate").cast("bigint").alias("days"))


@query("f18_same_month", "SELECT o_orderkey, date_trunc('month', o_orderdate) = DATE '1998-06-01' AS this_month, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders")
def _(t):
    return t["orders"].select("o_orderkey", dates.in_month_of("o_orderdate", AS_OF).alias("this_month"), dates.month_start("o_orderdate").alias("month"))


@query("f19_last_day", "SELECT o_orderkey, last_day(o_orderdate) AS month_end, last_day(o_orderdate) = CAST(o_orderdate AS DATE) AS is_month_end FROM orders")
def _(t):
    end = F.last_day("o_orderdate")
    return t["orders"].select("o_orderkey", end.alias("month_end"), (end == F.to_date("o_orderdate")).alias("is_month_end"))


@query("f20_add_months", """
    SELECT o_orderkey, CAST(d - INTERVAL 18 MONTH AS DATE) AS plain,
           CASE WHEN d = last_day(d) THEN last_day(CAST(d - INTERVAL 3 MONTH AS DATE)) ELSE CAST(d - INTERVAL 3 MONTH AS DATE) END AS month_end_kept
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def _(t):
    rows = t["orders"].select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return rows.select("o_orderkey", F.add_months("d", -18).alias("plain"), dates.add_months_eom("d", -3).alias("month_end_kept"))


@query("f21_dateadd", "SELECT o_orderkey, CAST(o_orderdate + INTERVAL 7 MONTH AS DATE) AS later FROM orders")
def _(t):
    return t["orders"].select("o_orderkey", F.add_months("o_orderdate", 7).alias("later"))


@query("f22_fiscal_year", """
    SELECT o_orderkey, CAST(month(o_orderdate) AS INT) AS month, o_orderdate >= DATE '1998-04-01' AS this_year,
           o_orderdate >= DATE '1997-04-01' AS from_last_year FROM orders""")
def _(t):
    d = F.col("o_orderdate")
    return t["orders"].select("o_orderkey", F.month(d).alias("month"), (d >= F.lit(dates.fiscal_year_start(AS_OF))).alias("this_year"),
                              (d >= F.lit(dates.fiscal_year_start(date(1998, 3, 31)))).alias("from_last_year"))


@query("f23_month_of", "SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS snapshot_date FROM orders")
def _(t):
    return t["orders"].select("o_orderkey", dates.month_of(F.year("o_orderdate"), F.month("o_orderdate")).alias("snapshot_date"))


@query("f24_batch_text", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS batch FROM events")
def _(t):
    return t["events"].select("event_id", F.date_format("ts", "yyyyMMdd'_'HHmmss").alias("batch"))


@query("f25_year_month", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INT) AS yyyymm FROM orders")
def _(t):
    return t["orders"].select("o_orderkey", dates.year_month("o_orderdate").alias("yyyymm"))


_FLAG_SQL = "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 2 END AS flag FROM events"


def _flags(t: Inputs):
    m = F.col("event_id") % 4
    return t["events"].select("event_id", F.when(m == 0, 1).when(m == 1, 0).when(m == 2, 2).alias("flag"))


@query("f26_tri_state", f"SELECT event_id, CASE flag WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS state FROM ({_FLAG_SQL})")
def _(t):
    return _flags(t).select("event_id", flags.tri_state("flag").alias("state"))


@query("f27_two_state", f"SELECT event_id, COALESCE(flag = 1, FALSE) AS state FROM ({_FLAG_SQL})")
def _(t):
    return _flags(t).select("event_id", flags.two_state("flag").alias("state"))


@query("f28_presence", f"SELECT event_id, flag IS NOT NULL AS known FROM ({_FLAG_SQL})")
def _(t):
    return _flags(t).select("event_id", flags.present("flag").alias("known"))


@query("f29_yes_no", f"SELECT event_id, CASE flag WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS answer FROM ({_FLAG_SQL})")
def _(t):
    return _flags(t).select("event_id", flags.yes_no("flag").alias("answer"))


@query("f30_label_override", f"SELECT event_id, CASE WHEN flag = 1 THEN 'Self' ELSE event_type END AS relation FROM ({_FLAG_SQL}) JOIN events USING (event_id)")
def _(t):
    kinds = t["events"].select("event_id", "event_type")
    rows = _flags(t).join(kinds, "event_id")
    return rows.select("event_id", F.when(flags.two_state("flag"), "Self").otherwise(F.col("event_type")).alias("relation"))


@query("f31_casts", """
    SELECT l_orderkey, l_partkey, CAST(l_orderkey AS INT) AS as_int, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS as_decimal,
           CAST(l_suppkey AS VARCHAR) AS as_text, TRY_CAST(l_returnflag AS INT) AS no_number, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS as_timestamp
    FROM lineitem""")
def _(t):
    return t["lineitem"].select(
        "l_orderkey", "l_partkey", F.col("l_orderkey").cast("int").alias("as_int"), F.col("l_extendedprice").cast("decimal(18,2)").alias("as_decimal"),
        F.col("l_suppkey").cast("string").alias("as_text"), text.safe_int("l_returnflag").alias("no_number"),
        F.to_date("l_shipdate").cast("timestamp_ntz").alias("as_timestamp"))


@query("f32_fallback_factor", """
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * (CASE WHEN sell IS NULL OR sell = 0 THEN COALESCE(own, 100) ELSE sell END) * 0.01 AS DOUBLE) AS pos
    FROM (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 4 * 25 - 25 END AS sell,
                 CASE WHEN o_orderkey % 3 <> 0 THEN 40 END AS own FROM orders)""")
def _(t):
    k = F.col("o_orderkey")
    rows = t["orders"].select("o_orderkey", "o_totalprice", F.when(k % 4 != 0, k % 4 * 25 - 25).alias("sell"), F.when(k % 3 != 0, 40).alias("own"))
    return rows.select("o_orderkey", pos_after_sell("o_totalprice", "sell", "own").alias("pos"))
