"""Early-warning signals, score and history."""

from pyspark.sql import functions as F

from ..functions.dates import last_day_of_month, snapshot_type
from ..operators import scoring, signals
from .raw import AS_OF
from .registry import Inputs, query

TREND_CASE = """CASE WHEN m1 = 0 AND m2 = 0 AND m3 = 0 THEN 'Stable' WHEN m1 = 0 AND GREATEST(m2, m3) > 0 THEN 'Improving'
    WHEN m1 > 0 AND m2 = 0 AND m3 = 0 THEN 'Worsening' WHEN m1 > m2 AND m2 > m3 THEN 'Worsening' WHEN m1 < m2 AND m2 < m3 THEN 'Improving'
    WHEN m1 = m2 AND m2 = m3 THEN CASE WHEN m1 >= 91 THEN 'Stable' ELSE 'Improving' END ELSE 'Stable' END"""
TREND_SQL = f"""
    SELECT loan_application_id, {TREND_CASE} AS dpd_trend_direction FROM (
        SELECT loan_application_id, MAX(max_dpd) FILTER (WHERE rn = 1) AS m1, MAX(max_dpd) FILTER (WHERE rn = 2) AS m2, MAX(max_dpd) FILTER (WHERE rn = 3) AS m3
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY loan_application_id ORDER BY snapshot_date DESC, loan_monthly_id DESC) AS rn FROM slv_contract_perf_monthly)
        GROUP BY 1)"""


@query("c26_dpd_trend", TREND_SQL)
def _(t: Inputs):
    return signals.dpd_trend(t.raw["slv_contract_perf_monthly"], ties=["loan_monthly_id"])


@query("c26_value_trend", f"""
    SELECT user_id, {TREND_CASE} AS dpd_trend_direction FROM (
        SELECT user_id, MAX(value) FILTER (WHERE rn = 1) AS m1, MAX(value) FILTER (WHERE rn = 2) AS m2, MAX(value) FILTER (WHERE rn = 3) AS m3
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) GROUP BY 1)""")
def _(t):
    return signals.dpd_trend(t["events"], key="user_id", by="ts", value="value")


STRESS_SQL = """
    SELECT m.loan_application_id, MAX(worst) > 0 AS multi_loan_stress FROM (
        SELECT loan_application_id, entity_id FROM slv_customer
        QUALIFY ROW_NUMBER() OVER (PARTITION BY loan_application_id ORDER BY CASE WHEN is_main_applicant THEN 0 ELSE 1 END, record_modified_at DESC) = 1) m
    JOIN (SELECT entity_id, MAX(max_dpd) AS worst FROM (
              SELECT loan_application_id, entity_id FROM slv_customer
              QUALIFY ROW_NUMBER() OVER (PARTITION BY loan_application_id ORDER BY CASE WHEN is_main_applicant THEN 0 ELSE 1 END, record_modified_at DESC) = 1)
          JOIN slv_contract_perf_monthly USING (loan_application_id) GROUP BY 1) e ON e.entity_id = m.entity_id GROUP BY 1"""


@query("c27_multi_loan_stress", STRESS_SQL)
def _(t):
    return signals.multi_loan_stress(t.raw["slv_customer"], t.raw["slv_contract_perf_monthly"])


AREA_SQL = "SELECT loan_application_id, COALESCE(bool_or(is_negative_area), FALSE) AS negative_area_flag FROM slv_asset GROUP BY 1"


@query("c28_negative_area", AREA_SQL)
def _(t):
    return signals.negative_area_flag(t.raw["slv_asset"])


def _in_bucket(codes: str) -> str:
    return f"(SELECT loanapplicationid FROM tblloanmonthly WHERE isactive = 1 AND deliquencybktdetailid IN ({codes}))"


NON_STARTER_SQL = f"""
    SELECT loanapplicationid AS loan_application_id, TRUE AS non_starter_sma1_flag FROM (
        SELECT * FROM tblloanapplicationpayschedule WHERE isactive = 1 AND dueamount > 0 AND duedate < DATE '1998-06-30'
        AND loanapplicationid IN (SELECT loanapplicationid FROM tblloanapplication WHERE isactive = 1 AND statustypedetailid = 189)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY loanapplicationid ORDER BY duedate, payscheduleid) <= 2)
    WHERE loanapplicationid IN {_in_bucket("2570, 2571, 2572")}
    GROUP BY 1 HAVING COUNT(*) FILTER (WHERE paymentreceiveddate IS NULL AND COALESCE(clearenceflag, 0) = 0) = 2"""


def _buckets(t):
    return signals.bucket_flags(t.raw["tblloanmonthly"])


@query("c29_non_starter", NON_STARTER_SQL)
def _(t):
    return signals.non_starter(t.raw["tblloanapplicationpayschedule"], t.raw["tblloanapplication"], _buckets(t), AS_OF)


SMA2_SQL = f"""SELECT loan_application_id, TRUE AS active_sma2_flag FROM slv_loan_details
    WHERE loanstatus_typedetail_id = 189 AND loan_application_id IN {_in_bucket("2571")}"""


@query("c30_active_sma2", SMA2_SQL)
def _(t):
    return signals.active_sma2(t.raw["slv_loan_details"], _buckets(t), AS_OF)


ACH_SQL = f"""
    SELECT DISTINCT loan_application_id, TRUE AS ach_not_registered_sma1_flag FROM slv_loan_details
    LEFT JOIN (SELECT * FROM tblloanapplicationach WHERE isactive = 1) a ON a.loanapplicationid = loan_application_id
    WHERE loanstatus_typedetail_id = 189 AND COALESCE(registered, 0) = 0 AND COALESCE(registeredstatustypedetailid, 0) <> 1991
    AND loan_application_id IN {_in_bucket("2570, 2571, 2572")}"""


@query("c31_ach_not_registered", ACH_SQL)
def _(t):
    return signals.ach_not_registered(t.raw["slv_loan_details"], t.raw["tblloanapplicationach"], _buckets(t), AS_OF)


CONSTRUCTION_SQL = f"""
    SELECT loan_application_id, TRUE AS construction_delay_sma1_flag FROM slv_loan_details WHERE loanstatus_typedetail_id = 189 AND loan_purpose_id IN (16, 1, 5)
    AND first_disbursal_date <= DATE '1996-12-31' AND COALESCE(is_actually_fully_disbursed, 0) = 0 AND loan_application_id IN {_in_bucket("2570")}"""


@query("c32_construction_delay", CONSTRUCTION_SQL)
def _(t):
    return signals.construction_delay(t.raw["slv_loan_details"], _buckets(t), AS_OF)


TITLE_SQL = """
    SELECT loan_application_id, TRUE AS title_doc_delay_flag FROM slv_loan_details WHERE loanstatus_typedetail_id = 189 AND first_disbursal_date <= DATE '1998-03-31'
    AND EXISTS (SELECT 1 FROM tblloanlegaldocuments WHERE loanapplicationid = loan_application_id AND documentid IN (1, 3, 16, 70, 81, 118, 130, 209)
                AND documentcategorydetailid = 3256 AND documenttypedetailid = 1957 AND COALESCE(documentstatustypedetailid, 0) NOT IN (1948, 1949, 1951))"""


@query("c33_title_doc_delay", TITLE_SQL)
def _(t):
    return signals.title_doc_delay(t.raw["slv_loan_details"], t.raw["tblloanlegaldocuments"], AS_OF)


BOUNCE_SQL = """
    SELECT loan_application_id, TRUE AS bounce_fy_sma1_flag FROM slv_loan_details WHERE loanstatus_typedetail_id = 189
    AND loan_application_id IN (SELECT loanapplicationid FROM tblloanduestatus WHERE deliquencybktdetailid = 2570)
    AND loan_application_id IN (SELECT loanapplicationid FROM tblloanapplicationchargedetails WHERE chargesfortypedetailid = 1561 AND typedetailchargeid = 1
                                AND chargedate >= DATE '1998-04-01' GROUP BY 1 HAVING COUNT(*) > 3)"""


@query("c34_fiscal_year_bounces", BOUNCE_SQL)
def _(t):
    return signals.fiscal_year_bounces(t.raw["slv_loan_details"], t.raw["tblloanapplicationchargedetails"], t.raw["tblloanduestatus"], AS_OF)


@query("c34_period_bounces", """
    SELECT user_id FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1 HAVING COUNT(*) > 3""")
def _(t):
    late = t["events"].filter("event_type = 'error' and ts >= timestamp_ntz '2024-01-15 00:00:00'")
    return late.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > signals.BOUNCES_ALLOWED).select("user_id")


# Flags of every kind on each lineitem, for the score itself.
_FLAGS_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE l_partkey % 4 WHEN 0 THEN 'Worsening' WHEN 1 THEN 'Stable' WHEN 2 THEN 'Improving' END AS dpd_trend_direction,
    l_suppkey % 2 = 0 AS high_foir_flag, l_linenumber % 2 = 0 AS multi_loan_stress, l_returnflag = 'R' AS non_starter_sma1_flag,
    l_linestatus = 'O' AS active_sma2_flag, l_quantity > 20 AS ach_not_registered_sma1_flag, l_quantity > 35 AS construction_delay_sma1_flag,
    l_suppkey % 3 = 0 AS title_doc_delay_flag, l_discount > 0.05 AS bounce_fy_sma1_flag,
    CASE WHEN l_partkey % 3 <> 0 THEN l_tax > 0.03 END AS negative_area_flag FROM lineitem"""
SCORE_SQL = """LEAST(100, CASE dpd_trend_direction WHEN 'Worsening' THEN 20 WHEN 'Stable' THEN 10 ELSE 0 END + high_foir_flag::INT * 10 + multi_loan_stress::INT * 10
    + non_starter_sma1_flag::INT * 15 + active_sma2_flag::INT * 15 + ach_not_registered_sma1_flag::INT * 10 + construction_delay_sma1_flag::INT * 10
    + title_doc_delay_flag::INT * 5 + bounce_fy_sma1_flag::INT * 15)"""
GRADE_SQL = "CASE WHEN ews_risk_score <= 25 THEN 'Green' WHEN ews_risk_score <= 50 THEN 'Amber' WHEN ews_risk_score <= 75 THEN 'Red' ELSE 'Critical' END"
ACTION_SQL = """CASE WHEN ews_risk_score > 75 THEN 'Immediate field visit required. Initiate legal notice and NPA provisioning review.'
    WHEN ews_risk_score > 50 THEN 'Telephonic follow-up. Evaluate OTS or restructuring options.'
    WHEN ews_risk_score > 25 THEN 'Monitor closely. Send payment reminder communication.' ELSE 'No action required. Standard monitoring applies.' END
    || CASE WHEN negative_area_flag THEN ' Flag for collateral re-valuation.' ELSE '' END"""
INDICATOR_SQL = """TRIM(CASE WHEN non_starter_sma1_flag THEN 'NON_STARTER; & SMA1 OR ABOVE' ELSE '' END || CASE WHEN active_sma2_flag THEN 'ACTIVE & ACTIVE_SMA2;' ELSE '' END
    || CASE WHEN ach_not_registered_sma1_flag THEN 'ACH_NOT_REGISTERED; 7 SMA1 AND ABOVE ' ELSE '' END
    || CASE WHEN construction_delay_sma1_flag THEN 'CONSTRUCTION_DELAY_18M; & SMA1' ELSE '' END
    || CASE WHEN title_doc_delay_flag THEN 'TITLE_DOC_DELAY_3M; $ DELAY FOR MORE THAN = 3 MONTHS' ELSE '' END
    || CASE WHEN bounce_fy_sma1_flag THEN 'BOUNCE_FY_3PLUS;  &  SMA1 ' ELSE '' END || CASE WHEN high_foir_flag THEN 'HIGH_FOIR;' ELSE '' END
    || CASE WHEN multi_loan_stress THEN 'MULTI_LOAN_STRESS;' ELSE '' END || CASE WHEN dpd_trend_direction = 'Worsening' THEN 'DPD_WORSENING;' ELSE '' END)"""
_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_KEY_SQL = ", ".join(_KEY)


def _flagged(t: Inputs):
    c, k = F.col, F.col("l_partkey")
    return t["lineitem"].select(
        *_KEY, F.when(k % 4 == 0, "Worsening").when(k % 4 == 1, "Stable").when(k % 4 == 2, "Improving").alias("dpd_trend_direction"),
        (c("l_suppkey") % 2 == 0).alias("high_foir_flag"), (c("l_linenumber") % 2 == 0).alias("multi_loan_stress"),
        (c("l_returnflag") == "R").alias("non_starter_sma1_flag"), (c("l_linestatus") == "O").alias("active_sma2_flag"),
        (c("l_quantity") > 20).alias("ach_not_registered_sma1_flag"), (c("l_quantity") > 35).alias("construction_delay_sma1_flag"),
        (c("l_suppkey") % 3 == 0).alias("title_doc_delay_flag"), (c("l_discount") > 0.05).alias("bounce_fy_sma1_flag"),
        F.when(k % 3 != 0, c("l_tax") > 0.03).alias("negative_area_flag")).withColumn("ews_risk_score", scoring.risk_score())


_SCORED_SQL = f"SELECT *, {SCORE_SQL} AS ews_risk_score FROM ({_FLAGS_SQL})"


@query("c35_risk_score", f"SELECT {_KEY_SQL}, ews_risk_score FROM ({_SCORED_SQL})")
def _(t):
    return _flagged(t).select(*_KEY, "ews_risk_score")


@query("c36_risk_grade", f"SELECT {_KEY_SQL}, {GRADE_SQL} AS ews_risk_grade FROM ({_SCORED_SQL})")
def _(t):
    return _flagged(t).select(*_KEY, scoring.risk_grade("ews_risk_score").alias("ews_risk_grade"))


@query("c37_recommended_action", f"SELECT {_KEY_SQL}, {ACTION_SQL} AS recommended_action FROM ({_SCORED_SQL})")
def _(t):
    return _flagged(t).select(*_KEY, scoring.recommended_action("ews_risk_score", "negative_area_flag").alias("recommended_action"))


@query("c38_indicator_text", f"SELECT {_KEY_SQL}, {INDICATOR_SQL} AS ews_indicators FROM ({_SCORED_SQL})")
def _(t):
    return _flagged(t).select(*_KEY, scoring.indicator_text().alias("ews_indicators"))


PREVIOUS_SQL = """SELECT CAST(loan_application_id AS BIGINT) AS loan_application_id, ews_risk_score AS previous FROM slv_early_warning
    WHERE snapshot_type = 'MONTH_END' AND signal_date < DATE '1998-06-30'
    QUALIFY ROW_NUMBER() OVER (PARTITION BY loan_application_id ORDER BY signal_date DESC) = 1"""
TREND_OF_SCORE_SQL = """CASE WHEN previous IS NULL THEN 'NEW' WHEN ews_risk_score > previous THEN 'WORSENING' WHEN ews_risk_score < previous THEN 'IMPROVING' ELSE 'STABLE' END"""


@query("c39_score_trend", f"""
    SELECT loan_application_id, ews_risk_score, previous AS previous_month_ews_score, ews_risk_score - previous AS score_variance, {TREND_OF_SCORE_SQL} AS score_trend
    FROM (SELECT o_orderkey AS loan_application_id, CAST(o_custkey % 50 AS INT) AS ews_risk_score FROM orders) LEFT JOIN ({PREVIOUS_SQL}) USING (loan_application_id)""")
def _(t):
    scored = t["orders"].select(F.col("o_orderkey").alias("loan_application_id"), (F.col("o_custkey") % 50).cast("int").alias("ews_risk_score"))
    history = t.raw["slv_early_warning"].withColumn("loan_application_id", F.col("loan_application_id").cast("bigint"))
    return scoring.with_score_trend(scored, history, AS_OF)


@query("c40_snapshot_type", """
    SELECT o_orderkey, CASE WHEN DATE '1998-06-30' = last_day(DATE '1998-06-30') THEN 'MONTH_END' ELSE 'CURRENT_DAY' END AS run_type,
           last_day(DATE '1998-06-30') AS snapshot_month, CASE WHEN last_day(o_orderdate) = CAST(o_orderdate AS DATE) THEN 'MONTH_END' ELSE 'CURRENT_DAY' END AS order_type
    FROM orders""")
def _(t):
    day = F.to_date("o_orderdate")
    return t["orders"].select("o_orderkey", F.lit(snapshot_type(AS_OF)).alias("run_type"), F.lit(last_day_of_month(AS_OF)).alias("snapshot_month"),
                              F.when(F.last_day(day) == day, "MONTH_END").otherwise("CURRENT_DAY").alias("order_type"))


@query("c45_consecutive_bounces", """
    SELECT e.user_id, COUNT(*) AS consecutive_bounces FROM events e
    LEFT JOIN (SELECT user_id, MAX(ts) AS cleared FROM events WHERE event_type = 'purchase' GROUP BY 1) p ON p.user_id = e.user_id
    WHERE e.event_type = 'error' AND (cleared IS NULL OR e.ts > cleared) GROUP BY 1""")
def _(t):
    rows = t["events"].filter(F.col("event_type").isin("error", "purchase"))
    return signals.consecutive_bounces(rows, "user_id", ["ts", "event_id"], F.col("event_type") == "error")
