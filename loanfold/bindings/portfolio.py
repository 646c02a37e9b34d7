"""Cleansing, customers, portfolio, loans and receipts."""

from pyspark.sql import functions as F

from ..functions.text import has_address, prefer, safe_decimal, safe_int, signed_coordinate
from ..operators import customers, loans, portfolio, receipts
from ..operators.backfill import branch_month_counts, monthly_backfill
from ..operators.dedup import newest_per_key
from ..operators.lookup import attach, dimension
from .raw import AS_OF
from .registry import Inputs, query

_NUMBER = "'^-?[0-9]+(\\.[0-9]+)?$'"


def _decimal_sql(text: str, kind: str = "DECIMAL(20,2)") -> str:
    return f"CAST(CASE WHEN regexp_matches({text}, {_NUMBER}) THEN CAST({text} AS {kind}) END AS DOUBLE)"


@query("c1_safe_decimal", f"""
    SELECT p_partkey, {_decimal_sql("regexp_replace(p_brand, '[^0-9.\\-]', '', 'g')")} AS brand_no,
           {_decimal_sql("TRIM(raw)")} AS trimmed, {_decimal_sql("TRIM(REPLACE(pct, '%', ''))")} AS pct
    FROM (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 5 = 0 THEN p_type ELSE ' ' || CAST(p_size AS VARCHAR) || '.5 ' END AS raw,
                 CASE WHEN p_partkey % 7 = 0 THEN '%' ELSE CAST(p_size AS VARCHAR) || ' %' END AS pct FROM part)""")
def _(t: Inputs):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    rows = t["part"].select("p_partkey", "p_brand",
                            F.when(k % 5 == 0, F.col("p_type")).otherwise(F.concat(F.lit(" "), size, F.lit(".5 "))).alias("raw"),
                            F.when(k % 7 == 0, "%").otherwise(F.concat(size, F.lit(" %"))).alias("pct"))
    return rows.select("p_partkey", safe_decimal("p_brand", 20, 2, "noise").alias("brand_no"),
                       safe_decimal("raw", 20, 2).alias("trimmed"), safe_decimal("pct", 20, 2, "percent").alias("pct"))


@query("c2_safe_int", """
    SELECT applicantpropertydetailid AS id, CASE WHEN regexp_matches(TRIM(pincode), '^[0-9]+$') THEN CAST(TRIM(pincode) AS INT) END AS pincode
    FROM tblapplicationpropertydetail""")
def _(t):
    return t.raw["tblapplicationpropertydetail"].select(F.col("applicantpropertydetailid").alias("id"), safe_int("pincode").alias("pincode"))


@query("c3_signed_coordinate", f"""
    SELECT loanapplicationid, {_decimal_sql("regexp_replace(latitude, '[^0-9.\\-]', '', 'g')", "DECIMAL(20,8)")}
               * CASE WHEN latitude ILIKE '%s%' THEN -1 ELSE 1 END AS latitude,
           {_decimal_sql("regexp_replace(longitude, '[^0-9.\\-]', '', 'g')", "DECIMAL(20,8)")}
               * CASE WHEN longitude ILIKE '%w%' THEN -1 ELSE 1 END AS longitude
    FROM tblloantechnicalpropertysurrounding""")
def _(t):
    return t.raw["tblloantechnicalpropertysurrounding"].select(
        "loanapplicationid", signed_coordinate("latitude", "S").alias("latitude"), signed_coordinate("longitude", "W").alias("longitude"))


@query("c4_prefer", """
    SELECT applicantpropertydetailid AS id, CASE WHEN seen THEN technicaladdress ELSE propertyaddress END AS address,
           CASE WHEN seen THEN pacitytehsiltalukatownid ELSE cityid END AS city,
           CASE WHEN seen THEN CAST(papincode AS INT) ELSE TRY_CAST(TRIM(pincode) AS INT) END AS pincode
    FROM (SELECT p.*, s.*, COALESCE(s.technicaladdress <> '0', FALSE) AS seen FROM tblapplicationpropertydetail p
          LEFT JOIN tblloantechnicalpropertysurrounding s ON s.loanapplicationid = p.loanapplicationid)""")
def _(t):
    visits = t.raw["tblloantechnicalpropertysurrounding"].select("loanapplicationid", "technicaladdress", "pacitytehsiltalukatownid", "papincode")
    rows = t.raw["tblapplicationpropertydetail"].join(visits, "loanapplicationid", "left")
    seen = has_address("technicaladdress")
    return rows.select(F.col("applicantpropertydetailid").alias("id"), prefer(seen, "technicaladdress", "propertyaddress").alias("address"),
                       prefer(seen, "pacitytehsiltalukatownid", "cityid").alias("city"),
                       prefer(seen, safe_int("papincode"), safe_int("pincode")).alias("pincode"))


_KYC_TYPES = ((56, "pan", "identificationnumber"), (230, "aadh", "refuid"), (233, "voter", "identificationnumber"),
              (231, "pass", "identificationnumber"), (232, "dl", "identificationnumber"))
KYC_SQL = f"""
    SELECT applicantid, loanapplicationid,
           {", ".join(f"MAX({c}) FILTER (WHERE identificationtypedetailid = {k}) AS {n}_{c}" for k, n, c in _KYC_TYPES)},
           MAX(uidlastdigit) FILTER (WHERE identificationtypedetailid = 230) AS aadh_uidlastdigit,
           {", ".join(f"MAX(typedetaildescription) FILTER (WHERE identificationtypedetailid = {k}) AS {n}_kyc_verified_status" for k, n, _ in _KYC_TYPES)}
    FROM (SELECT * FROM tblapplicantkyc WHERE identificationtypedetailid IN (56, 230, 231, 232, 233)
          QUALIFY ROW_NUMBER() OVER (PARTITION BY applicantid, loanapplicationid, identificationtypedetailid
              ORDER BY lastmodifiedon DESC, identificationnumber DESC, refuid DESC, uidlastdigit DESC) = 1) k
    LEFT JOIN (SELECT typedetailid, typedetaildescription FROM tbltypedetail) d ON d.typedetailid = k.verifiedstatustypedetailid AND k.isactive = 1
    GROUP BY 1, 2"""


@query("c5_kyc_by_document", KYC_SQL)
def _(t):
    rows = customers.kyc_by_document(t.raw["tblapplicantkyc"], t.raw["tbltypedetail"])
    kept = [f"{n}_{c}" for _, n, c in _KYC_TYPES] + ["aadh_uidlastdigit"] + [f"{n}_kyc_verified_status" for _, n, _ in _KYC_TYPES]
    return rows.select("applicantid", "loanapplicationid", *kept)


@query("c6_latest_risk", """
    SELECT a.applicantid, a.loanapplicationid, a.lastmodifiedon, COALESCE(r.risktypedetailid, a.risktypedetailid) AS risk, d.typedetaildescription AS current_risk
    FROM (SELECT * FROM tblapplicant QUALIFY ROW_NUMBER() OVER (PARTITION BY applicantid ORDER BY lastmodifiedon DESC NULLS LAST) = 1) a
    LEFT JOIN (SELECT applicantid, risktypedetailid FROM tblapplicantrisk WHERE isactive = 1
        QUALIFY ROW_NUMBER() OVER (PARTITION BY applicantid ORDER BY reevaluatedon DESC) = 1) r ON r.applicantid = a.applicantid
    LEFT JOIN tbltypedetail d ON d.typedetailid = COALESCE(r.risktypedetailid, a.risktypedetailid)""")
def _(t):
    rows = newest_per_key(t.raw["tblapplicant"], "applicantid", "lastmodifiedon", carry=["loanapplicationid", "risktypedetailid"])
    rows = customers.latest_risk(rows, t.raw["tblapplicantrisk"]).withColumnRenamed("current_risktypedetailid", "risk")
    dim = dimension(t.raw["tbltypedetail"], "typedetailid", ["typedetaildescription"])
    return attach(rows, dim, ("risk", "typedetailid"), {"current_risk": "typedetaildescription"}).drop("risktypedetailid")


_BUCKET_SQL = """CASE WHEN days = 0 THEN '0' WHEN days BETWEEN 1 AND 30 THEN 'SMA-0' WHEN days BETWEEN 31 AND 60 THEN 'SMA-1'
    WHEN days BETWEEN 61 AND 90 THEN 'SMA-2' WHEN days BETWEEN 91 AND 365 THEN 'NPA (Sub-standard)' WHEN days BETWEEN 366 AND 730 THEN 'Doubtful 1 (D1)'
    WHEN days BETWEEN 731 AND 1095 THEN 'Doubtful 2 (D2)' WHEN days > 1095 THEN 'Doubtful 3 (D3)' END"""


@query("c7_dpd_bucket", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, days, {_BUCKET_SQL} AS bucket
    FROM (SELECT *, CASE WHEN l_partkey % 9 <> 0 THEN CAST(l_quantity AS BIGINT) * 25 - l_partkey % 31 END AS days FROM lineitem)""")
def _(t):
    days = F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity").cast("bigint") * 25 - F.col("l_partkey") % 31)
    rows = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", days.alias("days"))
    return rows.withColumn("bucket", portfolio.dpd_bucket("days"))


@query("c8_pos_after_sell", """
    SELECT loanduestatusid, CAST(pos * CASE WHEN sell IS NULL OR sell = 0 THEN COALESCE(own, 100) ELSE sell END * 0.01 AS DOUBLE) AS pos_after_sell
    FROM (SELECT loanduestatusid, pos, CASE WHEN loanapplicationid % 3 = 0 THEN CAST(0 AS DECIMAL(10,4)) WHEN loanapplicationid % 3 = 1 THEN CAST(62.5 AS DECIMAL(10,4)) END AS sell,
                 CASE WHEN loanapplicationid % 2 = 0 THEN CAST(40 AS DECIMAL(10,4)) END AS own FROM tblloanduestatus)""")
def _(t):
    k = F.col("loanapplicationid")
    sell = F.when(k % 3 == 0, F.lit(0).cast("decimal(10,4)")).when(k % 3 == 1, F.lit(62.5).cast("decimal(10,4)"))
    own = F.when(k % 2 == 0, F.lit(40).cast("decimal(10,4)"))
    return t.raw["tblloanduestatus"].select("loanduestatusid", portfolio.pos_after_sell("pos", sell, own).alias("pos_after_sell"))


ACTIVITY_SQL = """
    SELECT branch_id, COUNT(*) AS total_loans_originated, COUNT(*) FILTER (WHERE login_date = DATE '1998-06-30') AS total_logins,
           COUNT(*) FILTER (WHERE CAST(last_sanction_date AS DATE) = DATE '1998-06-30') AS total_loans_sanctioned,
           COUNT(*) FILTER (WHERE CAST(last_booked_date AS DATE) = DATE '1998-06-30') AS total_loans_booked,
           COUNT(*) FILTER (WHERE CAST(last_disbursal_date AS DATE) = DATE '1998-06-30') AS total_loans_disbursed,
           CAST(SUM(COALESCE(n, 0)) AS BIGINT) AS total_loans_disbursal_cancelled
    FROM slv_loan_details LEFT JOIN (SELECT loanapplicationid, COUNT(*) AS n FROM tblloanapplicationstatushistory
        WHERE isactive = 1 AND loanstatustypedetailid = 1619 AND CAST(createdon AS DATE) = DATE '1998-06-30' GROUP BY 1)
        ON loanapplicationid = loan_application_id GROUP BY 1"""


@query("c9_branch_activity", ACTIVITY_SQL)
def _(t):
    return portfolio.branch_activity(t.raw["slv_loan_details"], t.raw["tblloanapplicationstatushistory"], AS_OF)


PERFORMANCE_SQL = f"""
    SELECT s.loanapplicationid AS loan_application_id, s.pos, s.maxdeliquencyday AS dpd, s.isnpa AS is_npa, s.linkednpaloanid IS NOT NULL AS linked,
           s.pos * CASE WHEN e.percentage IS NULL OR e.percentage = 0 THEN COALESCE(o.percentage, 100) ELSE e.percentage END * 0.01 AS pos_after_sell,
           (SELECT {_BUCKET_SQL} FROM (SELECT w.days AS days)) AS dpd_bucket
    FROM (SELECT * FROM tblloanduestatus WHERE isactive = 1 QUALIFY ROW_NUMBER() OVER (PARTITION BY loanapplicationid ORDER BY lastmodifiedon DESC) = 1) s
    LEFT JOIN (SELECT loanapplicationid, partnerengagementid FROM tblloanapplicationdisbursaldetail WHERE isactive = 1
               QUALIFY ROW_NUMBER() OVER (PARTITION BY loanapplicationid ORDER BY lastmodifiedon DESC) = 1) d USING (loanapplicationid)
    LEFT JOIN (SELECT * FROM tblportfoliopartnerengagementdetail WHERE isactive = 1 AND engagementtype = 'SELL') e ON e.engagementid = d.partnerengagementid
    LEFT JOIN (SELECT * FROM tblportfoliopartnerengagementloandetails WHERE isactive = 1) o ON o.loanapplicationid = s.loanapplicationid
    LEFT JOIN (SELECT loanapplicationid, MAX(delinquentdays) AS days FROM tblloanapplicationpayschedule GROUP BY 1) w ON w.loanapplicationid = s.loanapplicationid"""
QUALITY_SQL = f"""
    SELECT branch_id, COUNT(*) FILTER (WHERE pos > 0) AS active_loan_count, CAST(SUM(pos) AS DOUBLE) AS total_pos,
           CAST(SUM(pos_after_sell) AS DOUBLE) AS total_pos_after_sell, COUNT(*) FILTER (WHERE dpd > 0) AS dpd_count,
           COUNT(*) FILTER (WHERE is_npa = 1) AS npa_count, CAST(SUM(CASE WHEN is_npa = 1 OR linked THEN pos ELSE 0 END) AS DOUBLE) AS npa_pos,
           COUNT(*) FILTER (WHERE dpd_bucket = 'SMA-0') AS sma0_count, COUNT(*) FILTER (WHERE dpd_bucket = 'SMA-1') AS sma1_count,
           COUNT(*) FILTER (WHERE dpd_bucket = 'SMA-2') AS sma2_count, COUNT(*) FILTER (WHERE dpd_bucket = 'NPA (Sub-standard)') AS npa_sub_standard_count,
           COUNT(*) FILTER (WHERE dpd_bucket = 'Doubtful 1 (D1)') AS doubtful1_count, COUNT(*) FILTER (WHERE dpd_bucket = 'Doubtful 2 (D2)') AS doubtful2_count,
           COUNT(*) FILTER (WHERE dpd_bucket = 'Doubtful 3 (D3)') AS doubtful3_count,
           CAST(CAST(ROUND(CAST(SUM(CASE WHEN is_npa = 1 OR linked THEN pos ELSE 0 END) AS DOUBLE) / NULLIF(CAST(SUM(pos) AS DOUBLE), 0) * 100, 2) AS DECIMAL(6,2)) AS DOUBLE) AS gross_npa_pct
    FROM ({PERFORMANCE_SQL}) JOIN (SELECT loan_application_id, branch_id FROM slv_loan_details) USING (loan_application_id) GROUP BY 1"""


@query("c10_portfolio_quality", f"""
    SELECT q.*, b.branchname AS branch_name FROM ({QUALITY_SQL}) q LEFT JOIN (
        SELECT branchid, branchname FROM mstbranch WHERE isactive = 1
        QUALIFY ROW_NUMBER() OVER (PARTITION BY branchid ORDER BY lastmodifiedon DESC NULLS LAST) = 1) b ON b.branchid = q.branch_id""")
def _(t):
    raw = t.raw
    performance = portfolio.latest_performance(
        raw["tblloanduestatus"], raw["tblloanapplicationdisbursaldetail"], raw["tblportfoliopartnerengagementdetail"],
        raw["tblportfoliopartnerengagementloandetails"], raw["tblloanapplicationpayschedule"])
    quality = portfolio.portfolio_quality(portfolio.loans_with_branch(performance, raw["slv_loan_details"]), "branch_id")
    branches = newest_per_key(raw["mstbranch"].filter("isactive = 1"), "branchid", "lastmodifiedon", carry=["branchname"])
    return attach(quality, branches, ("branch_id", "branchid"), {"branch_name": "branchname"})


STAFF_SQL = """
    SELECT base_branch_id, COUNT(DISTINCT employee_id) AS active_employee_count,
           COUNT(DISTINCT employee_id) FILTER (WHERE UPPER(designation_name) = 'FOS') AS no_of_fos
    FROM slv_employee WHERE is_active AND (is_resigned IS NULL OR UPPER(TRIM(is_resigned)) IN ('FALSE', '0', 'N')) GROUP BY 1"""


@query("c11_staff_count", STAFF_SQL)
def _(t):
    return portfolio.staff_count(t.raw["slv_employee"])


@query("c11_partner_count", "SELECT base_location_branch_id, COUNT(dsa_id) AS active_dsa_count FROM slv_channel_partner GROUP BY 1")
def _(t):
    return portfolio.partner_count(t.raw["slv_channel_partner"])


SCORECARD_SQL = """
    SELECT sales_officer_emp_id, loans_onboarded_total, loans_onboarded_mtd, CAST(disbursed AS DOUBLE) AS total_disbursed_amount,
           active_loan_count, CAST(book AS DOUBLE) AS current_book_pos, loans_in_dpd, loans_in_npa, CAST(arrears AS DOUBLE) AS total_arrears_amount,
           CASE WHEN total = 0 THEN 0 ELSE CAST(secured AS DOUBLE) / CAST(total AS DOUBLE) * 100 END AS collection_efficiency_pct,
           CASE WHEN active_loan_count > 0 THEN CAST(loans_in_dpd AS DOUBLE) / CAST(active_loan_count AS DOUBLE) * 100 END AS dpd_rate_pct,
           CAST(CAST(ROUND(CAST(npa_pos AS DOUBLE) / NULLIF(CAST(book AS DOUBLE), 0) * 100, 2) AS DECIMAL(6,2)) AS DOUBLE) AS npa_rate_pct
    FROM (SELECT sales_officer_emp_id, COUNT(*) AS loans_onboarded_total,
                 COUNT(*) FILTER (WHERE date_trunc('month', last_disbursal_date) = DATE '1998-06-01') AS loans_onboarded_mtd,
                 SUM(COALESCE(total_disbursed_amount, 0)) AS disbursed FROM slv_loan_details GROUP BY 1)
    LEFT JOIN (SELECT sales_officer_emp_id, COUNT(*) FILTER (WHERE pos > 0) AS active_loan_count, SUM(pos) AS book,
                      COUNT(*) FILTER (WHERE max_dpd > 0) AS loans_in_dpd, COUNT(*) FILTER (WHERE is_npa = 1) AS loans_in_npa,
                      SUM(due_interest + due_principal) AS arrears, SUM(securedamount) AS secured, SUM(totalamount) AS total,
                      SUM(CASE WHEN is_npa = 1 THEN pos ELSE 0 END) AS npa_pos
               FROM slv_contract_perf_monthly JOIN (SELECT loan_application_id, sales_officer_emp_id FROM slv_loan_details) USING (loan_application_id)
               LEFT JOIN tblapplicantriskdetail r ON r.loanapplicationid = loan_application_id AND r.isactive = 1 GROUP BY 1) USING (sales_officer_emp_id)"""


@query("c12_officer_scorecard", SCORECARD_SQL)
def _(t):
    return portfolio.officer_scorecard(t.raw["slv_loan_details"], t.raw["slv_contract_perf_monthly"], t.raw["tblapplicantriskdetail"], AS_OF)


TENURE_SQL = """
    SELECT loanapplicationid, COUNT(*) FILTER (WHERE UPPER(TRIM(head)) = 'EMI' AND isactive = 1) AS current_tenure_months,
           COUNT(*) FILTER (WHERE UPPER(TRIM(head)) = 'EMI' AND isactive = 1 AND duedate > DATE '1998-06-30') AS balance_tenure_months,
           CAST(MAX(dueamount) FILTER (WHERE isactive = 1 AND strftime(duedate, '%Y%m') = '199806') AS DOUBLE) AS current_emi
    FROM tblloanapplicationpayschedule GROUP BY 1"""


@query("c13_tenure_metrics", TENURE_SQL)
def _(t):
    return loans.tenure_metrics(t.raw["tblloanapplicationpayschedule"], AS_OF)


@query("c14_first_acceptance", """
    SELECT l.loanapplicationid, l.createdon, COALESCE(MIN(h.applicationaccepteddate), l.createdon) AS login_acceptance_date FROM tblloanapplication l
    LEFT JOIN tblloanapplicationstatushistory h ON h.loanapplicationid = l.loanapplicationid AND h.isapplicationaccepted = 1 GROUP BY 1, 2""")
def _(t):
    accepted = loans.first_acceptance(t.raw["tblloanapplicationstatushistory"])
    rows = t.raw["tblloanapplication"].select("loanapplicationid", "createdon").distinct().join(accepted, "loanapplicationid", "left")
    return rows.select("loanapplicationid", "createdon", F.coalesce("first_accepted", "createdon").alias("login_acceptance_date"))


@query("c15_effective_roi", """
    SELECT COALESCE(r.loanapplicationid, s.loanapplicationid) AS loanapplicationid, CAST(COALESCE(aroi, finalroi) AS DOUBLE) AS current_roi_pct, paydueday AS current_emi_cycle_day
    FROM (SELECT * FROM tblapplicationdisbursalreschedulement WHERE isactive = 1
          QUALIFY ROW_NUMBER() OVER (PARTITION BY loanapplicationid ORDER BY disbursalreschedulementid DESC) = 1) r
    FULL JOIN (SELECT * FROM tblloanapplicationroispread WHERE isactive = 1 QUALIFY ROW_NUMBER() OVER (PARTITION BY loanapplicationid
          ORDER BY lastmodifiedon DESC, baserateinpercentage DESC, plrspreadinpercentage DESC, finalroi DESC) = 1) s ON s.loanapplicationid = r.loanapplicationid""")
def _(t):
    return loans.effective_roi(t.raw["tblapplicationdisbursalreschedulement"], t.raw["tblloanapplicationroispread"])


LINKED_SQL = """
    SELECT loanapplicationid, TRUE AS is_link_loan, COUNT(*) AS linked_loan_count,
           string_agg(CAST(linkedloanapplicationid AS VARCHAR), ',' ORDER BY linkedloanapplicationid) AS linked_loans
    FROM tblloanapplicationlinking WHERE isactive = 1 GROUP BY 1"""


@query("c16_linked_loans", LINKED_SQL)
def _(t):
    return loans.linked_loans(t.raw["tblloanapplicationlinking"])


RECEIPT_SQL = """
    SELECT loanapplicationid, last_paid_mode_id, typedetaildescription AS last_paid_mode, last_paid_date, last_collected_amount, receipt_count, total_receipt_amount
    FROM (SELECT loanapplicationid, MAX(mode) AS last_paid_mode_id, MAX(paid) AS last_paid_date,
                 CAST(COALESCE(MAX(pd), MAX(mr)) AS DOUBLE) AS last_collected_amount, COUNT(DISTINCT draft) AS receipt_count,
                 CAST(SUM(COALESCE(pd, 0)) + SUM(COALESCE(mr, 0)) AS DOUBLE) AS total_receipt_amount
          FROM (SELECT loanapplicationid, collectedthroughtypedetailid AS mode, statusupdateddate AS paid, collectedamount AS mr, NULL::DECIMAL(18,2) AS pd, draftreceiptid AS draft
                FROM tblloanapplicationmanualreceipt WHERE isactive = 1 AND statustypedetailid = 219
                UNION ALL SELECT loanapplicationid, NULL, statusdate, NULL, pdcachamount, NULL
                FROM tblloanapplicationpresentationdetail WHERE isactive = 1 AND statustypedetailid = 2066) GROUP BY 1)
    LEFT JOIN tbltypedetail ON typedetailid = last_paid_mode_id"""


@query("c17_receipt_summary", RECEIPT_SQL)
def _(t):
    return receipts.receipt_summary(t.raw["tblloanapplicationmanualreceipt"], t.raw["tblloanapplicationpresentationdetail"], t.raw["tbltypedetail"])


CHARGE_SQL = """
    SELECT loanapplicationid, COUNT(*) FILTER (WHERE kind = 1) AS bounce_count, CAST(SUM(CASE kind WHEN 1 THEN totalcharge ELSE 0 END) AS DOUBLE) AS total_bounce_amount,
           COUNT(*) FILTER (WHERE kind = 2) AS penal_charge_count, CAST(SUM(CASE kind WHEN 2 THEN totalcharge ELSE 0 END) AS DOUBLE) AS total_penal_charge_amount,
           CAST(SUM(CASE WHEN kind = 1 AND settled THEN totalcharge ELSE 0 END) AS DOUBLE) AS total_bounce_amount_adjust,
           CAST(SUM(CASE WHEN kind = 2 AND settled THEN totalcharge ELSE 0 END) AS DOUBLE) AS total_penal_charge_amount_adjust
    FROM (SELECT *, typedetailchargeid AS kind, CAST(knockoffdate AS DATE) = DATE '1998-06-30' AS settled FROM tblloanapplicationchargedetails
          WHERE isactive = 1 AND CAST(chargedate AS DATE) = DATE '1998-06-30')
    WHERE loanapplicationid IN (SELECT loan_application_id FROM slv_loan_details) GROUP BY 1"""


@query("c18_charge_summary", CHARGE_SQL)
def _(t):
    return receipts.charge_summary(t.raw["tblloanapplicationchargedetails"], t.raw["slv_loan_details"], AS_OF)


OVERDUE_SQL = """
    SELECT loanapplicationid, COUNT(*) AS cnt_emi_due, CAST(SUM(dueamount) AS DOUBLE) AS total_emi_due_amount,
           CAST(SUM(principal) AS DOUBLE) AS principal_over_due, CAST(SUM(interst) AS DOUBLE) AS interest_over_due
    FROM tblloanapplicationpayschedule WHERE isactive = 1 AND dueamount > 0 AND duedate < DATE '1998-06-30'
    AND loanapplicationid IN (SELECT loanapplicationid FROM tblloanapplication WHERE isactive = 1 AND statustypedetailid = 189) GROUP BY 1"""


@query("c19_overdue_summary", OVERDUE_SQL)
def _(t):
    return receipts.overdue_summary(t.raw["tblloanapplicationpayschedule"], t.raw["tblloanapplication"], AS_OF)


@query("c20_total_demand", f"""
    SELECT loanduestatusid, CAST(COALESCE(unadjustedamount, 0) + COALESCE(CAST(total_emi_due_amount AS DECIMAL(18,2)), 0) AS DOUBLE) AS total_demand
    FROM tblloanduestatus LEFT JOIN ({OVERDUE_SQL}) USING (loanapplicationid)""")
def _(t):
    overdue = receipts.overdue_summary(t.raw["tblloanapplicationpayschedule"], t.raw["tblloanapplication"], AS_OF)
    rows = t.raw["tblloanduestatus"].join(overdue, "loanapplicationid", "left")
    return rows.select("loanduestatusid", receipts.total_demand("unadjustedamount", "total_emi_due_amount").alias("total_demand"))


@query("c21_npa_flag", "SELECT loanduestatusid, COALESCE(TRIM(linkednpaloanid) <> '', FALSE) OR isnpa = 1 AS is_npa FROM tblloanduestatus")
def _(t):
    return t.raw["tblloanduestatus"].select("loanduestatusid", receipts.npa_flag("linkednpaloanid", "isnpa").alias("is_npa"))


SANCTIONER_SQL = """
    SELECT loanapplicationid, employeename || '_' || employeecode AS last_sanction_by FROM tblloanapplicationunderwriting
    JOIN tbluser ON userid = createdby JOIN tblemployee e ON e.entityid = tbluser.entityid WHERE underwritingstatustypedetailid = 237
    QUALIFY ROW_NUMBER() OVER (PARTITION BY loanapplicationid ORDER BY tblloanapplicationunderwriting.lastmodifiedon DESC, employeename DESC) = 1"""


@query("c22_last_sanctioner", SANCTIONER_SQL)
def _(t):
    return receipts.last_sanctioner(t.raw["tblloanapplicationunderwriting"], t.raw["tbluser"], t.raw["tblemployee"])


@query("c23_receipts_union", """
    SELECT d.loanapplicationid, presentationdetailid AS id, isknockoff, pdcachdate AS payment_date, CAST(pdcachamount AS DOUBLE) AS collected_amount,
           presentationtypedetailid AS payment_mode_id, typedetaildisplaytext || CASE WHEN isrepresentation = 1 THEN '_represented' ELSE '' END AS payment_mode,
           chequerefrenceno AS reference_no, 'presentation' AS paytype
    FROM tblloanapplicationpresentationdetail d JOIN tblloanapplicationpresentationbatch b ON b.presentationid = d.presentationid AND b.isactive = 1
    LEFT JOIN tbltypedetail ON typedetailid = presentationtypedetailid WHERE d.isactive = 1 AND statustypedetailid = 2066
    UNION ALL
    SELECT loanapplicationid, receiptid, isknockoff, CASE WHEN typedetaildisplaytext = 'Cash' THEN dateofcollection ELSE statusupdateddate END,
           CAST(collectedamount AS DOUBLE), collectedthroughtypedetailid, typedetaildisplaytext, chequenumber, 'manualreceipt'
    FROM tblloanapplicationmanualreceipt m LEFT JOIN tbltypedetail ON typedetailid = collectedthroughtypedetailid
    WHERE m.isactive = 1 AND statustypedetailid = 219 AND feesfortypedetailid = 1861""")
def _(t):
    return receipts.receipts_union(t.raw["tblloanapplicationpresentationdetail"], t.raw["tblloanapplicationpresentationbatch"],
                                   t.raw["tblloanapplicationmanualreceipt"], t.raw["tbltypedetail"])


@query("c24_instalment_payments", """
    SELECT s.loanapplicationid, s.payscheduleid, s.duedate, a.paytype, COALESCE(a.presentationdetailid, a.receiptid) AS id
    FROM tblloanapplicationpayschedule s JOIN tblloanpaymentadjust a ON a.loanapplicationid = s.loanapplicationid AND a.payscheduleid = s.payscheduleid
    WHERE s.isactive = 1 AND a.isactive = 1 AND s.duedate <= DATE '1998-06-30'""")
def _(t):
    return receipts.instalment_payments(t.raw["tblloanapplicationpayschedule"], t.raw["tblloanpaymentadjust"], AS_OF).select(
        "loanapplicationid", "payscheduleid", "duedate", "paytype", "id")


@query("c25_is_overdue", """
    SELECT payscheduleid, duedate < DATE '1998-06-30' AND (clearenceflag IS NULL OR clearenceflag = 0) AS is_overdue FROM tblloanapplicationpayschedule""")
def _(t):
    return t.raw["tblloanapplicationpayschedule"].select("payscheduleid", receipts.is_overdue("duedate", "clearenceflag", AS_OF).alias("is_overdue"))


@query("c41_monthly_backfill", """
    WITH spine AS (SELECT n_nationkey AS branch_id, CAST(m AS DATE) AS snapshot_date FROM nation
                   CROSS JOIN generate_series(DATE '1996-06-01', DATE '1998-06-01', INTERVAL 1 MONTH) AS g(m)),
    marks AS (SELECT branch_id, date_trunc('month', login_date) AS m, 'login' AS kind FROM slv_loan_details
              UNION ALL SELECT branch_id, date_trunc('month', last_sanction_date), 'sanction' FROM slv_loan_details
              UNION ALL SELECT branch_id, date_trunc('month', last_booked_date), 'book' FROM slv_loan_details
              UNION ALL SELECT branch_id, date_trunc('month', last_disbursal_date), 'disburse' FROM slv_loan_details
              UNION ALL SELECT branch_id, date_trunc('month', createdon), 'cancel' FROM slv_loan_details JOIN tblloanapplicationstatushistory
              ON loanapplicationid = loan_application_id WHERE isactive = 1 AND loanstatustypedetailid = 1619)
    SELECT s.branch_id, s.snapshot_date, COUNT(*) FILTER (WHERE kind = 'login') AS total_logins, COUNT(*) FILTER (WHERE kind = 'sanction') AS total_loans_sanctioned,
           COUNT(*) FILTER (WHERE kind = 'book') AS total_loans_booked, COUNT(*) FILTER (WHERE kind = 'disburse') AS total_loans_disbursed,
           COUNT(*) FILTER (WHERE kind = 'cancel') AS total_loans_disbursal_cancelled
    FROM spine s LEFT JOIN marks k ON k.branch_id = s.branch_id AND CAST(k.m AS DATE) = s.snapshot_date GROUP BY 1, 2""")
def _(t):
    branches = t["nation"].select(F.col("n_nationkey").alias("branch_id"))
    counts = branch_month_counts(t.raw["slv_loan_details"], t.raw["tblloanapplicationstatushistory"], AS_OF)
    return monthly_backfill(branches, "branch_id", counts, AS_OF)


@query("c42_tranche_summary", """
    SELECT loanapplicationid, CAST(COUNT(*) AS INT) AS total_tranches, MAX(disburseddate) AS last_tranche_date, MIN(createdon) AS record_created_at,
           MAX(lastmodifiedon) AS record_modified_at, CAST(arg_max(disbursedamount, (disburseddate, favouringid)) AS DOUBLE) AS disbursedamount,
           arg_max(favouringcategorytypedetailid, (disburseddate, favouringid)) AS favouringcategorytypedetailid,
           arg_max(transactiontypedetailid, (disburseddate, favouringid)) AS transactiontypedetailid
    FROM tblloanapplicationdisbursmentfavouring WHERE isactive = 1 GROUP BY 1""")
def _(t):
    return loans.tranche_summary(t.raw["tblloanapplicationdisbursmentfavouring"])


@query("c43_lead_followups", """
    SELECT l.leadid, MAX(f.createdon) AS last_followup_date, COUNT(f.leadfollowupid) AS total_followups,
           CAST(date_diff('day', CAST(l.createdon AS DATE), CAST(MAX(f.createdon) AS DATE)) AS INT) AS days_to_conversion
    FROM tbllead l JOIN tblleadfollowup f ON f.leadid = l.leadid GROUP BY l.leadid, l.createdon""")
def _(t):
    # Both sides grow with the tables; two columns of a well-compressed file look small enough to broadcast, and are not.
    followups = loans.lead_followups(t.raw["tblleadfollowup"]).hint("merge")
    rows = t.raw["tbllead"].select("leadid", "createdon").join(followups, "leadid")
    return rows.select("leadid", "last_followup_date", "total_followups",
                       loans.days_to_followup("createdon", "last_followup_date").alias("days_to_conversion"))


@query("c44_covered_branches", """
    SELECT d.dsaid, COUNT(c.entitycoveredbranchid) AS covered_branch_count, CASE WHEN MAX(t.typedetailcode) = 'Initiated' THEN 'FI Positive' ELSE 'FI Negative' END AS fi_status
    FROM tbldsa d LEFT JOIN tblentitycoveredbranch c ON c.entityid = d.entityid AND c.isactive = 1
    LEFT JOIN tbltypedetail t ON t.typedetailid = d.channeltypetypedetailid GROUP BY 1""")
def _(t):
    rows = t.raw["tbldsa"].select("dsaid", "entityid", "channeltypetypedetailid")
    rows = rows.join(loans.covered_branches(t.raw["tblentitycoveredbranch"]), "entityid", "left")
    codes = dimension(t.raw["tbltypedetail"], "typedetailid", ["typedetailcode"])
    rows = attach(rows, codes, ("channeltypetypedetailid", "typedetailid"), {"code": "typedetailcode"})
    return rows.select("dsaid", F.coalesce("covered_branch_count", F.lit(0)).alias("covered_branch_count"), loans.fi_status("code").alias("fi_status"))


@query("c46_engagement_label", """
    SELECT m.loanmonthlyid, m.loanapplicationid, e.startdate AS engagement_date, p.partnername AS partner_name, e.engagementtype || '_' || e.assignmenttype AS engagement_type
    FROM tblloanmonthly m LEFT JOIN tblportfoliopartnerengagementdetail e ON e.engagementid = m.engagementid AND e.isactive = 1
    LEFT JOIN mstportfoliopartner p ON p.partnerid = e.partnerid AND p.isactive = 1""")
def _(t):
    rows = t.raw["tblloanmonthly"].select("loanmonthlyid", "loanapplicationid", "engagementid")
    return loans.engagement_label(rows, t.raw["tblportfoliopartnerengagementdetail"], t.raw["mstportfoliopartner"]).drop("engagementid")


@query("c47_existing_obligations", """
    SELECT applicantid, loanapplicationid, CAST(SUM(emiamount) AS DOUBLE) AS total_existing_emi, COUNT(*) AS existing_obligation_count,
           CAST(SUM(loanamount) AS DOUBLE) AS total_existing_loan_amt FROM tblapplicantexistingobligation WHERE isactive = 1 GROUP BY 1, 2""")
def _(t):
    return loans.existing_obligations(t.raw["tblapplicantexistingobligation"])
