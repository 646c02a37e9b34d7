"""The silver tables themselves, built from the derived raw tables.

Nothing in the SQL comes from the builds: plain renames are written out in columns.py, everything computed here.
"""

import re

from ..plans import (
    asset, branch, channel_partner, collections_daily, contract_perf_monthly, customer, early_warning, employee,
    enquiry, loan_details, loan_processing, repayment_behavior,
)
from ..operators.slices import written
from ..sources.tables import Tables
from . import columns as k
from . import portfolio as p
from . import warning as w
from .raw import AS_OF, RUN_TS
from .registry import Inputs, query

_AUDIT = "TIMESTAMP '1998-06-30 18:30:15' AS silver_loaded_at, '19980630_183015' AS silver_batch_id"


#: SQL of the built tables before their decimals are shown as doubles, for the chained queries.
EXACT: dict[str, str] = {}


def _doubles(names: str, sql: str, table: str = "") -> str:
    """Show the named decimal columns as doubles."""
    if table:
        EXACT[table] = sql
    return f"SELECT * REPLACE ({', '.join(f'CAST({n} AS DOUBLE) AS {n}' for n in names.split())}) FROM ({sql})"


def _newest(table: str, by: str, key: str = "loanapplicationid", where: str = "isactive = 1") -> str:
    return f"(SELECT * FROM {table} WHERE {where} QUALIFY ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {by}) = 1)"


def _labels(labels: dict[str, str], text: str = "typedetaildescription", where: str = "") -> tuple[str, str]:
    """Columns and joins that decode codes of a row called x."""
    columns = ", ".join(f"d_{n}.{text} AS {n}" for n in labels)
    joins = "\n".join(f"LEFT JOIN tbltypedetail d_{n} ON d_{n}.typedetailid = x.{c} {where}" for n, c in labels.items())
    return columns, joins


_COLS, _JOINS = _labels({"loan_status": "statustypedetailid", "loan_scheme": "loanschemetypedetailid", "interest_type": "interesttypetypedetailid"},
                        "typedetaildisplaytext", "AND {a}.isactive = 1")
for _n in ("loan_status", "loan_scheme", "interest_type"):
    _JOINS = _JOINS.replace("{a}", f"d_{_n}", 1)
LOAN_DETAILS_SQL = _doubles("""
    requested_amount first_sanction_amount revised_sanction_amount sanctioned_emi total_disbursed_amount total_booked_amount total_insurance_amount
    first_booked_amount login_amount first_disbursed_amount current_roi sanction_ltv pending_cheque_handover_amount current_emi current_roi_pct
    foir_waiver ltv_waiver tenure_waiver lcr_waiver insr_waiver pos sell_pos base_rate_pct plr_spread_pct final_roi_pct waiver_roi_pct add_spread
    eligible_loan_amount proposed_emi income_considered obligation_considered property_value_considered final_foir_pct final_ltv_pct
    combined_ltv_pct insr_pct foir_norm ltv_norm dltv dltv_with_insurance dlcr dlcr_with_insurance combined_dltv combined_dlcr""", f"""
    SELECT x.loanapplicationid AS loan_application_id, {k.LOAN_APPLICATION}, UPPER(TRIM(x.applicationnumber)) AS application_number,
           x.isemployeeloan = 1 AS is_employee_loan, CAST(x.date AS DATE) AS application_date,
           {k.LOAN_DISBURSAL}, CAST(ds.moratoriummonths AS INT) AS moratorium_months, TRIM(ds.fundingsouce) AS funding_source,
           {k.LOAN_DISBURSAL_RATIOS},
           {k.LOAN_ADDITIONAL}, CAST(lad.logindate AS DATE) AS login_date, CAST(lad.firstsancationdate AS DATE) AS first_sancation_date,
           r.paydueday AS current_emi_cycle_day, COALESCE(r.aroi, s.finalroi) AS current_roi_pct, {k.LOAN_SPREAD},
           COALESCE(acc.first_date, x.createdon) AS login_acceptance_date, COALESCE(t.current_tenure_months, x.sanctionedtenure) AS current_tenure_months,
           COALESCE(t.balance_tenure_months, x.sanctionedtenure) AS balance_tenure_months, COALESCE(t.current_emi, lad.currentemi) AS current_emi,
           due.pos, due.sellpos AS sell_pos, {k.LOAN_DECISION},
           CASE WHEN wv.loanapplicationid IS NOT NULL THEN COALESCE(wv.foirwaiver, 0) END AS foir_waiver,
           CASE WHEN wv.loanapplicationid IS NOT NULL THEN COALESCE(wv.ltvwaiver, 0) END AS ltv_waiver,
           CASE WHEN wv.loanapplicationid IS NOT NULL THEN COALESCE(wv.waivertenure, 0) END AS tenure_waiver,
           CASE WHEN wv.loanapplicationid IS NOT NULL THEN COALESCE(wv.lcrwaiver, 0) END AS lcr_waiver,
           CASE WHEN wv.loanapplicationid IS NOT NULL THEN COALESCE(wv.insrwaiver, 0) END AS insr_waiver,
           ll.is_link_loan, ll.linked_loan_count, ll.linked_loans, ck.tvr_overall_flag, ck.tvr_flag_4, ck.tvr_flag_3bribe,
           pu.loanpurposeid AS loan_purpose_id, pu.loanpurposename AS loan_purpose, pr.productname AS product_name, dsa.companyname AS channel_partner_name,
           {_COLS}, cat.typedetaildescription AS category, {_AUDIT}
    FROM {_newest("tblloanapplication", "lastmodifiedon DESC NULLS LAST")} x
    LEFT JOIN {_newest("tblloanapplicationdisbursaldetail", "lastmodifiedon DESC")} ds USING (loanapplicationid)
    LEFT JOIN {_newest("tblloanapplicationadditionaldetail", "loanadditionalid DESC")} lad USING (loanapplicationid)
    LEFT JOIN {_newest("tblapplicationdisbursalreschedulement", "disbursalreschedulementid DESC")} r USING (loanapplicationid)
    LEFT JOIN {_newest("tblloanapplicationroispread", "lastmodifiedon DESC, baserateinpercentage DESC, plrspreadinpercentage DESC, finalroi DESC")} s USING (loanapplicationid)
    LEFT JOIN (SELECT loanapplicationid, MIN(applicationaccepteddate) AS first_date FROM tblloanapplicationstatushistory WHERE isapplicationaccepted = 1 GROUP BY 1) acc USING (loanapplicationid)
    LEFT JOIN ({p.TENURE_SQL}) t USING (loanapplicationid)
    LEFT JOIN {_newest("tblloanduestatus", "lastmodifiedon DESC")} due USING (loanapplicationid)
    LEFT JOIN {_newest("tblloanapplicationruleengineresponse", "ruleengineresponseid DESC", where="outputtype = 'sanction'")} dec USING (loanapplicationid)
    LEFT JOIN (SELECT * FROM tblloanapplicationwaiver WHERE isactive = 1) wv ON wv.loanapplicationid = x.loanapplicationid
    LEFT JOIN ({p.LINKED_SQL}) ll ON ll.loanapplicationid = x.loanapplicationid
    LEFT JOIN (SELECT loanapplicationid, COALESCE(MAX(tvrchecklistid) <> 0, FALSE) AS tvr_overall_flag, COALESCE(MAX(tvrchecklistid) = 4, FALSE) AS tvr_flag_4,
                      CASE WHEN MAX(tvrchecklistid) = 3 THEN 'Bribe' END AS tvr_flag_3bribe FROM tblloanapplicationtvrchecklist WHERE isactive = 1 GROUP BY 1) ck ON ck.loanapplicationid = x.loanapplicationid
    LEFT JOIN mstloanpurpose pu ON pu.loanpurposeid = x.loanpurposeid AND pu.isactive = 1
    LEFT JOIN mstproduct pr ON pr.productid = x.loanproductid AND pr.isactive = 1
    LEFT JOIN {_newest("tbldsarenewal", "lastmodifiedon DESC", "dsaid")} dsa ON dsa.dsaid = x.channelpartnerdsaid
    {_JOINS}
    LEFT JOIN tbltypedetail cat ON cat.typedetailid = x.refinanceschemeid""", "slv_loan_details")


@query("g1_loan_details", LOAN_DETAILS_SQL)
def _(t):
    return loan_details.build(t.raw, t.raw, AS_OF, RUN_TS)


def _name_sql(*parts: str) -> str:
    return f"NULLIF(array_to_string(list_filter([{', '.join(f'TRIM({c})' for c in parts)}], lambda v: v IS NOT NULL AND v <> ''), ' '), '')"


_OCCUPATION_KEY = "applicantid, loanapplicationid"
_COLS = ", ".join(f"d_{n}.typedetaildescription AS {n}" for n in k.APPLICANT_LABELS)
_JOINS = "\n".join(f"LEFT JOIN tbltypedetail d_{n} ON d_{n}.typedetailid = {a}.{c}" for n, (a, c) in k.APPLICANT_LABELS.items())
CUSTOMER_SQL = _doubles("gross_income assessed_income total_existing_emi total_existing_loan_amt bt_loan_amount", f"""
    SELECT * EXCLUDE (_relation), CASE WHEN is_main_applicant THEN 'Self' ELSE _relation END AS relationship_to_main FROM (
    SELECT x.applicantid AS applicant_id, x.loanapplicationid AS loan_application_id, {k.APPLICANT},
           {_name_sql("x.firstname", "x.middlename", "x.lastname")} AS full_name, CAST(x.dateofbirth AS DATE) AS date_of_birth, {_COLS},
           CASE x.isminority WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS is_minority, COALESCE(x.ismainapplicant = 1, FALSE) AS is_main_applicant,
           {_name_sql("x.fatherfirstname", "x.fathermiddlename", "x.fatherlastname")} AS father_name,
           {_name_sql("x.motherfirstname", "x.mothermiddlename", "x.motherlastname")} AS mother_name,
           {_name_sql("x.spousefirstname", "x.spousemiddlename", "x.spouselastname")} AS spouse_name,
           CASE x.isdisabled WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS is_disabled, CASE x.isexservicemen WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS is_exservicemen,
           CASE x.ismanualscavenger WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS is_manualscavenger, x.ishomemakertypedetailid IS NOT NULL AS is_homemaker,
           x.livingstandardtypedetailid IS NOT NULL AS lsi, CASE x.isnegativeprofile WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS negative_caution_profile,
           CASE x.iscustomerhavepoliticallink WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS is_politacally_linked,
           CASE x.isregularrtrpostdefault WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS regular_rtr, sg.custsegment AS customer_segment,
           {k.APPLICANT_KYC}, bu.currentstateid AS current_state, {k.APPLICANT_ADDRESS}, UPPER(TRIM(occ.companyname)) AS company_name,
           CAST(occ.dateofincorporation AS DATE) AS dincorporation_joining_date, {k.APPLICANT_OCCUPATION},
           inc.applicantgrossincome AS gross_income, inc.assessedmonthlyincome AS assessed_income, bu.officeaddress AS business_office_address,
           ud.udhyamregnumber AS udyam_reg_no, ud.udhyamissuedate AS udyam_reg_date, CAST(ci.score AS INT) AS cibil_score, sc.underwritingscore AS a_score,
           sc.creditbucket AS credit_bucket, bu.experianscore AS experian_score, ob.total_existing_emi, ob.existing_obligation_count, ob.total_existing_loan_amt,
           bt.btloanamount AS bt_loan_amount, {_AUDIT}
    FROM {_newest("tblapplicant", "lastmodifiedon DESC NULLS LAST", "applicantid", "TRUE")} x
    LEFT JOIN (SELECT a.applicantid, a.loanapplicationid, COALESCE(r.risktypedetailid, a.risktypedetailid) AS risk
               FROM {_newest("tblapplicant", "lastmodifiedon DESC NULLS LAST", "applicantid", "TRUE")} a
               LEFT JOIN {_newest("tblapplicantrisk", "reevaluatedon DESC", "applicantid")} r USING (applicantid)) rk ON rk.applicantid = x.applicantid
    LEFT JOIN {_newest("tblapplicantoccupationaldetail", "lastmodifiedon DESC", _OCCUPATION_KEY)} occ ON occ.applicantid = x.applicantid AND occ.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest("tblapplicantincome", "lastmodifiedon DESC", _OCCUPATION_KEY)} inc ON inc.applicantid = x.applicantid AND inc.loanapplicationid = x.loanapplicationid
    LEFT JOIN (SELECT * FROM tblcustomersegmentationmodel WHERE isactive = 1) sg ON sg.applicantid = x.applicantid AND sg.loanapplicationid = x.loanapplicationid
    LEFT JOIN ({p.KYC_SQL}) ky ON ky.applicantid = x.applicantid AND ky.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest("tblapplicantkyc", "lastmodifiedon DESC, verifiedstatustypedetailid DESC", _OCCUPATION_KEY, "isactive = 1 AND isuseforperformkyc = 1")} ks
           ON ks.applicantid = x.applicantid AND ks.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest("tblascoremodel", "createdon DESC", _OCCUPATION_KEY)} sc ON sc.applicantid = x.applicantid AND sc.loanapplicationid = x.loanapplicationid
    LEFT JOIN (SELECT applicantid, loanapplicationid, SUM(emiamount) AS total_existing_emi, COUNT(*) AS existing_obligation_count, SUM(loanamount) AS total_existing_loan_amt
               FROM tblapplicantexistingobligation WHERE isactive = 1 GROUP BY 1, 2) ob ON ob.applicantid = x.applicantid AND ob.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest("tblentitybureau", "reportdate DESC", "entityid, loanapplicationid", "isactive = 1 AND bureautypedetailid = 410")} ci
           ON ci.entityid = x.entityid AND ci.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest("tbladdress", "lastmodifiedon DESC", "entityid")} ad ON ad.entityid = x.entityid
    LEFT JOIN (SELECT * FROM tblloanapplicationadditionalbureau WHERE isactive = 1) bu ON bu.loanapplicationid = x.loanapplicationid
    LEFT JOIN (SELECT * FROM tblloanbtsummary WHERE isactive = 1) bt ON bt.loanapplicationid = x.loanapplicationid
    LEFT JOIN (SELECT * FROM tblemploymentudhyamdetails WHERE isactive = 1) ud ON ud.applicantid = x.applicantid
    {_JOINS})""", "slv_customer")


@query("g2_customer", CUSTOMER_SQL)
def _(t):
    return customer.build(t.raw, t.raw, AS_OF, RUN_TS)


@query("g3_contract_perf_monthly", _doubles("""
    pos sell_pos due_interest due_principal previous_due outstanding_insurance accrued_interest_notdue provisions_value risk_weight roi current_ltv""", f"""
    SELECT {k.MONTHLY}, CASE WHEN m.isrestructured = '1' THEN TRUE WHEN m.isrestructured IN ('0', 'NULL') THEN FALSE END AS is_restructured,
           make_date(m.summaryyear, m.summarymonth, 1) AS snapshot_date, last_day(make_date(m.summaryyear, m.summarymonth, 1)) AS snapshot_month_end,
           d.typedetaildisplaytext AS loan_status, e.startdate AS engagement_date, pp.partnername AS partner_name, e.engagementtype || '_' || e.assignmenttype AS engagement_type, {_AUDIT}
    FROM tblloanmonthly m LEFT JOIN tbltypedetail d ON d.typedetailid = m.statustypedetailid AND d.isactive = 1
    LEFT JOIN tblportfoliopartnerengagementdetail e ON e.engagementid = m.engagementid AND e.isactive = 1
    LEFT JOIN mstportfoliopartner pp ON pp.partnerid = e.partnerid AND pp.isactive = 1 WHERE m.isactive = 1""", "slv_contract_perf_monthly"))
def _(t):
    return contract_perf_monthly.build(t.raw, t.raw, AS_OF, RUN_TS)


def _number_sql(c: str, strip: str = "trim", kind: str = "DECIMAL(20,2)") -> str:
    text = {"trim": f"TRIM({c})", "percent": f"TRIM(REPLACE({c}, '%', ''))", "noise": f"regexp_replace({c}, '[^0-9.\\-]', '', 'g')"}[strip]
    return f"CAST(CASE WHEN regexp_matches({text}, '^-?[0-9]+(\\.[0-9]+)?$') THEN CAST({text} AS {kind}) END AS DOUBLE)"


_LABEL_COLS = ", ".join(f"d_{n}.typedetaildescription AS {n}" for n in k.PROPERTY_LABELS)
_LABEL_JOINS = "\n".join(f"LEFT JOIN tbltypedetail d_{n} ON d_{n}.typedetailid = {a}.{c}" for n, (a, c) in k.PROPERTY_LABELS.items())
_SEEN = "(sur.technicaladdress IS NOT NULL AND sur.technicaladdress <> '0')"
_ADDRESS_TAIL = " || ".join(f"CASE WHEN COALESCE(TRIM(leg.{c}), '') = '' THEN '' ELSE ', ' || TRIM(leg.{c}) END" for c in k.LEGAL_ADDRESS[1:])


def _newest_loan(table: str) -> str:
    return _newest(table, "lastmodifiedon DESC")


ASSET_SQL = _doubles("""agreement_land_rate_per_sqft agreement_buildup_existing_rate_per_sqft agreement_buildup_proposed_rate_per_sqft
    agreement_super_buildup_rate_per_sqft revised_market_value""", f"""
    SELECT x.loanapplicationid AS loan_application_id, {k.PROPERTY}, {k.PROPERTY_FACTS}, {_LABEL_COLS},
           COALESCE(x.isfirstproperty = 1, FALSE) AS is_first_property, x.isnegativearea = 1 AS is_negative_area,
           CAST(CASE WHEN regexp_matches(TRIM(x.propertyareasquareft), '^-?[0-9]+$') THEN CAST(TRIM(x.propertyareasquareft) AS DECIMAL(20,0)) END AS DOUBLE) AS property_area_sqft,
           {_number_sql("x.mvofproperty", "noise")} AS market_value,
           CASE WHEN {_SEEN} THEN sur.technicaladdress ELSE COALESCE(x.propertyaddress, '') || ' ' || COALESCE(x.landmark, '') END AS property_address,
           CASE WHEN {_SEEN} THEN vc.cityname ELSE oc.cityname END AS property_city, CASE WHEN {_SEEN} THEN sur.pacitytehsiltalukatownid ELSE oc.cityid END AS property_city_id,
           CASE WHEN {_SEEN} THEN vd.districtname ELSE od.districtname END AS property_district, CASE WHEN {_SEEN} THEN sur.padistrictid ELSE oc.districtid END AS property_district_id,
           CASE WHEN {_SEEN} THEN vs.statename ELSE os.statename END AS property_state, CASE WHEN {_SEEN} THEN sur.pastateid ELSE os.stateid END AS property_state_id,
           TRY_CAST(CASE WHEN {_SEEN} THEN TRIM(sur.papincode) ELSE TRIM(x.pincode) END AS INT) AS property_pincode,
           {_number_sql("sur.latitude", "noise", "DECIMAL(20,8)")} * CASE WHEN sur.latitude ILIKE '%S%' THEN -1 ELSE 1 END AS latitude,
           {_number_sql("sur.longitude", "noise", "DECIMAL(20,8)")} * CASE WHEN sur.longitude ILIKE '%W%' THEN -1 ELSE 1 END AS longitude,
           sur.isitselfoccupiedpropertybyapplicanttypedetailid = 1 AS is_self_occupied, leg.vendorclearandmarketabletitletypedetailid = 1 AS title_clear,
           val.iscompliantwithndmaguidelines = 1 AS is_ndma_compliant, {_number_sql("ds.documentvalue", "noise")} AS agreement_value,
           {_number_sql("val.valuationtotalfairmarketvalue", "noise")} AS fair_market_value, {_number_sql("val.valuationlandarea")} AS land_area_sqft,
           {_number_sql("val.valuationlandarearatepersquarefeet")} AS land_rate_per_sqft, {_number_sql("val.valuationbuiltupareaexisting")} AS buildup_existing_sqft,
           {_number_sql("val.valuationbuiltupareaproposed")} AS buildup_proposed_sqft, {_number_sql("val.valuationsuperbuiltuparea")} AS super_buildup_sqft,
           {_number_sql("val.valuationbuilding", "percent")} AS building_pct, {_number_sql("val.valuationunitbeingfunded", "percent")} AS unit_funded_pct,
           val.valuationlandarearatepersquarefeet AS buildup_existing_rate_per_sqft, lf.reportreceiveddate AS legal_report_received_date,
           TRIM(COALESCE(TRIM(leg.houseno), '') || {_ADDRESS_TAIL}) AS legal_address,
           CAST(tf.firingdate AS DATE) AS tech_firing_date, CAST(tf.reportreceiveddate AS DATE) AS tech_report_received_date,
           CAST(tr.propertyvisitdate AS DATE) AS tech_visit_date, rp.revisedmarketvalue AS revised_market_value,
           COALESCE(rp.valuationdate, rp.createdon) AS revised_valuation_date, ta.agencyname AS tech_agency_name, la.agencyname AS legal_agency_name,
           TIMESTAMP '1998-06-30 18:30:15' AS silver_loaded_at, '19980630183015' AS silver_batch_id
    FROM tblapplicationpropertydetail x
    LEFT JOIN {_newest_loan("tblloantechnicalpropertysurrounding")} sur ON sur.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest_loan("tblloantechnicaldiligencevaluation")} val ON val.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest_loan("tblloanapplicationdisbursaldetail")} ds ON ds.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest_loan("tblloantechnicalreportvetting")} vet ON vet.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest_loan("tblloanlegalreport")} leg ON leg.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest_loan("tblloanlegalfiring")} lf ON lf.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest_loan("tblloantechnicalreport")} tr ON tr.loanapplicationid = x.loanapplicationid
    LEFT JOIN {_newest_loan("tblloanrevpropvaluation")} rp ON rp.loanapplicationid = x.loanapplicationid
    LEFT JOIN (SELECT f.* FROM tblloantechnicalfiring f WHERE isactive = 1 AND (loanapplicationid, loantechnicalfiringid) IN (
                   SELECT (loanapplicationid, loantechnicalfiringid) FROM tblloantechnicalreportvetting WHERE isactive = 1)
               QUALIFY ROW_NUMBER() OVER (PARTITION BY f.loanapplicationid ORDER BY f.lastmodifiedon DESC) = 1) tf ON tf.loanapplicationid = x.loanapplicationid
    LEFT JOIN mstcity oc ON oc.cityid = x.cityid AND oc.isactive = 1 LEFT JOIN mstcity vc ON vc.cityid = sur.pacitytehsiltalukatownid AND vc.isactive = 1
    LEFT JOIN mstdistrict od ON od.districtid = x.districtid AND od.isactive = 1 LEFT JOIN mstdistrict vd ON vd.districtid = sur.padistrictid AND vd.isactive = 1
    LEFT JOIN mststate os ON os.stateid = x.stateid AND os.isactive = 1 LEFT JOIN mststate vs ON vs.stateid = sur.pastateid AND vs.isactive = 1
    LEFT JOIN mstagency ta ON ta.agencyid = tf.agencyid AND ta.isactive = 1 LEFT JOIN mstagency la ON la.agencyid = lf.agencyid AND la.isactive = 1
    {_LABEL_JOINS} WHERE x.isactive = 1""", "slv_asset")


@query("g4_asset", ASSET_SQL)
def _(t):
    return asset.build(t.raw, t.raw, AS_OF, RUN_TS)


@query("g5_channel_partner", _doubles("is_standard_payout", f"""
    SELECT x.dsaid AS dsa_id, x.entityid AS entity_id, x.isactive, x.isdormant, x.baselocation AS base_location_branch_id, {k.RENEWAL},
           {k.REQUEST}, ct.typedetaildisplaytext AS channel_type, ot.typedetaildisplaytext AS type_of_organisation_type_detail_id_value,
           qt.typedetaildisplaytext AS organisation_type_id_value, ap.typedetaildisplaytext AS agreement_status,
           CASE WHEN ap.typedetailcode = 'Initiated' THEN 'FI Positive' ELSE 'FI Negative' END AS fi_status, COALESCE(c.n, 0) AS covered_branch_count, {_AUDIT}
    FROM tbldsa x LEFT JOIN {_newest("tbldsarenewal", "lastmodifiedon DESC", "dsaid")} r USING (dsaid)
    LEFT JOIN tbldsarequest q ON q.draftdsaid = r.dsacode LEFT JOIN tbltypedetail ct ON ct.typedetailid = x.channeltypetypedetailid
    LEFT JOIN tbltypedetail ot ON ot.typedetailid = r.typeoforganisationtypedetailid LEFT JOIN tbltypedetail qt ON qt.typedetailid = q.typeoforganisationtypedetailid
    LEFT JOIN tbltypedetail ap ON ap.typedetailid = r.approvalstatustypedetailid
    LEFT JOIN (SELECT entityid, COUNT(*) AS n FROM tblentitycoveredbranch WHERE isactive = 1 GROUP BY 1) c ON c.entityid = x.entityid WHERE x.isactive = 1""", "slv_channel_partner"))
def _(t):
    return channel_partner.build(t.raw, t.raw, AS_OF, RUN_TS)


@query("g6_repayment_behavior", _doubles("due_amount principal interest closing_balance applicable_roi", f"""
    SELECT {k.PAID} FROM tblloanapplicationpayschedule s
    JOIN tblloanpaymentadjust a ON a.loanapplicationid = s.loanapplicationid AND a.payscheduleid = s.payscheduleid
    WHERE s.isactive = 1 AND a.isactive = 1 AND s.duedate <= DATE '1998-06-30'"""))
def _(t):
    return repayment_behavior.build(t.raw, t.raw, AS_OF, RUN_TS)


EMPLOYEE_SQL = f"""
    SELECT e.employeeid AS employee_id, UPPER(TRIM(e.employeecode)) AS employee_code, TRIM(e.employeename) AS employee_name,
           CAST(e.basebranchid AS INT) AS base_branch_id, b.branchname AS base_branch_name, e.departmentid AS department, e.designationtypedetailid AS designation,
           d.typedetaildescription AS designation_name, e.designationleveltypedetailid AS designation_level, CAST(e.parentemployeeid AS INT) AS parent_employee_id,
           CAST(e.joiningdate AS DATE) AS joining_date, CAST(e.relivingdate AS DATE) AS relieving_date, e.isresigned AS is_resigned, TRUE AS is_active, e.entityid AS entity_id,
           u.userid AS user_id, u.parententityid AS parent_entity_id, u.usertypedetailid AS user_typedetail_id, ub.userbranchid AS user_branch_id, ub.branchid AS branch_id,
           s.* EXCLUDE (sales_officer_emp_id), e.createdon AS record_created_at, e.lastmodifiedon AS record_modified_at, {_AUDIT}
    FROM {_newest("tblemployee", "lastmodifiedon DESC NULLS LAST", "employeeid")} e
    LEFT JOIN ({p.SCORECARD_SQL}) s ON s.sales_officer_emp_id = e.employeeid
    LEFT JOIN (SELECT entityid, MAX(branchname) AS branchname FROM mstbranch WHERE isactive = 1 GROUP BY 1) b ON b.entityid = e.entityid
    LEFT JOIN tbltypedetail d ON d.typedetailid = e.designationtypedetailid
    LEFT JOIN tbluser u ON u.entityid = e.entityid AND u.isactive = 1 LEFT JOIN tbluserbranch ub ON ub.userid = u.userid AND ub.isactive = 1"""


@query("g7_employee", EMPLOYEE_SQL)
def _(t):
    return employee.build(t.raw, t.raw, AS_OF, RUN_TS)


_BRANCH_SQL = f"""
    SELECT CAST(b.branchid AS INT) AS branch_id, TRIM(b.branchname) AS branch_name, UPPER(TRIM(b.branchcity)) AS branch_city, UPPER(TRIM(b.statename)) AS state_name,
           TRIM(b.branchaddress) AS branch_address, CAST(NULLIF(TRIM(b.latitude), '') AS DOUBLE) AS latitude, CAST(NULLIF(TRIM(b.longitude), '') AS DOUBLE) AS longitude,
           UPPER(TRIM(b.gstin)) AS gstin, CAST(b.regionid AS INT) AS region_id, TRIM(r.regionname) AS region_name, CAST(r.zoneid AS INT) AS zone_id, TRIM(z.zonename) AS zone_name,
           b.branchinchargeemployeeid AS branch_incharge_emp_id, TRIM(e.employeename) AS branch_incharge_name,
           TRIM(e.employeename) || ' - ' || TRIM(e.employeecode) AS branch_incharge_name_and_code, TRIM(e.newemployeeid) AS new_employee_id, TRIM(b.navcode) AS nav_code,
           TRIM(b.cersaicode) AS cersai_code, b.createdon AS record_created_at, b.lastmodifiedon AS record_modified_at, {_AUDIT}
    FROM {_newest("mstbranch", "lastmodifiedon DESC NULLS LAST", "branchid")} b LEFT JOIN mstregion r ON r.regionid = b.regionid
    LEFT JOIN mstzone z ON z.zoneid = r.zoneid LEFT JOIN tblemployee e ON e.employeeid = b.branchinchargeemployeeid"""
_QUALITY_COLS = ", ".join([*(f"COALESCE(q.{c}, 0) AS {c}" for c in k.BRANCH_QUALITY), "q.gross_npa_pct",
                           "COALESCE(st.active_employee_count, 0) AS active_employee_count", "COALESCE(st.no_of_fos, 0) AS no_of_fos",
                           "COALESCE(dp.active_dsa_count, 0) AS active_dsa_count"])
_QUALITY_JOINS = f"""LEFT JOIN ({p.QUALITY_SQL}) q ON q.branch_id = x.branch_id LEFT JOIN ({p.STAFF_SQL}) st ON st.base_branch_id = x.branch_id
    LEFT JOIN (SELECT base_location_branch_id, COUNT(*) AS active_dsa_count FROM slv_channel_partner GROUP BY 1) dp ON dp.base_location_branch_id = x.branch_id"""


BRANCH_SQL = f"""
    SELECT x.*, {", ".join(f"COALESCE(a.{c}, 0) AS {c}" for c in ["total_loans_originated", *k.BRANCH_ACTIVITY])}, {_QUALITY_COLS}
    FROM ({_BRANCH_SQL}) x LEFT JOIN ({p.ACTIVITY_SQL}) a ON a.branch_id = x.branch_id {_QUALITY_JOINS}"""


@query("g8_branch", BRANCH_SQL)
def _(t):
    return branch.build(t.raw, t.raw, AS_OF, RUN_TS)


COLLECTIONS_SQL = _doubles("pos valuation_distress_sale_value", f"""
    SELECT s.loanduestatusid AS loan_due_status_id, s.loanapplicationid AS loan_application_id, CAST(s.transactiondate AS DATE) AS transaction_date, s.pos,
           CAST(COALESCE(s.unadjustedamount, 0) + COALESCE(CAST(o.total_emi_due_amount AS DECIMAL(18,2)), 0) AS DOUBLE) AS total_demand,
           o.cnt_emi_due, o.total_emi_due_amount, o.principal_over_due, o.interest_over_due, CAST(s.maxdeliquencyday AS INT) AS max_dpd,
           s.deliquencybktdetailid AS dpd_bucket, COALESCE(TRIM(s.linkednpaloanid) <> '', FALSE) OR s.isnpa = 1 AS is_npa, COALESCE(s.npastartdate, l.started) AS npa_start_date,
           COALESCE(CAST(r.receipt_count AS INT), 0) AS daily_receipt_count, r.last_paid_mode_id, r.last_paid_mode, r.last_paid_date, r.last_collected_amount,
           r.total_receipt_amount, c.total_bounce_amount, c.penal_charge_count, c.total_penal_charge_amount, c.total_bounce_amount_adjust, c.total_penal_charge_amount_adjust,
           v.valuationdistresssalevalue AS valuation_distress_sale_value, COALESCE(CAST(c.bounce_count AS INT), 0) AS daily_bounces, f.followuptypedetailid AS followup_type_id,
           d.typedetaildescription AS followup_type, ld.is_employee_loan, m.income_considered, ls.last_sanction_by, s.createdon AS record_created_at,
           s.lastmodifiedon AS record_modified_at, {_AUDIT}
    FROM tblloanduestatus s LEFT JOIN ({p.RECEIPT_SQL}) r ON r.loanapplicationid = s.loanapplicationid
    LEFT JOIN ({p.CHARGE_SQL}) c ON c.loanapplicationid = s.loanapplicationid LEFT JOIN ({p.OVERDUE_SQL}) o ON o.loanapplicationid = s.loanapplicationid
    LEFT JOIN {_newest("tblloantechnicaldiligencevaluation", "lastmodifiedon DESC", where="TRUE")} v ON v.loanapplicationid = s.loanapplicationid
    LEFT JOIN {_newest("tblcollectionfollowup", "followupdate DESC", where="isactive = 1 AND islastrecord = 1")} f ON f.loanapplicationid = s.loanapplicationid
    LEFT JOIN tbltypedetail d ON d.typedetailid = f.followuptypedetailid LEFT JOIN ({p.SANCTIONER_SQL}) ls ON ls.loanapplicationid = s.loanapplicationid
    LEFT JOIN (SELECT loanapplicationid, MAX(npastartdate) AS started FROM tblloanduestatus WHERE isactive = 1 GROUP BY 1) l ON l.loanapplicationid = TRY_CAST(TRIM(s.linkednpaloanid) AS BIGINT)
    LEFT JOIN slv_loan_details ld ON ld.loan_application_id = s.loanapplicationid
    LEFT JOIN (SELECT loan_application_id, income_considered FROM slv_customer QUALIFY ROW_NUMBER() OVER (PARTITION BY loan_application_id
               ORDER BY CASE WHEN is_main_applicant THEN 0 ELSE 1 END, record_modified_at DESC) = 1) m ON m.loan_application_id = s.loanapplicationid
    WHERE s.isactive = 1""")


@query("g9_collections_daily", COLLECTIONS_SQL)
def _(t):
    return collections_daily.build(t.raw, t.raw, AS_OF, RUN_TS)


_SIGNALS = {"multi_loan_stress": w.STRESS_SQL, "negative_area_flag": w.AREA_SQL, "non_starter_sma1_flag": w.NON_STARTER_SQL, "active_sma2_flag": w.SMA2_SQL,
            "ach_not_registered_sma1_flag": w.ACH_SQL, "construction_delay_sma1_flag": w.CONSTRUCTION_SQL, "title_doc_delay_flag": w.TITLE_SQL,
            "bounce_fy_sma1_flag": w.BOUNCE_SQL}


WARNING_SQL = f"""
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY s.loan_application_id) + (SELECT MAX(ews_id) FROM slv_early_warning) AS BIGINT) AS ews_id,
           CAST(s.loan_application_id AS VARCHAR) AS loan_application_id, DATE '1998-06-30' AS signal_date, 'MONTH_END' AS snapshot_type, DATE '1998-06-30' AS snapshot_month,
           dpd_trend_direction, high_foir_flag, {", ".join(_SIGNALS)}, ews_risk_score, {w.GRADE_SQL} AS ews_risk_grade, {w.ACTION_SQL} AS recommended_action,
           {w.INDICATOR_SQL} AS ews_indicators, previous AS previous_month_ews_score, ews_risk_score - previous AS score_variance, {w.TREND_OF_SCORE_SQL} AS score_trend,
           TIMESTAMP '1998-06-30 18:30:15' AS gold_loaded_at, '19980630_183015' AS gold_batch_id, DATE '1998-06-30' AS reporting_period
    FROM (SELECT *, {w.SCORE_SQL} AS ews_risk_score FROM (
        SELECT ld.loan_application_id, tr.dpd_trend_direction, COALESCE(ld.final_foir_pct > 65, FALSE) AS high_foir_flag,
               {", ".join(f"COALESCE(s_{n}.{n}, FALSE) AS {n}" for n in _SIGNALS)}
        FROM slv_loan_details ld LEFT JOIN ({w.TREND_SQL}) tr ON tr.loan_application_id = ld.loan_application_id
        {" ".join(f"LEFT JOIN ({sql}) s_{n} ON s_{n}.loan_application_id = ld.loan_application_id" for n, sql in _SIGNALS.items())})) s
    LEFT JOIN ({w.PREVIOUS_SQL}) h ON h.loan_application_id = s.loan_application_id
    WHERE NOT EXISTS (SELECT 1 FROM slv_early_warning e WHERE e.loan_application_id = CAST(s.loan_application_id AS VARCHAR) AND e.signal_date = DATE '1998-06-30'
                      AND e.snapshot_type = 'MONTH_END')"""


@query("g10_early_warning", WARNING_SQL)
def _(t):
    return early_warning.build(t.raw, t.raw, AS_OF, RUN_TS)


HISTORY_SQL = f"""
    WITH marks AS (SELECT branch_id, date_trunc('month', login_date) AS m, 'total_logins' AS kind FROM slv_loan_details
              UNION ALL SELECT branch_id, date_trunc('month', last_sanction_date), 'total_loans_sanctioned' FROM slv_loan_details
              UNION ALL SELECT branch_id, date_trunc('month', last_booked_date), 'total_loans_booked' FROM slv_loan_details
              UNION ALL SELECT branch_id, date_trunc('month', last_disbursal_date), 'total_loans_disbursed' FROM slv_loan_details
              UNION ALL SELECT branch_id, date_trunc('month', createdon), 'total_loans_disbursal_cancelled' FROM slv_loan_details JOIN tblloanapplicationstatushistory
              ON loanapplicationid = loan_application_id WHERE isactive = 1 AND loanstatustypedetailid = 1619),
    monthly AS (SELECT branch_id, CAST(m AS DATE) AS day, {", ".join(f"COUNT(*) FILTER (WHERE kind = '{c}') AS {c}" for c in k.BRANCH_ACTIVITY)} FROM marks GROUP BY 1, 2)
    SELECT CAST(g.m AS DATE) AS snapshot_date, x.*, COALESCE(o.n, 0) AS total_loans_originated, {", ".join(f"COALESCE(mo.{c}, 0) AS {c}" for c in k.BRANCH_ACTIVITY)}, {_QUALITY_COLS}
    FROM ({_BRANCH_SQL}) x CROSS JOIN generate_series(DATE '1996-06-01', DATE '1998-06-01', INTERVAL 1 MONTH) AS g(m)
    LEFT JOIN monthly mo ON mo.branch_id = x.branch_id AND mo.day = CAST(g.m AS DATE)
    LEFT JOIN (SELECT branch_id, COUNT(*) AS n FROM slv_loan_details GROUP BY 1) o ON o.branch_id = x.branch_id {_QUALITY_JOINS}"""


@query("g11_branch_historical", HISTORY_SQL)
def _(t):
    built = Tables.from_frames({"slv_branch": branch.build(t.raw, t.raw, AS_OF, RUN_TS), "slv_loan_details": t.raw["slv_loan_details"]})
    return branch.build_history(t.raw, built, AS_OF, RUN_TS)


@query("g12_enquiry", f"""
    SELECT l.leadid AS lead_id, TRIM(l.leadnumber) AS lead_number, l.salesforceid AS salesforce_id, TRIM(l.leadsource) AS lead_source, TRIM(l.leadsubsource) AS lead_sub_source,
           UPPER(l.devicetype) AS device_type, a.typedetaildescription AS sourcing_channel, b.typedetaildescription AS campaign_name, l.dsaid AS dsa_id,
           {_name_sql("l.applicantfirstname", "l.applicantmiddlename", "l.applicantlastname")} AS applicant_name, CAST(l.amountrequest AS DOUBLE) AS amount_requested,
           l.loanproductid AS product_id, c.typedetaildescription AS current_status, l.isconvertedtoloanapplication AS is_converted_to_loan, l.branchid AS branch_id,
           CAST(l.createdon AS DATE) AS lead_created_date, f.last_followup_date, f.total_followups,
           CAST(date_diff('day', CAST(l.createdon AS DATE), CAST(f.last_followup_date AS DATE)) AS INT) AS days_to_conversion,
           l.createdon AS record_created_at, l.lastmodifiedon AS record_modified_at, {_AUDIT}
    FROM tbllead l LEFT JOIN (SELECT leadid, MAX(createdon) AS last_followup_date, COUNT(*) AS total_followups FROM tblleadfollowup GROUP BY 1) f USING (leadid)
    LEFT JOIN tbltypedetail a ON a.typedetailid = l.sourcingchannelpartnertypedetailid LEFT JOIN tbltypedetail b ON b.typedetailid = l.campaniantypedetailid
    LEFT JOIN tbltypedetail c ON c.typedetailid = l.currentstatustypedetailid""")
def _(t):
    return enquiry.build(t.raw, t.raw, AS_OF, RUN_TS)


@query("g13_loan_processing", f"""
    SELECT t.loanapplicationid AS loan_application_id, t.total_tranches, CAST(t.last_date AS DATE) AS last_tranche_date, CAST(t.amount AS DOUBLE) AS last_tranche_amount,
           CAST(t.category AS VARCHAR) AS cheque_favouring_category, CAST(t.kind AS VARCHAR) AS payment_type, CAST(v.pddonebyentityid AS VARCHAR) AS pd_done_by,
           CAST(v.dateperformed AS DATE) AS pd_done_date, CAST(v.pdstatustypedetailid AS VARCHAR) AS pd_status, CAST(h.accepted AS DATE) AS file_acceptance_date,
           t.record_created_at, t.record_modified_at, {_AUDIT}
    FROM (SELECT loanapplicationid, CAST(COUNT(*) AS INT) AS total_tranches, MAX(disburseddate) AS last_date, MIN(createdon) AS record_created_at,
                 MAX(lastmodifiedon) AS record_modified_at, arg_max(disbursedamount, (disburseddate, favouringid)) AS amount,
                 arg_max(favouringcategorytypedetailid, (disburseddate, favouringid)) AS category, arg_max(transactiontypedetailid, (disburseddate, favouringid)) AS kind
          FROM tblloanapplicationdisbursmentfavouring WHERE isactive = 1 GROUP BY 1) t
    LEFT JOIN {_newest("tblloanapplicationpdreport", "lastmodifiedon DESC")} v USING (loanapplicationid)
    LEFT JOIN (SELECT loanapplicationid, arg_max(applicationaccepteddate, lastmodifiedon) AS accepted FROM tblloanapplicationstatushistory
               WHERE isactive = 1 AND isapplicationaccepted = 1 GROUP BY 1) h USING (loanapplicationid)""")
def _(t):
    return loan_processing.build(t.raw, t.raw, AS_OF, RUN_TS)


# The same tables over silver tables that were built, not derived.

_BUILDS = {"slv_loan_details": loan_details.build, "slv_customer": customer.build, "slv_contract_perf_monthly": contract_perf_monthly.build,
           "slv_asset": asset.build, "slv_channel_partner": channel_partner.build, "slv_employee": employee.build, "slv_branch": branch.build}
_BUILT: dict[tuple[str, str], Tables] = {}


def built(t: Inputs) -> Tables:
    """The silver tables, each built and written when first used in a session. The history stays the derived one."""
    def load(name: str):
        return written(_BUILDS[name](t.raw, tables, AS_OF, RUN_TS), name) if name in _BUILDS else t.raw[name]

    tables = _BUILT.setdefault((t.spark.sparkContext.applicationId, t.sf_dir), Tables(load))
    return tables


def _chained(sql: str) -> str:
    """The SQL with built tables in place of the derived ones."""
    parts = EXACT | {"slv_employee": EMPLOYEE_SQL}
    inner = {name: f"built_{name} AS MATERIALIZED ({text})" for name, text in parts.items()}
    body = ",\n".join(inner.values())
    body += ",\n" + sql.strip()[4:] if sql.strip().startswith("WITH") else "\n" + sql
    for name in parts:
        body = re.sub(rf"\b{name}\b(?! AS MATERIALIZED)", f"built_{name}", body)
    return "WITH " + body.replace("built_built_", "built_")


@query("g7_employee_chained", _chained(EMPLOYEE_SQL))
def _(t):
    return employee.build(t.raw, built(t), AS_OF, RUN_TS)


@query("g8_branch_chained", _chained(BRANCH_SQL))
def _(t):
    return branch.build(t.raw, built(t), AS_OF, RUN_TS)


@query("g9_collections_daily_chained", _chained(COLLECTIONS_SQL))
def _(t):
    return collections_daily.build(t.raw, built(t), AS_OF, RUN_TS)


@query("g10_early_warning_chained", _chained(WARNING_SQL))
def _(t):
    return early_warning.build(t.raw, built(t), AS_OF, RUN_TS)


@query("g11_branch_historical_chained", _chained(HISTORY_SQL))
def _(t):
    return branch.build_history(t.raw, built(t), AS_OF, RUN_TS)
