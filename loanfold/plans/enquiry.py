"""slv_enquiry: one row per lead."""

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.text import join_name, trimmed
from ..operators.loans import days_to_followup, lead_followups
from ..operators.lookup import decode
from ..sources.sinks import audit_stamp
from ..sources.tables import Tables


def build(raw: Tables, silver: Tables, as_of: date, run_ts: datetime) -> DataFrame:
    leads = raw["tbllead"].join(lead_followups(raw["tblleadfollowup"]), "leadid", "left")
    leads = decode(leads, raw["tbltypedetail"], {
        "sourcing_channel": "sourcingchannelpartnertypedetailid", "campaign_name": "campaniantypedetailid",
        "current_status": "currentstatustypedetailid"})
    df = leads.select(
        F.col("leadid").alias("lead_id"), trimmed("leadnumber").alias("lead_number"),
        F.col("salesforceid").alias("salesforce_id"), trimmed("leadsource").alias("lead_source"),
        trimmed("leadsubsource").alias("lead_sub_source"), F.upper("devicetype").alias("device_type"),
        "sourcing_channel", "campaign_name", F.col("dsaid").alias("dsa_id"),
        join_name("applicantfirstname", "applicantmiddlename", "applicantlastname").alias("applicant_name"),
        F.col("amountrequest").alias("amount_requested"), F.col("loanproductid").alias("product_id"),
        "current_status", F.col("isconvertedtoloanapplication").alias("is_converted_to_loan"),
        F.col("branchid").alias("branch_id"), F.to_date("createdon").alias("lead_created_date"),
        "last_followup_date", "total_followups",
        days_to_followup("createdon", "last_followup_date").alias("days_to_conversion"),
        F.col("createdon").alias("record_created_at"), F.col("lastmodifiedon").alias("record_modified_at"),
    )
    return audit_stamp(df, run_ts)
