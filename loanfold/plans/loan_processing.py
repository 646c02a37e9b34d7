"""slv_loan_processing: one row per loan with a disbursal tranche."""

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.flags import active
from ..operators.dedup import newest_per_key
from ..operators.loans import tranche_summary
from ..sources.sinks import audit_stamp
from ..sources.tables import Tables
from .common import KEY, join_sides


def build(raw: Tables, silver: Tables, as_of: date, run_ts: datetime) -> DataFrame:
    visit = newest_per_key(raw["tblloanapplicationpdreport"].filter(active()), KEY, "lastmodifiedon",
                           carry=["pddonebyentityid", "pdstatustypedetailid", "dateperformed"])
    accepted = raw["tblloanapplicationstatushistory"].filter(active() & (F.col("isapplicationaccepted") == 1))
    accepted = newest_per_key(accepted, KEY, "lastmodifiedon", carry=["applicationaccepteddate"])
    df = join_sides(tranche_summary(raw["tblloanapplicationdisbursmentfavouring"]), KEY,
                    [visit.drop("lastmodifiedon"), accepted.drop("lastmodifiedon")])
    df = df.select(
        F.col(KEY).cast("bigint").alias("loan_application_id"), "total_tranches",
        F.to_date("last_tranche_date").alias("last_tranche_date"),
        F.col("disbursedamount").cast("decimal(14,2)").alias("last_tranche_amount"),
        F.col("favouringcategorytypedetailid").cast("string").alias("cheque_favouring_category"),
        F.col("transactiontypedetailid").cast("string").alias("payment_type"),
        F.col("pddonebyentityid").cast("string").alias("pd_done_by"),
        F.to_date("dateperformed").alias("pd_done_date"),
        F.col("pdstatustypedetailid").cast("string").alias("pd_status"),
        F.to_date("applicationaccepteddate").alias("file_acceptance_date"),
        "record_created_at", "record_modified_at",
    )
    return audit_stamp(df, run_ts)
