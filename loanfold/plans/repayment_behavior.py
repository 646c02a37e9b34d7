"""slv_repayment_behavior: one row per due instalment and payment that settled it."""

from datetime import date, datetime

from pyspark.sql import DataFrame

from ..operators.receipts import attach_receipts, instalment_payments, receipts_union
from ..sources.tables import Tables
from .common import renamed

# Output name -> source column.
REPAYMENT = {
    "pay_schedule_id": "payscheduleid", "loan_application_id": "loanapplicationid", "head": "head",
    "due_date": "duedate", "due_amount": "dueamount", "principal": "principal", "interest": "interst",
    "closing_balance": "closingbalance", "applicable_roi": "applicableroi",
    "payment_received_date": "paymentreceiveddate", "delinquent_days": "delinquentdays",
    "clearence_flag": "clearenceflag", "paytype": "paytype", "id": "id",
}


def build(raw: Tables, silver: Tables, as_of: date, run_ts: datetime, with_receipts: bool = False) -> DataFrame:
    """with_receipts adds date, amount and mode of the payment behind each row."""
    df = instalment_payments(raw["tblloanapplicationpayschedule"], raw["tblloanpaymentadjust"], as_of)
    df = df.select(*renamed(REPAYMENT))
    if not with_receipts:
        return df
    receipts = receipts_union(
        raw["tblloanapplicationpresentationdetail"], raw["tblloanapplicationpresentationbatch"],
        raw["tblloanapplicationmanualreceipt"], raw["tbltypedetail"],
    ).withColumnRenamed("loanapplicationid", "loan_application_id")
    return attach_receipts(df, receipts, loan="loan_application_id")
