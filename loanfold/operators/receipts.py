"""Money coming in: receipts, presentations, charges, overdue instalments and their settlement."""

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import on_day
from ..functions.flags import active, not_blank, null_or_zero
from ..functions.numbers import MONEY, count_if, money, money_sum, sum_if
from ..functions.text import _col
from .dedup import newest_per_key, one_per_key
from .lookup import attach, decode, dimension
from .skew import join_to_unique

# Codes of the source system.
RECEIPT_CLEARED = 219
PRESENTATION_CLEARED = 2066
INSTALMENT_FEE = 1861
BOUNCE_CHARGE = 1
PENAL_CHARGE = 2
LOAN_ACTIVE = 189
UNDERWRITING_APPROVED = 237
TAG_PRESENTATION = "presentation"
TAG_MANUAL = "manualreceipt"


def cleared_receipts(receipts: DataFrame) -> DataFrame:
    return receipts.filter(active() & (F.col("statustypedetailid") == RECEIPT_CLEARED))


def cleared_presentations(presentations: DataFrame) -> DataFrame:
    return presentations.filter(active() & (F.col("statustypedetailid") == PRESENTATION_CLEARED))


def receipt_summary(receipts: DataFrame, presentations: DataFrame, types: DataFrame) -> DataFrame:
    """Last payment and totals per loan over manual and presented receipts.

    Both sources go through one aggregation, so a loan with only one kind of receipt keeps its row.
    """
    none = lambda kind: F.lit(None).cast(kind)
    manual = cleared_receipts(receipts).select(
        "loanapplicationid", F.col("collectedthroughtypedetailid").alias("mode"),
        F.col("statusupdateddate").alias("paid_on"), F.col("collectedamount").alias("manual"),
        none(MONEY).alias("presented"), F.col("draftreceiptid").alias("receipt"),
    )
    presented = cleared_presentations(presentations).select(
        "loanapplicationid", none("bigint").alias("mode"), F.col("statusdate").alias("paid_on"),
        none(MONEY).alias("manual"), F.col("pdcachamount").alias("presented"), none("bigint").alias("receipt"),
    )
    summed = manual.unionByName(presented).groupBy("loanapplicationid").agg(
        F.max("mode").alias("last_paid_mode_id"),
        F.max("paid_on").alias("last_paid_date"),
        F.coalesce(F.max("presented"), F.max("manual")).alias("last_collected_amount"),
        F.count_distinct("receipt").alias("receipt_count"),
        (money_sum("manual") + money_sum("presented")).alias("total_receipt_amount"),
    )
    return decode(summed, types, {"last_paid_mode": "last_paid_mode_id"})


def charge_summary(charges: DataFrame, loans: DataFrame, as_of: date) -> DataFrame:
    """Bounce and penal charges of the run date per known loan, and the part knocked off that day."""
    today = charges.filter(active() & on_day("chargedate", as_of))
    bounce, penal = F.col("typedetailchargeid") == BOUNCE_CHARGE, F.col("typedetailchargeid") == PENAL_CHARGE
    settled = on_day("knockoffdate", as_of)
    charge_id = "loanapplicationchargedetailid"
    summed = today.groupBy("loanapplicationid").agg(
        count_if(bounce, charge_id).alias("bounce_count"),
        sum_if(bounce, "totalcharge").alias("total_bounce_amount"),
        count_if(penal, charge_id).alias("penal_charge_count"),
        sum_if(penal, "totalcharge").alias("total_penal_charge_amount"),
        sum_if(bounce & settled, "totalcharge").alias("total_bounce_amount_adjust"),
        sum_if(penal & settled, "totalcharge").alias("total_penal_charge_amount_adjust"),
    )
    known = loans.select(F.col("loan_application_id").alias("loanapplicationid"))
    return summed.join(known, "loanapplicationid", "left_semi")


def active_loans(applications: DataFrame) -> DataFrame:
    return applications.filter(active() & (F.col("statustypedetailid") == LOAN_ACTIVE)).select("loanapplicationid")


def past_due(schedule: DataFrame, as_of: date) -> DataFrame:
    return schedule.filter(active() & (F.col("dueamount") > 0) & (F.col("duedate") < F.lit(as_of)))


def overdue_summary(schedule: DataFrame, applications: DataFrame, as_of: date) -> DataFrame:
    """Past-due instalments of active loans. Sums per loan come first, the join is one to one."""
    summed = past_due(schedule, as_of).groupBy("loanapplicationid").agg(
        F.count("duedate").alias("cnt_emi_due"),
        F.sum("dueamount").alias("total_emi_due_amount"),
        F.sum("principal").alias("principal_over_due"),
        F.sum("interst").alias("interest_over_due"),
    )
    return summed.join(active_loans(applications), "loanapplicationid", "left_semi")


def total_demand(unadjusted, overdue) -> Column:
    return (money(unadjusted) + money(overdue)).cast(MONEY)


def npa_flag(linked, own) -> Column:
    """A linked bad loan is named, or the loan is bad itself."""
    return not_blank(linked) | F.coalesce(_col(own) == 1, F.lit(False))


def last_sanctioner(underwriting: DataFrame, users: DataFrame, employees: DataFrame) -> DataFrame:
    """'name_code' of the employee behind the newest approved underwriting row of a loan."""
    employee = newest_per_key(employees, "entityid", "lastmodifiedon", carry=["employeename", "employeecode"])
    user = dimension(users, "userid", ["entityid"]).join(employee.drop("lastmodifiedon"), "entityid")
    person = user.select(F.col("userid").alias("createdby"), "employeename", "employeecode")
    approved = underwriting.filter(F.col("underwritingstatustypedetailid") == UNDERWRITING_APPROVED)
    rows = join_to_unique(approved.select("loanapplicationid", "createdby", "lastmodifiedon"), person, "createdby", "inner")
    newest = newest_per_key(rows, "loanapplicationid", "lastmodifiedon", carry=["employeename", "employeecode"])
    return newest.select("loanapplicationid",
                         F.concat("employeename", F.lit("_"), "employeecode").alias("last_sanction_by"))


def receipts_union(presentations: DataFrame, batches: DataFrame, receipts: DataFrame, types: DataFrame) -> DataFrame:
    """Presented and manual payments as one tagged stream."""
    text = {"_mode": "typedetaildisplaytext"}
    labels = dimension(types, "typedetailid", ["typedetaildisplaytext"])
    batch = dimension(batches, "presentationid", ["presentationtypedetailid", "isrepresentation"], active_only=True)
    presented = cleared_presentations(presentations).select(
        "loanapplicationid", "presentationdetailid", "presentationid", "isknockoff", "pdcachdate", "pdcachamount",
        "chequerefrenceno")
    presented = join_to_unique(presented, batch, "presentationid", "inner")
    presented = attach(presented, labels, ("presentationtypedetailid", "typedetailid"), text)
    again = F.coalesce(F.col("isrepresentation") == 1, F.lit(False))
    presented = presented.select(
        "loanapplicationid", F.col("presentationdetailid").alias("id"), "isknockoff",
        F.col("pdcachdate").alias("payment_date"), F.col("pdcachamount").alias("collected_amount"),
        F.col("presentationtypedetailid").alias("payment_mode_id"),
        F.when(again, F.concat("_mode", F.lit("_represented"))).otherwise(F.col("_mode")).alias("payment_mode"),
        F.col("chequerefrenceno").alias("reference_no"), F.lit(TAG_PRESENTATION).alias("paytype"),
    )
    manual = cleared_receipts(receipts).filter(F.col("feesfortypedetailid") == INSTALMENT_FEE)
    manual = attach(manual, labels, ("collectedthroughtypedetailid", "typedetailid"), text)
    manual = manual.select(
        "loanapplicationid", F.col("receiptid").alias("id"), "isknockoff",
        F.when(F.col("_mode") == "Cash", F.col("dateofcollection")).otherwise(F.col("statusupdateddate"))
        .alias("payment_date"),
        F.col("collectedamount").alias("collected_amount"),
        F.col("collectedthroughtypedetailid").alias("payment_mode_id"), F.col("_mode").alias("payment_mode"),
        F.col("chequenumber").alias("reference_no"), F.lit(TAG_MANUAL).alias("paytype"),
    )
    return presented.unionByName(manual)


def instalment_payments(schedule: DataFrame, adjustments: DataFrame, as_of: date) -> DataFrame:
    """Active instalments due by the run date with each payment that settled them."""
    due = schedule.filter(active() & (F.col("duedate") <= F.lit(as_of)))
    paid = adjustments.filter(active() & F.col("payscheduleid").isNotNull()).select(
        "loanapplicationid", "payscheduleid", "paytype", F.coalesce("presentationdetailid", "receiptid").alias("id")
    )
    return due.join(paid, ["loanapplicationid", "payscheduleid"])


def attach_receipts(payments: DataFrame, receipts: DataFrame, loan: str = "loanapplicationid") -> DataFrame:
    """Date, amount and mode of each payment, matched on loan, type tag and the merged payment id."""
    key = [loan, "paytype", "id"]
    unique = one_per_key(receipts, key, ["payment_date", "collected_amount", "payment_mode"])
    return payments.join(unique, key, "left")


def is_overdue(due, cleared, as_of: date) -> Column:
    return F.coalesce((_col(due) < F.lit(as_of)) & null_or_zero(cleared), F.lit(False))
