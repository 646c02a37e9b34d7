"""Days-past-due buckets, portfolio quality per group, branch and officer figures."""

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import in_month_of, on_day
from ..functions.flags import active, null_or_no, null_or_zero, truthy_text
from ..functions.numbers import count_if, percentage, rate_of_positive, share, sum_if, sum_if_any
from ..functions.text import _col
from ..sources.tables import Tables
from .dedup import newest_per_key, one_per_key
from .lookup import attach
from .slices import in_slices

# Upper bound in days and label of each days-past-due bucket, then the label beyond the last.
DPD_BUCKETS = (
    (0, "0"),
    (30, "SMA-0"),
    (60, "SMA-1"),
    (90, "SMA-2"),
    (365, "NPA (Sub-standard)"),
    (730, "Doubtful 1 (D1)"),
    (1095, "Doubtful 2 (D2)"),
)
DPD_BEYOND = "Doubtful 3 (D3)"

# Output column -> bucket it counts.
BUCKET_COUNTS = {
    "sma0_count": "SMA-0",
    "sma1_count": "SMA-1",
    "sma2_count": "SMA-2",
    "npa_sub_standard_count": "NPA (Sub-standard)",
    "doubtful1_count": "Doubtful 1 (D1)",
    "doubtful2_count": "Doubtful 2 (D2)",
    "doubtful3_count": "Doubtful 3 (D3)",
}

# Code and designation of the source system.
DISBURSAL_CANCELLED = 1619
FIELD_OFFICER = "FOS"


def dpd_bucket(days) -> Column:
    """Label of the bucket; NULL for NULL or negative days."""
    days = _col(days)
    label = F.when(days < 0, None)
    for upper, name in DPD_BUCKETS:
        label = label.when(days <= upper, name)
    return label.when(days > DPD_BUCKETS[-1][0], DPD_BEYOND)


def pos_after_sell(pos, sell_pct, loan_pct) -> Column:
    """Outstanding times the share in percent: the partner's, else the loan's own, else all of it."""
    sell_pct = _col(sell_pct)
    pct = F.when(null_or_zero(sell_pct), F.coalesce(_col(loan_pct), F.lit(100))).otherwise(sell_pct)
    return _col(pos).cast("decimal(18,2)") * (pct.cast("decimal(10,4)") * F.lit(0.01).cast("decimal(3,2)"))


def branch_activity(loans: DataFrame, status_history: DataFrame, as_of: date) -> DataFrame:
    """Loans per branch and what happened on the run date. Statuses are counted apart from loans."""
    per_branch = loans.groupBy("branch_id").agg(
        F.count("loan_application_id").alias("total_loans_originated"),
        sum_if(on_day("login_date", as_of), F.lit(1)).alias("total_logins"),
        sum_if(on_day("last_sanction_date", as_of), F.lit(1)).alias("total_loans_sanctioned"),
        sum_if(on_day("last_booked_date", as_of), F.lit(1)).alias("total_loans_booked"),
        sum_if(on_day("last_disbursal_date", as_of), F.lit(1)).alias("total_loans_disbursed"),
    )
    cancelled = cancelled_statuses(status_history).filter(on_day("createdon", as_of))
    cancelled = (
        cancelled.groupBy(F.col("loanapplicationid").alias("loan_application_id")).agg(F.count(F.lit(1)).alias("_n"))
        .join(loans.select("loan_application_id", "branch_id"), "loan_application_id")
        .groupBy("branch_id").agg(F.sum("_n").alias("total_loans_disbursal_cancelled"))
    )
    return per_branch.join(cancelled, per_branch["branch_id"].eqNullSafe(cancelled["branch_id"]), "left").select(
        *[per_branch[c] for c in per_branch.columns],
        F.coalesce("total_loans_disbursal_cancelled", F.lit(0)).alias("total_loans_disbursal_cancelled"),
    )


def cancelled_statuses(status_history: DataFrame) -> DataFrame:
    return status_history.filter(active() & (F.col("loanstatustypedetailid") == DISBURSAL_CANCELLED))


def latest_performance(due_status: DataFrame, disbursal: DataFrame, engagements: DataFrame,
                       engagement_loans: DataFrame, schedule: DataFrame) -> DataFrame:
    """One row per loan: outstanding, share after sell-down, days past due, bucket of the worst instalment."""
    status = newest_per_key(due_status.filter(active()), "loanapplicationid", "lastmodifiedon",
                            carry=["loanduestatusid", "pos", "maxdeliquencyday", "isnpa", "linkednpaloanid"])
    engagement = newest_per_key(disbursal.filter(active()), "loanapplicationid", "lastmodifiedon",
                                carry=["partnerengagementid"])
    sells = one_per_key(engagements.filter(active() & (F.col("engagementtype") == "SELL")), "engagementid", ["percentage"])
    own = one_per_key(engagement_loans.filter(active()), "loanapplicationid", ["percentage"])
    worst = schedule.groupBy("loanapplicationid").agg(F.max("delinquentdays").alias("worst_days"))
    joined = (
        status.join(engagement.select("loanapplicationid", "partnerengagementid"), "loanapplicationid", "left")
        .join(worst, "loanapplicationid", "left")
        .join(own.withColumnRenamed("percentage", "own_pct"), "loanapplicationid", "left")
    )
    joined = attach(joined, sells, ("partnerengagementid", "engagementid"), {"sell_pct": "percentage"})
    return joined.select(
        F.col("loanapplicationid").alias("loan_application_id"),
        "pos",
        pos_after_sell("pos", "sell_pct", "own_pct").alias("pos_after_sell"),
        dpd_bucket("worst_days").alias("dpd_bucket"),
        F.col("maxdeliquencyday").alias("dpd"),
        F.col("isnpa").alias("is_npa"),
        F.col("linkednpaloanid").isNotNull().alias("has_linked_npa"),
    )


def portfolio_quality(performance: DataFrame, group: str) -> DataFrame:
    """Counts, outstanding and bad-loan share per group of one-row-per-loan performance."""
    own_npa = truthy_text("is_npa")
    summed = performance.groupBy(group).agg(
        count_if(F.col("pos") > 0).alias("active_loan_count"),
        F.sum("pos").alias("total_pos"),
        F.sum("pos_after_sell").alias("total_pos_after_sell"),
        count_if(F.col("dpd") > 0).alias("dpd_count"),
        count_if(own_npa).alias("npa_count"),
        *[sum_if_any(F.col("dpd_bucket") == bucket, F.lit(1)).alias(name) for name, bucket in BUCKET_COUNTS.items()],
        sum_if(own_npa | F.col("has_linked_npa"), "pos").alias("npa_pos"),
    )
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in BUCKET_COUNTS]
    kept = ["active_loan_count", "total_pos", "total_pos_after_sell", "dpd_count", "npa_count", "npa_pos"]
    return summed.select(group, *kept, *zero, percentage("npa_pos", "total_pos").alias("gross_npa_pct"))


def staff_count(employees: DataFrame) -> DataFrame:
    """Active staff that has not resigned, and field officers among it, per base branch."""
    there = employees.filter(F.col("is_active") & null_or_no("is_resigned"))
    officer = F.upper("designation_name") == FIELD_OFFICER
    per_employee = there.groupBy("base_branch_id", "employee_id").agg(F.bool_or(officer).alias("_officer"))
    return per_employee.groupBy("base_branch_id").agg(
        F.count("employee_id").alias("active_employee_count"),
        count_if(F.col("_officer"), "employee_id").alias("no_of_fos"),
    )


def partner_count(partners: DataFrame) -> DataFrame:
    return partners.groupBy("base_location_branch_id").agg(F.count("dsa_id").alias("active_dsa_count"))


def officer_loans(loans: DataFrame, as_of: date) -> DataFrame:
    return loans.groupBy("sales_officer_emp_id").agg(
        F.count_distinct("loan_application_id").alias("loans_onboarded_total"),
        count_if(in_month_of("last_disbursal_date", as_of)).alias("loans_onboarded_mtd"),
        F.sum(F.coalesce("total_disbursed_amount", F.lit(0))).alias("total_disbursed_amount"),
    )


def officer_portfolio(monthly: DataFrame, loans: DataFrame, risk: DataFrame) -> DataFrame:
    """Book, arrears and rates per officer over the monthly rows of their loans.

    The months of a loan and its risk rows are summed per loan first, so both joins are one to one.
    """
    joined = in_slices(
        lambda silver, raw, step: _officer_book(silver["monthly"], silver["loans"], raw["risk"]), "officer_book",
        (Tables.from_frames({"monthly": monthly, "loans": loans}), "loan_application_id"), (Tables.from_frames({"risk": risk}), "loanapplicationid"))
    summed = joined.groupBy("sales_officer_emp_id").agg(
        F.sum("_active").alias("active_loan_count"),
        F.sum("_pos").alias("current_book_pos"),
        F.sum("_dpd").alias("loans_in_dpd"),
        F.sum("_npa").alias("loans_in_npa"),
        F.sum("_arrears").alias("total_arrears_amount"),
        F.sum(F.col("_secured") * F.col("_months")).alias("_secured"),
        F.sum(F.col("_total") * F.col("_months")).alias("_total"),
        F.sum("_npa_pos").alias("_npa_pos"),
    )
    return summed.select(
        "sales_officer_emp_id", "active_loan_count", "current_book_pos", "loans_in_dpd", "loans_in_npa",
        "total_arrears_amount",
        share("_secured", "_total").alias("collection_efficiency_pct"),
        rate_of_positive("loans_in_dpd", "active_loan_count").alias("dpd_rate_pct"),
        percentage("_npa_pos", "current_book_pos").alias("npa_rate_pct"),
    )


def _officer_book(monthly: DataFrame, loans: DataFrame, risk: DataFrame) -> DataFrame:
    """Months and risk of each loan, summed, with its officer. A row depends on the rows of its loan only."""
    npa = truthy_text("is_npa")
    per_loan = monthly.groupBy("loan_application_id").agg(
        F.count(F.lit(1)).alias("_months"),
        count_if(F.col("pos") > 0).alias("_active"),
        F.sum("pos").alias("_pos"),
        count_if(F.col("max_dpd") > 0).alias("_dpd"),
        count_if(npa).alias("_npa"),
        F.sum(F.col("due_interest") + F.col("due_principal")).alias("_arrears"),
        sum_if(npa, "pos").alias("_npa_pos"),
    )
    per_risk = risk.filter(active()).groupBy(F.col("loanapplicationid").alias("loan_application_id")).agg(
        F.sum("securedamount").alias("_secured"), F.sum("totalamount").alias("_total")
    )
    return per_loan.join(loans.select("loan_application_id", "sales_officer_emp_id"), "loan_application_id").join(
        per_risk, "loan_application_id", "left"
    )


def officer_scorecard(loans: DataFrame, monthly: DataFrame, risk: DataFrame, as_of: date) -> DataFrame:
    """One row per officer with loans: onboarding figures and portfolio rates."""
    return officer_loans(loans, as_of).join(officer_portfolio(monthly, loans, risk), "sales_officer_emp_id", "left")


def loans_with_branch(performance: DataFrame, loans: DataFrame) -> DataFrame:
    return performance.join(loans.select("loan_application_id", "branch_id"), "loan_application_id")


