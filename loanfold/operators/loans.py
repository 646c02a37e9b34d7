"""Loan facts: tenure, acceptance, rate, links, checks, tranches, leads, partners and monthly labels."""

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import days_between, in_month_of
from ..functions.flags import active
from ..functions.numbers import count_if, max_if
from ..functions.text import upper_trimmed
from .dedup import newest_per_key
from .lookup import attach, dimension
from .sequence import ordered_list

# Texts of the source system.
INSTALMENT = "EMI"
SANCTION = "sanction"


def tenure_metrics(schedule: DataFrame, as_of: date) -> DataFrame:
    """Active instalments, those still to come, and the instalment of the current month, per loan."""
    kept = F.coalesce(active(), F.lit(False))
    instalment = kept & (upper_trimmed("head") == INSTALMENT)
    return schedule.groupBy("loanapplicationid").agg(
        count_if(instalment, "payscheduleid").alias("current_tenure_months"),
        count_if(instalment & (F.col("duedate") > F.lit(as_of)), "payscheduleid").alias("balance_tenure_months"),
        max_if(kept & in_month_of("duedate", as_of), "dueamount").alias("current_emi"),
    )


def first_acceptance(status_history: DataFrame) -> DataFrame:
    accepted = status_history.filter(F.col("isapplicationaccepted") == 1)
    return accepted.groupBy("loanapplicationid").agg(F.min("applicationaccepteddate").alias("first_accepted"))


def newest_reschedule(reschedules: DataFrame) -> DataFrame:
    return newest_per_key(reschedules.filter(active()), "loanapplicationid", "disbursalreschedulementid",
                          carry=["aroi", "paydueday"], ties=[])


def newest_spread(spreads: DataFrame) -> DataFrame:
    return newest_per_key(spreads.filter(active()), "loanapplicationid", "lastmodifiedon",
                          carry=["baserateinpercentage", "plrspreadinpercentage", "finalroi",
                                 "waiverroiinpercentage", "additionalspread"])


def effective_roi(reschedules: DataFrame, spreads: DataFrame) -> DataFrame:
    """Rate of the newest reschedule, else of the newest spread, for loans that have either."""
    both = newest_reschedule(reschedules).select("loanapplicationid", "aroi", "paydueday").join(
        newest_spread(spreads).select("loanapplicationid", "finalroi"), "loanapplicationid", "full"
    )
    return both.select("loanapplicationid", F.coalesce("aroi", "finalroi").alias("current_roi_pct"),
                       F.col("paydueday").alias("current_emi_cycle_day"))


def linked_loans(links: DataFrame) -> DataFrame:
    """Flag, count and ordered list of the loans linked to a loan."""
    links = links.filter(active())
    counts = links.groupBy("loanapplicationid").agg(
        F.lit(True).alias("is_link_loan"), F.count("linkedloanapplicationid").alias("linked_loan_count")
    )
    texts = ordered_list(links, "loanapplicationid", "linkedloanapplicationid", "linked_loans")
    return counts.join(texts, "loanapplicationid", "left")


def check_flags(checks: DataFrame) -> DataFrame:
    """Flags from the largest answered check of a loan: any, number 4, number 3."""
    top = checks.filter(active()).groupBy("loanapplicationid").agg(F.max("tvrchecklistid").alias("_top"))
    is_one = lambda n: F.coalesce(F.col("_top") == n, F.lit(False))
    return top.select(
        "loanapplicationid",
        F.coalesce(F.col("_top") != 0, F.lit(False)).alias("tvr_overall_flag"),
        is_one(4).alias("tvr_flag_4"),
        F.when(is_one(3), "Bribe").alias("tvr_flag_3bribe"),
    )


def newest_decision(responses: DataFrame, columns: list[str]) -> DataFrame:
    """The newest sanction response of the rule engine."""
    return newest_per_key(responses.filter(F.col("outputtype") == SANCTION), "loanapplicationid",
                          "ruleengineresponseid", carry=columns, ties=[])


def tranche_summary(tranches: DataFrame) -> DataFrame:
    """Count and dates of the disbursal tranches, and amount and codes of the last one."""
    tranches = tranches.filter(active())
    summed = tranches.groupBy("loanapplicationid").agg(
        F.count(F.lit(1)).cast("int").alias("total_tranches"),
        F.max("disburseddate").alias("last_tranche_date"),
        F.min("createdon").alias("record_created_at"),
        F.max("lastmodifiedon").alias("record_modified_at"),
    )
    last = newest_per_key(tranches, "loanapplicationid", ["disburseddate", "favouringid"],
                          carry=["disbursedamount", "favouringcategorytypedetailid", "transactiontypedetailid"])
    return summed.join(last.drop("disburseddate", "favouringid"), "loanapplicationid")


def lead_followups(followups: DataFrame) -> DataFrame:
    return followups.groupBy("leadid").agg(
        F.max("createdon").alias("last_followup_date"), F.count("leadfollowupid").alias("total_followups")
    )


def days_to_followup(created, followed) -> Column:
    return days_between(F.to_date(followed), F.to_date(created))


def covered_branches(coverage: DataFrame) -> DataFrame:
    return coverage.filter(active()).groupBy("entityid").agg(
        F.count("entitycoveredbranchid").alias("covered_branch_count")
    )


def fi_status(code) -> Column:
    return F.when(F.col(code) == "Initiated", "FI Positive").otherwise("FI Negative")


def engagement_label(df: DataFrame, engagements: DataFrame, partners: DataFrame) -> DataFrame:
    """Partner, start and 'type_assignment' label of the engagement a row refers to."""
    engagement = dimension(engagements, "engagementid",
                           ["startdate", "partnerid", "engagementtype", "assignmenttype"], active_only=True)
    partner = dimension(partners, "partnerid", ["partnername"], active_only=True)
    labelled = engagement.withColumn(
        "label", F.concat("engagementtype", F.lit("_"), "assignmenttype")
    )
    df = attach(df, labelled, ("engagementid", "engagementid"),
                {"engagement_date": "startdate", "_partnerid": "partnerid", "engagement_type": "label"})
    return attach(df, partner, ("_partnerid", "partnerid"), {"partner_name": "partnername"}).drop("_partnerid")


def existing_obligations(obligations: DataFrame) -> DataFrame:
    return obligations.filter(active()).groupBy("applicantid", "loanapplicationid").agg(
        F.sum("emiamount").alias("total_existing_emi"),
        F.count("existingobligationid").alias("existing_obligation_count"),
        F.sum("loanamount").alias("total_existing_loan_amt"),
    )
