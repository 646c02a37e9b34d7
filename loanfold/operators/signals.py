"""Early-warning signals, one row per loan that raises them."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import fiscal_year_start, months_before
from ..functions.flags import active, null_or_not_in, null_or_zero
from ..functions.numbers import any_true
from .dedup import first_per_key, newest_as_columns, newest_per_key
from .customers import main_applicant
from .receipts import BOUNCE_CHARGE, LOAN_ACTIVE, active_loans, past_due
from .skew import join_to_unique

LOAN = "loan_application_id"

# Codes of the source system.
SMA_1, SMA_2, NPA = 2570, 2571, 2572
MANDATE_REGISTERED = 1991
CONSTRUCTION_PURPOSES = (16, 1, 5)
TITLE_DOCUMENTS = (1, 3, 16, 70, 81, 118, 130, 209)
TITLE_CATEGORY = 3256
TITLE_DOCUMENT_TYPE = 1957
TITLE_ACCEPTED = (1948, 1949, 1951)
BOUNCE_CHARGE_FOR = 1561
BOUNCES_ALLOWED = 3
CONSTRUCTION_MONTHS = 18
TITLE_MONTHS = 3
HIGH_FOIR_PCT = 65


def trend_label(newest, middle, oldest) -> Column:
    """Direction of the last three values; a missing month only ever reaches the default."""
    m1, m2, m3 = (F.col(c) if isinstance(c, str) else c for c in (newest, middle, oldest))
    level = (m1 == m2) & (m2 == m3)
    return (
        F.when((m1 == 0) & (m2 == 0) & (m3 == 0), "Stable")
        .when((m1 == 0) & ((m2 > 0) | (m3 > 0)), "Improving")
        .when((m1 > 0) & (m2 == 0) & (m3 == 0), "Worsening")
        .when((m1 > m2) & (m2 > m3), "Worsening")
        .when((m1 < m2) & (m2 < m3), "Improving")
        .when(level & (m1 >= 91), "Stable")
        .when(level & (m1 < 91), "Improving")
        .otherwise("Stable")
    )


def dpd_trend(monthly: DataFrame, key: str = "loan_application_id", by: str = "snapshot_date",
              value: str = "max_dpd", ties: Sequence[str] = ()) -> DataFrame:
    last = newest_as_columns(monthly, key, by, value, ["_m1", "_m2", "_m3"], ties=ties)
    return last.select(key, trend_label("_m1", "_m2", "_m3").alias("dpd_trend_direction"))


def entity_stress(members: DataFrame, worst: DataFrame, key: str, entity: str, value: str,
                  counted: DataFrame | None = None) -> DataFrame:
    """TRUE for a member when any member of its entity has a positive value.

    The maximum is taken per entity and joined back, so members are never paired with each other.
    """
    per_entity = members.filter(F.col(entity).isNotNull()).join(worst, key).groupBy(entity).agg(
        F.max(value).alias("_worst")
    )
    joined = join_to_unique(members.select(key, entity), per_entity, entity, "inner", counted=counted)
    return joined.select(key, F.coalesce(F.col("_worst") > 0, F.lit(False)).alias("multi_loan_stress"))


def multi_loan_stress(customers: DataFrame, monthly: DataFrame) -> DataFrame:
    """Any days past due among the loans of the main applicant's entity."""
    worst = monthly.groupBy("loan_application_id").agg(F.max("max_dpd").alias("max_dpd"))
    members = main_applicant(customers, ["entity_id"])
    return entity_stress(members, worst, "loan_application_id", "entity_id", "max_dpd", counted=customers)


def negative_area_flag(assets: DataFrame, key: str = "loan_application_id", flag: str = "is_negative_area") -> DataFrame:
    return assets.groupBy(key).agg(any_true(F.col(flag)).alias("negative_area_flag"))


def bucket_flags(monthly: DataFrame, latest_month_only: bool = False) -> DataFrame:
    """Which delinquency buckets a loan was in, once for all signals that ask.

    Looks at any month, or with latest_month_only at the newest one.
    """
    rows = monthly.filter(active())
    if latest_month_only:
        rows = newest_per_key(rows, "loanapplicationid", ["summaryyear", "summarymonth"],
                              carry=["deliquencybktdetailid"])
    code = F.col("deliquencybktdetailid")
    return rows.groupBy(F.col("loanapplicationid").alias(LOAN)).agg(
        any_true(code == SMA_1).alias("in_sma1"),
        any_true(code == SMA_2).alias("in_sma2"),
        any_true(code.isin(SMA_1, SMA_2, NPA)).alias("in_sma1_or_worse"),
    )


def _marked(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(F.col("loanapplicationid").alias(LOAN)).distinct().withColumn(name, F.lit(True))


def unpaid_first_dues(schedule: DataFrame, applications: DataFrame, as_of: date, dues: int = 2) -> DataFrame:
    """Active loans whose first past-due instalments are all unpaid and uncleared."""
    first = first_per_key(
        past_due(schedule, as_of).select("loanapplicationid", "duedate", "payscheduleid", "paymentreceiveddate",
                                         "clearenceflag"),
        "loanapplicationid", "duedate", ties=["payscheduleid"], n=dues,
    )
    open_dues = first.filter(F.col("paymentreceiveddate").isNull() & null_or_zero("clearenceflag"))
    unpaid = open_dues.groupBy("loanapplicationid").agg(F.count("duedate").alias("_n")).filter(F.col("_n") == dues)
    return _marked(unpaid.join(active_loans(applications), "loanapplicationid", "left_semi"), "first_dues_unpaid")


def loose_mandates(mandates: DataFrame) -> DataFrame:
    """Per loan with an active mandate: whether one of them is neither registered nor confirmed."""
    loose = null_or_zero("registered") & null_or_not_in("registeredstatustypedetailid", [MANDATE_REGISTERED])
    return mandates.filter(active()).groupBy(F.col("loanapplicationid").alias(LOAN)).agg(
        any_true(loose).alias("mandate_loose"))


def waiting_titles(documents: DataFrame) -> DataFrame:
    """Loans with a title document that is not in an accepted state."""
    return _marked(documents.filter(
        F.col("documentid").isin(*TITLE_DOCUMENTS)
        & (F.col("documentcategorydetailid") == TITLE_CATEGORY)
        & (F.col("documenttypedetailid") == TITLE_DOCUMENT_TYPE)
        & null_or_not_in("documentstatustypedetailid", TITLE_ACCEPTED)
    ), "title_waiting")


def many_bounces(charges: DataFrame, due_status: DataFrame, as_of: date) -> DataFrame:
    """Loans with more than three bounce charges since the first of April and a due status in the first bucket."""
    bounces = charges.filter(
        (F.col("chargesfortypedetailid") == BOUNCE_CHARGE_FOR)
        & (F.col("typedetailchargeid") == BOUNCE_CHARGE)
        & (F.col("chargedate") >= F.lit(fiscal_year_start(as_of)))
    ).groupBy(F.col("loanapplicationid").alias(LOAN)).agg(F.count("chargedate").alias("_n"))
    in_sma1 = _marked(due_status.filter(F.col("deliquencybktdetailid") == SMA_1), "many_bounces")
    return bounces.filter(F.col("_n") > BOUNCES_ALLOWED).join(in_sma1, LOAN).drop("_n")


def conditions(as_of: date) -> dict[str, Column]:
    """Flag name -> condition over a loan's columns joined with the facts above."""
    is_active = F.col("loanstatus_typedetail_id") == LOAN_ACTIVE
    return {
        "non_starter_sma1_flag": F.col("first_dues_unpaid") & F.col("in_sma1_or_worse"),
        "active_sma2_flag": is_active & F.col("in_sma2"),
        # No active mandate counts as not registered.
        "ach_not_registered_sma1_flag": is_active & F.col("in_sma1_or_worse") & F.coalesce("mandate_loose", F.lit(True)),
        "construction_delay_sma1_flag": is_active & F.col("in_sma1")
        & F.col("loan_purpose_id").isin(*CONSTRUCTION_PURPOSES)
        & (F.col("first_disbursal_date") <= months_before(as_of, CONSTRUCTION_MONTHS))
        & null_or_zero("is_actually_fully_disbursed"),
        "title_doc_delay_flag": is_active & F.col("title_waiting")
        & (F.col("first_disbursal_date") <= months_before(as_of, TITLE_MONTHS)),
        "bounce_fy_sma1_flag": is_active & F.col("many_bounces"),
    }


def _raise(loans: DataFrame, facts: Sequence[DataFrame], flag: str, as_of: date) -> DataFrame:
    """The loans that meet one condition, marked."""
    for fact in facts:
        loans = loans.join(fact, LOAN, "left")
    return loans.filter(conditions(as_of)[flag]).select(LOAN, F.lit(True).alias(flag))


def non_starter(schedule: DataFrame, applications: DataFrame, buckets: DataFrame, as_of: date) -> DataFrame:
    unpaid = unpaid_first_dues(schedule, applications, as_of)
    return _raise(unpaid, [buckets], "non_starter_sma1_flag", as_of)


def active_sma2(loans: DataFrame, buckets: DataFrame, as_of: date) -> DataFrame:
    return _raise(loans, [buckets], "active_sma2_flag", as_of)


def ach_not_registered(loans: DataFrame, mandates: DataFrame, buckets: DataFrame, as_of: date) -> DataFrame:
    """Active delinquent loans without an active mandate, or with one that is not registered."""
    return _raise(loans, [loose_mandates(mandates), buckets], "ach_not_registered_sma1_flag", as_of)


def construction_delay(loans: DataFrame, buckets: DataFrame, as_of: date) -> DataFrame:
    return _raise(loans, [buckets], "construction_delay_sma1_flag", as_of)


def title_doc_delay(loans: DataFrame, documents: DataFrame, as_of: date) -> DataFrame:
    return _raise(loans, [waiting_titles(documents)], "title_doc_delay_flag", as_of)


def fiscal_year_bounces(loans: DataFrame, charges: DataFrame, due_status: DataFrame, as_of: date) -> DataFrame:
    return _raise(loans, [many_bounces(charges, due_status, as_of)], "bounce_fy_sma1_flag", as_of)


def consecutive_bounces(rows: DataFrame, key: str, order: Sequence[str], bounced: Column) -> DataFrame:
    """Bounced rows after the newest cleared one, per key that has any.

    The newest cleared row is one value per key; bounces are counted against it, without ranking a key's rows.
    """
    at = F.struct(*order)
    cleared = rows.filter(~bounced).groupBy(key).agg(F.max(at).alias("_cleared"))
    open_run = join_to_unique(rows.filter(bounced).select(key, *order), cleared, key).filter(
        F.col("_cleared").isNull() | (at > F.col("_cleared"))
    )
    return open_run.groupBy(key).agg(F.count(F.lit(1)).alias("consecutive_bounces"))
