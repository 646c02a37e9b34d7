"""slv_early_warning: one row per loan and run day, appended to its own history."""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import last_day_of_month, snapshot_type
from ..operators import signals
from ..operators.history import new_rows
from ..operators.scoring import indicator_text, recommended_action, risk_grade, risk_score, with_score_trend
from ..operators.sequence import global_sequence
from ..session import scratch
from ..sources.publish import add_rows, reserve_ids
from ..sources.sinks import audit_stamp, drop_expired, ensure_table
from ..sources.tables import Tables
from .common import join_sides

TABLE = "slv_early_warning"
COLUMNS = {
    "ews_id": "bigint", "loan_application_id": "string", "signal_date": "date", "snapshot_type": "string",
    "snapshot_month": "date", "dpd_trend_direction": "string", "negative_area_flag": "boolean",
    "multi_loan_stress": "boolean", "high_foir_flag": "boolean", "non_starter_sma1_flag": "boolean",
    "active_sma2_flag": "boolean", "ach_not_registered_sma1_flag": "boolean",
    "construction_delay_sma1_flag": "boolean", "title_doc_delay_flag": "boolean", "bounce_fy_sma1_flag": "boolean",
    "ews_risk_score": "int", "ews_risk_grade": "string", "recommended_action": "string", "ews_indicators": "string",
    "previous_month_ews_score": "int", "score_variance": "int", "score_trend": "string",
    "gold_loaded_at": "timestamp", "gold_batch_id": "string", "reporting_period": "date",
}
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())
FLAGS = ["negative_area_flag", "multi_loan_stress", "high_foir_flag", "non_starter_sma1_flag", "active_sma2_flag",
         "ach_not_registered_sma1_flag", "construction_delay_sma1_flag", "title_doc_delay_flag", "bounce_fy_sma1_flag"]


def flags(raw: Tables, silver: Tables, as_of: date, latest_month_only: bool = False) -> DataFrame:
    """One row per loan with its trend and all flags: every fact is joined once, conditions are expressions."""
    loans, monthly = silver["slv_loan_details"], silver["slv_contract_perf_monthly"]
    spine = loans.select(signals.LOAN, "loanstatus_typedetail_id", "loan_purpose_id", "first_disbursal_date",
                         "is_actually_fully_disbursed", "final_foir_pct")
    df = join_sides(spine, signals.LOAN, [
        signals.dpd_trend(monthly, ties=["loan_monthly_id"]),
        signals.multi_loan_stress(silver["slv_customer"], monthly),
        signals.negative_area_flag(silver["slv_asset"]),
        signals.bucket_flags(raw["tblloanmonthly"], latest_month_only),
        signals.unpaid_first_dues(raw["tblloanapplicationpayschedule"], raw["tblloanapplication"], as_of),
        signals.loose_mandates(raw["tblloanapplicationach"]),
        signals.waiting_titles(raw["tblloanlegaldocuments"]),
        signals.many_bounces(raw["tblloanapplicationchargedetails"], raw["tblloanduestatus"], as_of),
    ])
    conditions = signals.conditions(as_of) | {"high_foir_flag": F.col("final_foir_pct") > signals.HIGH_FOIR_PCT}
    return df.withColumns(conditions).select(signals.LOAN, "dpd_trend_direction", *FLAGS).fillna(False, FLAGS)


def score(flagged: DataFrame, history: DataFrame, as_of: date) -> DataFrame:
    """Score, grade, advice and movement against the last month end."""
    df = flagged.withColumn("ews_risk_score", risk_score()).withColumns({
        "ews_risk_grade": risk_grade("ews_risk_score"),
        "recommended_action": recommended_action("ews_risk_score", "negative_area_flag"),
        "ews_indicators": indicator_text(),
    })
    month_end = F.lit(last_day_of_month(as_of))
    df = df.withColumns({
        "signal_date": F.lit(as_of), "snapshot_type": F.lit(snapshot_type(as_of)),
        "snapshot_month": month_end, "reporting_period": month_end,
    })
    return with_score_trend(df, history, as_of)


def fresh_rows(raw: Tables, silver: Tables, as_of: date, run_ts: datetime) -> DataFrame:
    """The rows of the run day that the history lacks, numbered from 1."""
    history = silver[TABLE].withColumn("loan_application_id", F.col("loan_application_id").cast("bigint"))
    scored = score(flags(raw, silver, as_of), history, as_of)
    fresh = new_rows(scored, history.filter(F.col("signal_date") == F.lit(as_of)))
    return audit_stamp(global_sequence(fresh, "loan_application_id", "ews_id"), run_ts, prefix="gold")


def numbered_after(df: DataFrame, highest) -> DataFrame:
    """The declared columns, with ids that begin after the highest one given."""
    return df.withColumn("ews_id", F.col("ews_id") + highest).select(*[F.col(name).cast(kind) for name, kind in COLUMNS.items()])


def build(raw: Tables, silver: Tables, as_of: date, run_ts: datetime) -> DataFrame:
    """The rows of the run day that the history lacks, numbered after the largest id of all its days.

    The newest day need not hold the largest id, as days may be built in any order. run() takes the mark kept with the table.
    """
    largest = silver[TABLE].agg(F.coalesce(F.max("ews_id"), F.lit(0))).scalar()
    return numbered_after(fresh_rows(raw, silver, as_of, run_ts), largest)


def run(spark: SparkSession, raw: Tables, silver: Tables, database: str, as_of: date, run_ts: datetime) -> None:
    """Create the table once, publish the day's partition with its new rows, drop what is past retention.

    Ids come from the table's own mark: days built late, again or after a failure get ids that no row ever had.
    """
    table = f"{database}.{TABLE}"
    ensure_table(spark, table, SCHEMA, partition_by=["signal_date"])
    with scratch(spark):
        fresh = fresh_rows(raw, silver, as_of, run_ts)
        count = fresh.count()  # of the numbered rows, which are written already
        if count:
            add_rows(numbered_after(fresh, F.lit(reserve_ids(spark, table, "ews_id", count))), table)
    drop_expired(spark, table, "signal_date", as_of)
