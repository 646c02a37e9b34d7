"""Composite early-warning score, its grade, advice and movement."""

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from .dedup import newest_per_key

# Weight of each raised flag, weight of the trend, the cap.
FLAG_WEIGHTS = {
    "high_foir_flag": 10,
    "multi_loan_stress": 10,
    "non_starter_sma1_flag": 15,
    "active_sma2_flag": 15,
    "ach_not_registered_sma1_flag": 10,
    "construction_delay_sma1_flag": 10,
    "title_doc_delay_flag": 5,
    "bounce_fy_sma1_flag": 15,
}
TREND_WEIGHTS = {"Worsening": 20, "Stable": 10}
SCORE_CAP = 100

# Upper bound, grade and advice.
GRADES = (
    (25, "Green", "No action required. Standard monitoring applies."),
    (50, "Amber", "Monitor closely. Send payment reminder communication."),
    (75, "Red", "Telephonic follow-up. Evaluate OTS or restructuring options."),
    (100, "Critical", "Immediate field visit required. Initiate legal notice and NPA provisioning review."),
)
REVALUATION = " Flag for collateral re-valuation."

# Label of each raised flag, as the consumers know them.
INDICATORS = (
    ("non_starter_sma1_flag", "NON_STARTER; & SMA1 OR ABOVE"),
    ("active_sma2_flag", "ACTIVE & ACTIVE_SMA2;"),
    ("ach_not_registered_sma1_flag", "ACH_NOT_REGISTERED; 7 SMA1 AND ABOVE "),
    ("construction_delay_sma1_flag", "CONSTRUCTION_DELAY_18M; & SMA1"),
    ("title_doc_delay_flag", "TITLE_DOC_DELAY_3M; $ DELAY FOR MORE THAN = 3 MONTHS"),
    ("bounce_fy_sma1_flag", "BOUNCE_FY_3PLUS;  &  SMA1 "),
    ("high_foir_flag", "HIGH_FOIR;"),
    ("multi_loan_stress", "MULTI_LOAN_STRESS;"),
)
WORSENING_INDICATOR = "DPD_WORSENING;"

TREND = "dpd_trend_direction"


def _raised(flag: str) -> Column:
    return F.coalesce(F.col(flag), F.lit(False))


def risk_score() -> Column:
    """Weighted sum of trend and flags, at most 100. A missing trend adds nothing."""
    points = F.lit(0)
    for label, weight in TREND_WEIGHTS.items():
        points = points + F.when(F.col(TREND) == label, weight).otherwise(0)
    for flag, weight in FLAG_WEIGHTS.items():
        points = points + F.when(_raised(flag), weight).otherwise(0)
    return F.least(points, F.lit(SCORE_CAP)).cast("int")


def risk_grade(score) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    label = F.when(score < 0, None)
    for upper, grade, _ in GRADES:
        label = label.when(score <= upper, grade)
    return label


def recommended_action(score, negative_area) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    advice = F.when((score < 0) | (score > GRADES[-1][0]), GRADES[0][2])
    for upper, _, text in GRADES:
        advice = advice.when(score <= upper, text)
    advice = advice.otherwise(GRADES[0][2])
    return F.concat(advice, F.when(_raised(negative_area), REVALUATION).otherwise(""))


def indicator_text() -> Column:
    labels = [F.when(_raised(flag), label).otherwise("") for flag, label in INDICATORS]
    labels.append(F.when(F.col(TREND) == "Worsening", WORSENING_INDICATOR).otherwise(""))
    return F.trim(F.concat(*labels))


def previous_scores(history: DataFrame, as_of: date, key: str = "loan_application_id") -> DataFrame:
    """Score of the newest month-end snapshot before the run date.

    A month-end snapshot has the last day of a month as its date, which also prunes a history that is partitioned by day.
    """
    day = F.col("signal_date")
    earlier = history.filter((F.col("snapshot_type") == "MONTH_END") & (day < F.lit(as_of)) & (F.last_day(day) == day))
    newest = newest_per_key(earlier, key, "signal_date", carry=["ews_risk_score"])
    return newest.select(key, F.col("ews_risk_score").alias("previous_month_ews_score"))


def score_trend(score, previous) -> Column:
    change = F.col(score) - F.col(previous)
    return (
        F.when(change > 0, "WORSENING").when(change < 0, "IMPROVING")
        .when(F.col(previous).isNull(), "NEW").otherwise("STABLE")
    )


def with_score_trend(scored: DataFrame, history: DataFrame, as_of: date, key: str = "loan_application_id") -> DataFrame:
    joined = scored.join(previous_scores(history, as_of, key), key, "left")
    return joined.withColumn(
        "score_variance", F.col("ews_risk_score") - F.col("previous_month_ews_score")
    ).withColumn("score_trend", score_trend("ews_risk_score", "previous_month_ews_score"))
