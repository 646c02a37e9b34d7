"""Append-only snapshots: idempotent append, retention and purge."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import months_before

SNAPSHOT_KEY = ("loan_application_id", "signal_date", "snapshot_type")
RETENTION_MONTHS = 18


def new_rows(df: DataFrame, target: DataFrame, keys: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """Rows whose key is not in the target yet. The target's keys are made unique first, so a repeated one costs nothing."""
    return df.join(target.select(*keys).distinct(), list(keys), "left_anti")


def retain(df: DataFrame, date_column: str, as_of: date, months: int = RETENTION_MONTHS) -> DataFrame:
    """Rows not older than the given number of months. A NULL date is kept."""
    d = F.col(date_column)
    return df.filter(d.isNull() | (d >= months_before(as_of, months)))


def keep_latest_of_type(df: DataFrame, type_column: str, kind, date_column: str) -> DataFrame:
    """Drop rows of one type that are older than the newest row of that type."""
    newest = df.filter(F.col(type_column) == kind).agg(F.max(date_column)).scalar()
    stale = (F.col(type_column) == kind) & (F.col(date_column) < newest)
    return df.filter(~F.coalesce(stale, F.lit(False)))
