"""Calendar expressions. The run date is always an argument, never the wall clock."""

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

from .text import _col


def on_day(c, day: date) -> Column:
    """Falls on that day; a plain range, so that it reaches the file scan."""
    c = _col(c)
    return (c >= F.lit(day)) & (c < F.lit(day + timedelta(days=1)))


def in_month_of(c, day: date) -> Column:
    """Falls in the month of that day; a plain range as well."""
    first = day.replace(day=1)
    following = (first + timedelta(days=32)).replace(day=1)
    c = _col(c)
    return (c >= F.lit(first)) & (c < F.lit(following))


def month_start(c) -> Column:
    return F.trunc(_col(c), "MM")


def month_of(year, month) -> Column:
    """First day of a month given as two numbers; NULL when the pair is no month."""
    return F.try_to_date(
        F.concat(_col(year).cast("string"), F.lit("-"), F.lpad(_col(month).cast("string"), 2, "0"), F.lit("-01")),
        "yyyy-MM-dd",
    )


def year_month(c) -> Column:
    return F.date_format(_col(c), "yyyyMM").cast("int")


def add_months_eom(c, months: int) -> Column:
    """Month arithmetic in which the last day of a month stays a last day."""
    c = _col(c)
    moved = F.add_months(c, months)
    return F.when(c == F.last_day(c), F.last_day(moved)).otherwise(moved)


def months_before(day: date, months: int) -> Column:
    """The day that many months earlier; from the last day of a month, the last day of that month."""
    return add_months_eom(F.lit(day), -months)


def days_between(later, earlier) -> Column:
    return F.datediff(_col(later), _col(earlier))


def fiscal_year_start(day: date) -> date:
    """First of April on or before the day."""
    return date(day.year if day.month >= 4 else day.year - 1, 4, 1)


def last_day_of_month(day: date) -> date:
    return (day.replace(day=1) + timedelta(days=32)).replace(day=1) - timedelta(days=1)


def snapshot_type(day: date) -> str:
    return "MONTH_END" if day == last_day_of_month(day) else "CURRENT_DAY"


def moment(ts: datetime) -> Column:
    """A point in time as the session's time zone reads it."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp")


def batch_id(run_ts: datetime, separator: str = "_") -> Column:
    return F.date_format(moment(run_ts), f"yyyyMMdd'{separator}'HHmmss" if separator else "yyyyMMddHHmmss")
