"""Conditional aggregates, ratios and amounts."""

from pyspark.sql import Column, functions as F

from .text import _col

MONEY = "decimal(18,2)"


def count_if(condition: Column, c=None) -> Column:
    """Rows that meet the condition (with a non-NULL c, when given)."""
    return F.count(F.when(condition, F.lit(1) if c is None else _col(c)))


def sum_if(condition: Column, c) -> Column:
    """Sum over the rows that meet the condition; 0, not NULL, when none does."""
    return F.sum(F.when(condition, _col(c)).otherwise(0))


def sum_if_any(condition: Column, c) -> Column:
    """Sum over the rows that meet the condition; NULL when none does."""
    return F.sum(F.when(condition, _col(c)))


def max_if(condition: Column, c) -> Column:
    return F.max(F.when(condition, _col(c)))


def any_true(condition: Column) -> Column:
    """TRUE when a row of the group meets the condition, else FALSE."""
    return F.coalesce(F.bool_or(condition), F.lit(False))


def money(c) -> Column:
    return F.coalesce(_col(c).cast(MONEY), F.lit(0).cast(MONEY))


def money_sum(c) -> Column:
    """NULL counts as zero and an empty group sums to 0.00."""
    return F.coalesce(F.sum(money(c)), F.lit(0).cast("decimal(28,2)"))


def percentage(part, whole, kind: str = "decimal(6,2)") -> Column:
    """part of whole in percent, two decimals; NULL when whole is 0 or NULL."""
    whole = F.nullif(_col(whole).cast("double"), F.lit(0.0))
    return F.round(F.coalesce(_col(part).cast("double"), F.lit(0.0)) / whole * 100, 2).cast(kind)


def share(part, whole) -> Column:
    """part of whole in percent, not rounded; 0 when whole is 0, NULL when it is NULL."""
    part, whole = _col(part).cast("double"), _col(whole).cast("double")
    return F.when(whole == 0, 0.0).otherwise(part / F.nullif(whole, F.lit(0.0)) * 100)


def rate_of_positive(part, whole) -> Column:
    """part of whole in percent, not rounded; NULL unless whole is positive."""
    part, whole = _col(part).cast("double"), _col(whole).cast("double")
    return F.when(whole > 0, part / F.nullif(whole, F.lit(0.0)) * 100)
