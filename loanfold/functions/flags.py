"""Flags and predicates over loosely typed source columns."""

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from .text import _col, upper_trimmed

# The text forms of yes and no.
YES_TEXT = ("1", "TRUE", "Y")
NO_TEXT = ("FALSE", "0", "N")


def active(c="isactive") -> Column:
    return _col(c) == 1


def truthy_text(c) -> Column:
    return upper_trimmed(_col(c).cast("string")).isin(*YES_TEXT)


def null_or_no(c) -> Column:
    c = _col(c)
    return c.isNull() | upper_trimmed(c.cast("string")).isin(*NO_TEXT)


def null_or_zero(c) -> Column:
    return F.coalesce(_col(c), F.lit(0)) == 0


def null_or_not_in(c, values: Iterable) -> Column:
    c = _col(c)
    return c.isNull() | ~c.isin(*values)


def not_blank(c) -> Column:
    return F.coalesce(F.trim(_col(c).cast("string")) != "", F.lit(False))


def two_state(c, yes=1) -> Column:
    """TRUE when the column holds the yes value, FALSE for everything else."""
    return F.coalesce(_col(c) == yes, F.lit(False))


def tri_state(c) -> Column:
    """1 is TRUE, 0 is FALSE, anything else NULL."""
    c = _col(c)
    return F.when(c == 1, True).when(c == 0, False)


def yes_no(c) -> Column:
    c = _col(c)
    return F.when(c == 1, "Yes").when(c == 0, "No")


def present(c) -> Column:
    return _col(c).isNotNull()
