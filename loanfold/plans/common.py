"""Shared column handling of the table builds."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

KEY = "loanapplicationid"


def renamed(columns: Mapping[str, str]) -> list[Column]:
    """new name -> source column, as a projection."""
    return [F.col(source).alias(name) for name, source in columns.items()]


def join_sides(spine: DataFrame, key: str, sides: Sequence[DataFrame]) -> DataFrame:
    """Left-join sides that are unique on one key; all share the spine's partitioning on that key."""
    for side in sides:
        spine = spine.join(side, key, "left")
    return spine
