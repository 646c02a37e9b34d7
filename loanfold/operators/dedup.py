"""Newest, first and preferred rows per key.

Every ranking is filtered right above its window, so Spark puts a group limit below the shuffle: each
task sends at most n rows of a key, and a key that holds a third of the table stays cheap.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

RANK = "_rank"


def _names(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _descending(c, nulls: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.desc_nulls_last() if nulls == "last" else c.desc_nulls_first()


def _top(df: DataFrame, keys, order: Sequence[Column], n: int, rank_as: str | None) -> DataFrame:
    window = Window.partitionBy(*_names(keys)).orderBy(*order)
    ranked = df.withColumn(rank_as or RANK, F.row_number().over(window))
    ranked = ranked.filter(F.col(rank_as or RANK) <= n)
    return ranked if rank_as else ranked.drop(RANK)


def newest_per_key(df: DataFrame, keys, by, carry: Sequence[str] = (), ties: Sequence[str] | None = None,
                   n: int = 1, rank_as: str | None = None, nulls: str = "last") -> DataFrame:
    """The n newest rows per key.

    by: one or more columns, newest first. carry: the columns to keep besides keys and by (all when
    empty; name them on wide tables, so that only they are read and shuffled). ties: columns that settle equal rows, largest first; the carried columns by default, so the
    result never depends on input order. A NULL in by loses unless nulls='first'.
    """
    keys, by = _names(keys), _names(by)
    if carry:
        df = df.select(*dict.fromkeys([*keys, *by, *carry]))
    settled = set(keys) | set(by)
    if ties is None:
        ties = [c for c in (carry or df.columns) if c not in settled]
    order = [_descending(c, nulls) for c in by] + [_descending(c, "last") for c in ties]
    return _top(df, keys, order, n, rank_as)


def first_per_key(df: DataFrame, keys, by, ties: Sequence[str] = (), n: int = 1,
                  rank_as: str | None = None) -> DataFrame:
    """The n earliest rows per key."""
    order = [F.col(c).asc_nulls_last() for c in [*_names(by), *ties]]
    return _top(df, keys, order, n, rank_as)


def preferred_per_key(df: DataFrame, keys, preferred: Column, by, ties: Sequence[str] = ()) -> DataFrame:
    """Rows that meet the preference come first, then the newest."""
    order = [F.when(preferred, 0).otherwise(1).asc()]
    order += [_descending(c, "last") for c in [*_names(by), *ties]]
    return _top(df, keys, order, 1, None)


def newest_as_columns(df: DataFrame, keys, by, value: str, names: Sequence[str],
                      ties: Sequence[str] = ()) -> DataFrame:
    """The newest len(names) values per key, one column each; NULL where a key has fewer rows."""
    top = newest_per_key(df, keys, by, carry=[value, *ties], ties=ties or None, n=len(names), rank_as=RANK)
    return top.groupBy(*_names(keys)).agg(
        *[F.max(F.when(F.col(RANK) == i, F.col(value))).alias(name) for i, name in enumerate(names, 1)]
    )


def one_per_key(df: DataFrame, keys, columns: Sequence[str]) -> DataFrame:
    """One row per key of a table without a version column: the largest row by these columns in turn, NULLs last.

    As a ranking, a task sends one row of a key on, and texts are compared only where the columns before them are equal.
    """
    keys = _names(keys)
    rows = df.select(*dict.fromkeys([*keys, *columns]))
    return _top(rows, keys, [_descending(c, "last") for c in columns], 1, None).select(*keys, *columns)
