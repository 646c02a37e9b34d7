"""Queries over the test tables: each one runs library code and carries SQL that gives the same rows."""

from . import groups, joins, portfolio, scalars, silver, tables_and_rows, warning  # noqa: F401  (registers the queries)
from .registry import REGISTRY
