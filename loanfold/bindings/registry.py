"""Registration of queries with their checking SQL."""

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, TimestampType

from ..session import sized_session
from ..sources.tables import Tables
from .raw import RAW, SOURCES, raw_sql, raw_tables, source_tables


class Inputs:
    """What a query may read: the test tables, and the loan tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str, raw: Tables | None = None):
        if raw is None:
            spark = sized_session(spark, [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in SOURCES])
        self.spark, self.sf_dir = spark, sf_dir
        self.sources: Tables = source_tables(spark, sf_dir)
        self.raw: Tables = raw or raw_tables(spark, sf_dir, self.sources)

    def __getitem__(self, name: str) -> DataFrame:
        return self.sources[name]


class Query(NamedTuple):
    run: Callable[..., DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps without zone, so that both engines show values alike."""
    casts = {}
    for field in df.schema:
        if isinstance(field.dataType, DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, TimestampType):
            casts[field.name] = F.col(field.name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


def with_raw(sql: str) -> str:
    """Put the derived raw tables that a text names in front of it."""
    used = [n for n in RAW if re.search(rf"\b{n}\b", sql)]
    # A stand-in may itself read raw tables, which must then come first.
    for name in list(used):
        used += [n for n in RAW if n not in used and re.search(rf"\b{n}\b", RAW[name])]
    used.sort(key=list(RAW).index)
    if not used:
        return sql
    body = sql.strip()
    return raw_sql(*used) + (",\n" + body[4:] if body.upper().startswith("WITH") else "\n" + body)


def query(name: str, oracle: str | None = None):
    """Register a function of Inputs under a name."""

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str, raw: Tables | None = None) -> DataFrame:
            """raw: the derived tables where they are at hand, as in the benchmark."""
            return comparable(build(Inputs(spark, sf_dir, raw)))

        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, with_raw(oracle) if oracle else None)
        return build

    return register
