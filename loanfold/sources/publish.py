"""Publishing tables: rows are written in a folder of their own, and one step in the catalog makes them the table.

Folders of a table, beside each other in the folder of its database: <table>__versions holds one folder per written version of the
whole table, <table>__parts one per written set of partitions. The version in use and the one it replaced stay, so that
readers that began before a step can end; older ones, and those of builds that failed, go when the next one is published.
A table has one writer at a time.
"""

import uuid
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from ..session import checkpointed
from ..operators.history import new_rows

#: Table properties of the library; they go on to a table that replaces another.
PROPERTY = "loanfold."
#: Of DESCRIBE FORMATTED: what must agree for files to be exchanged below a table.
DECLARED = ("Num Buckets", "Bucket Columns", "Sort Columns", "Provider", "Type")


def _step(spark: SparkSession, statement: str) -> None:
    """One change of the catalog."""
    spark.sql(statement)


def split_name(spark: SparkSession, table: str) -> tuple[str, str]:
    database, _, name = table.rpartition(".")
    return database or spark.catalog.currentDatabase(), name


def folder_of(spark: SparkSession, table: str, kind: str) -> str:
    database, name = split_name(spark, table)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}__{kind}"


def described(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    """The named facts of a table, or of a partition, from the detailed part of DESCRIBE FORMATTED."""
    facts, inside = {}, False
    for row in spark.sql(f"DESCRIBE FORMATTED {table} {partition}").collect():
        if row.col_name.startswith("#"):
            inside = row.col_name.startswith("# Detailed")
        elif inside and row.data_type:
            facts[row.col_name.rstrip(":")] = row.data_type
    return facts


def columns_of(spark: SparkSession, table: str) -> list[tuple[str, str, bool]]:
    """Name, type and whether it is a partition column."""
    return [(c.name.lower(), c.dataType, c.isPartition) for c in spark.catalog.listColumns(table)]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def recover(spark: SparkSession, table: str) -> bool:
    """Undo a publication that stopped between two steps. True when the old rows had to be put back.

    Only a change of columns, buckets or partitions takes two steps, and only between them the table is missing.
    """
    old = f"{table}__old"
    if not spark.catalog.tableExists(old):
        return False
    if spark.catalog.tableExists(table):
        _step(spark, f"DROP TABLE {old}")
        return False
    _step(spark, f"ALTER TABLE {old} RENAME TO {table}")
    return True


def publish(spark: SparkSession, writer: DataFrameWriter, table: str) -> None:
    """Write the rows of writer as a new version of the table, and make it the table.

    A failed or stopped write leaves the old rows where they were. The first version, and one that is declared like the
    last, is published by one step: readers see the old rows or the new ones. Other columns, buckets or partitions need a new
    table under the old name, which takes two renamings; recover(), which every publication begins with, puts the old table
    back if the second never came.
    """
    recover(spark, table)
    new, versions = f"{table}__new", folder_of(spark, table, "versions")
    path = f"{versions}/{uuid.uuid4().hex}"
    _step(spark, f"DROP TABLE IF EXISTS {new}")
    writer.option("path", path).saveAsTable(new)
    replaced = None
    if not spark.catalog.tableExists(table):
        _step(spark, f"ALTER TABLE {new} RENAME TO {table}")
    else:
        before, after = described(spark, table), described(spark, new)
        replaced = before.get("Location")
        like = columns_of(spark, table) == columns_of(spark, new) and all(before.get(k) == after.get(k) for k in DECLARED)
        if like and not partition_columns(spark, table):
            _step(spark, f"ALTER TABLE {table} SET LOCATION '{path}'")
            _step(spark, f"DROP TABLE {new}")
        else:
            _keep_properties(spark, table, new)
            _step(spark, f"ALTER TABLE {table} RENAME TO {table}__old")
            _step(spark, f"ALTER TABLE {new} RENAME TO {table}")
            _step(spark, f"DROP TABLE {table}__old")
    spark.catalog.refreshTable(table)
    remove_others(spark, f"{versions}/*", [path, replaced])


def publish_partitions(df: DataFrame, table: str, only: bool = False) -> int:
    """Replace the partitions that df has rows of, each as a whole; only: the table keeps no others.

    All rows are written beside the table in one job. Then each partition is pointed at its new folder by one step, so a failed
    job leaves every partition as it was, and a stopped publication leaves each either old or new. Returns how many were published.
    """
    spark = df.sparkSession
    by = partition_columns(spark, table)
    parts = folder_of(spark, table, "parts")
    stage = f"{parts}/{uuid.uuid4().hex}"
    columns = [f.name for f in spark.table(table).schema]
    df.select(*columns).write.partitionBy(*by).parquet(stage)
    written = _partitions_below(spark, df, stage, by)
    known = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    root = described(spark, table).get("Location", "").rstrip("/")
    for name, spec, path in written:
        replaced = described(spark, table, spec).get("Location") if name in known else None
        if replaced:
            _step(spark, f"ALTER TABLE {table} {spec} SET LOCATION '{path}'")
        else:
            _step(spark, f"ALTER TABLE {table} ADD {spec} LOCATION '{path}'")
        remove_others(spark, f"{parts}/*/{name}", [path, replaced])
        remove_others(spark, f"{root}/{name}", [path, replaced])
    if only:
        drop_partitions(spark, table, known - {name for name, _, _ in written})
    spark.catalog.refreshTable(table)
    return len(written)


def add_rows(df: DataFrame, table: str) -> int:
    """Add rows to the partitions they belong to, each published as a whole with the rows it had. Returns how many partitions."""
    spark = df.sparkSession
    by = partition_columns(spark, table)
    target = spark.table(table)
    touched = df.select(*by).distinct().collect()  # one row per partition
    if not touched:
        return 0
    here = F.lit(False)
    for row in touched:
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.lit(row[c]))
        here = here | same
    return publish_partitions(target.filter(here).unionByName(df.select(*target.columns)), table)


def add_new_rows(df: DataFrame, table: str, keys: Sequence[str], within=None) -> int:
    """Add the rows whose key the table lacks, partition by partition. within: a predicate on the table that holds for all of df."""
    target = df.sparkSession.table(table)
    fresh = new_rows(df, target if within is None else target.filter(within), keys)
    return add_rows(checkpointed(fresh.select(*target.columns), "fresh"), table)


def drop_partitions(spark: SparkSession, table: str, names: Iterable[str]) -> int:
    """Drop partitions by the names that SHOW PARTITIONS gives them, and their files."""
    dropped = 0
    for name in sorted(names):
        spec = _spec(dict(p.split("=", 1) for p in name.split("/")))
        path = described(spark, table, spec).get("Location")
        _step(spark, f"ALTER TABLE {table} DROP IF EXISTS {spec}")
        if path:
            _delete(spark, path)
        dropped += 1
    return dropped


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with all its versions."""
    for name in (table, f"{table}__new", f"{table}__old"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for kind in ("versions", "parts"):
        _delete(spark, folder_of(spark, table, kind))


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    """The library's own properties of a table."""
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r.key.startswith(PROPERTY)}


def reserve_ids(spark: SparkSession, table: str, column: str, count: int) -> int:
    """Hand out count ids of a column of the table: those after the returned one.

    The highest id ever handed out is kept with the table, so ids stay unique whatever the order in which days are built, and
    those of dropped or replaced rows never come back. It moves before the rows are written: a build that fails leaves
    a gap. A table without the mark begins at its largest id.
    """
    key = f"{PROPERTY}highest.{column}"
    mark = properties(spark, table).get(key)
    highest = int(mark) if mark is not None else spark.table(table).agg(F.max(column)).first()[0] or 0
    _step(spark, f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{highest + count}')")
    return highest


def remove_others(spark: SparkSession, pattern: str, keep: Iterable[str | None]) -> None:
    """Delete the folders that match a pattern, but for those to keep."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept = {_tail(k) for k in keep if k}
    for found in files.globStatus(path) or []:
        if _tail(found.getPath().toString()) not in kept:
            files.delete(found.getPath(), True)


def _tail(path: str) -> str:
    """The last folders of a path, by which versions of one table differ, however its store is written."""
    return "/".join(path.rstrip("/").split("/")[-3:])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _spec(values: Mapping[str, str | None]) -> str:
    def literal(v: str | None) -> str:
        if v is None or v == "__HIVE_DEFAULT_PARTITION__":
            return "NULL"
        return "'" + unquote(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    return "PARTITION (" + ", ".join(f"`{c}` = {literal(v)}" for c, v in values.items()) + ")"


def _partitions_below(spark: SparkSession, df: DataFrame, stage: str, by: Sequence[str]) -> list[tuple[str, str, str]]:
    """Name, spec and folder of each partition written below a folder: as many rows as partitions."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    rows = spark.read.schema(df.schema).parquet(stage).select(folder.alias("folder")).distinct().collect()
    out = []
    for row in rows:
        name = "/".join(unquote(row.folder).split("/")[-len(by):])
        out.append((name, _spec(dict(p.split("=", 1) for p in name.split("/"))), f"{stage}/{name}"))
    return sorted(out)


def _keep_properties(spark: SparkSession, table: str, new: str) -> None:
    kept = ", ".join(f"'{k}' = '{v}'" for k, v in properties(spark, table).items())
    if kept:
        _step(spark, f"ALTER TABLE {new} SET TBLPROPERTIES ({kept})")
