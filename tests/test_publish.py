"""Publications that stop between any two steps, partitions published whole, ids handed out, declared columns."""

import glob
import os
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loanfold.bindings.tables_and_rows import scratch_database
from loanfold.sources import publish, sinks


class Stopped(Exception):
    pass


def stop_after(monkeypatch, steps):
    """Let so many catalog steps happen, then fail as if the driver had gone."""
    real, left = publish._step, [steps]

    def step(spark, statement):
        if left[0] == 0:
            raise Stopped(statement)
        left[0] -= 1
        real(spark, statement)

    monkeypatch.setattr(publish, "_step", step)


def failing(spark):
    return spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))


def ids(spark, table):
    spark.catalog.refreshTable(table)
    return sorted(r.id for r in spark.table(table).collect())


@pytest.fixture
def table(spark):
    return f"{scratch_database(spark)}.t"


@pytest.mark.parametrize("first,second", [
    (lambda df, t: sinks.full_refresh(df, t), lambda df, t: sinks.full_refresh(df, t)),
    (lambda df, t: sinks.bucketed_refresh(df, t, "id", 3), lambda df, t: sinks.bucketed_refresh(df, t, "id", 3)),
    (lambda df, t: sinks.full_refresh(df, t), lambda df, t: sinks.full_refresh(df.withColumn("more", F.lit(1)), t)),
    (lambda df, t: sinks.full_refresh(df, t), lambda df, t: sinks.bucketed_refresh(df, t, "id", 2)),
    (lambda df, t: df.write.saveAsTable(t), lambda df, t: sinks.full_refresh(df, t)),  # not written by the library
], ids=["like", "buckets", "other columns", "other buckets", "plain table"])
def test_stop_between_any_two_steps(spark, table, monkeypatch, first, second):
    """After a stop and a build that fails the old rows are there, or the new ones if they were published; then all goes on."""
    for steps in range(8):
        name = f"{table}{steps}"
        first(spark.range(5), name)
        with monkeypatch.context() as m:
            stop_after(m, steps)
            try:
                second(spark.range(5, 12), name)
                done = True
            except Stopped:
                done = False
        with pytest.raises(Exception):
            sinks.full_refresh(failing(spark), name)
        assert ids(spark, name) in ([list(range(5, 12))] if done else [list(range(5)), list(range(5, 12))])
        second(spark.range(20, 23), name)
        assert ids(spark, name) == [20, 21, 22]
        left = {r.name for r in spark.catalog.listTables(table.split(".")[0])}
        assert not any(n.endswith("__old") or n.endswith("__new") for n in left if n.startswith(f"t{steps}"))
        if done:
            break
    assert done


def test_readers_of_the_replaced_version_can_end(spark, table):
    sinks.full_refresh(spark.range(5), table)
    reader = spark.table(table)
    sinks.full_refresh(spark.range(7), table)
    assert reader.count() in (5, 7)
    folder = publish.folder_of(spark, table, "versions").replace("file:", "")
    for n in range(3):
        sinks.full_refresh(spark.range(n), table)
    assert len([f for f in os.listdir(folder)]) == 2
    publish.drop_table(spark, table)
    assert not os.path.exists(folder) and not spark.catalog.tableExists(table)


def by_day(rows):
    return rows.selectExpr("id", "date_add(DATE '2024-01-01', cast(id % 3 as int)) AS day", "concat('it''s ', id % 2) AS kind")


def test_partitions_are_replaced_whole(spark, table, monkeypatch):
    sinks.full_refresh(by_day(spark.range(9)), table, ["day"])
    again = by_day(spark.range(100, 103)).filter("day < '2024-01-03'")
    bad = again.withColumn("id", F.when(F.col("day") > "2024-01-01", F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception):
        publish.publish_partitions(bad, table)
    assert ids(spark, table) == list(range(9))
    for steps in (0, 1):
        with monkeypatch.context() as m:
            stop_after(m, steps)
            with pytest.raises(Stopped):
                publish.publish_partitions(again, table)
    old, new = {0: [0, 3, 6], 1: [1, 4, 7], 2: [2, 5, 8]}, {0: [102], 1: [100]}  # 102 % 3 = 0, 100 % 3 = 1
    assert ids(spark, table) == sorted(new[0] + old[1] + old[2])
    assert publish.publish_partitions(again, table) == 2
    assert ids(spark, table) == sorted(new[0] + new[1] + old[2])
    sinks.full_refresh(by_day(spark.range(4, 6)), table, ["day"])
    assert ids(spark, table) == [4, 5] and spark.sql(f"SHOW PARTITIONS {table}").count() == 2
    assert sinks.drop_expired(spark, table, "day", date(2024, 7, 3), months=6) == 1 and ids(spark, table) == [5]


def test_a_dropped_partition_takes_its_own_files_only(spark, table):
    sinks.full_refresh(by_day(spark.range(9)), table, ["day"])
    whole, part = publish.described(spark, table)["Location"], publish.described(spark, table, "PARTITION (day = '2024-01-02')")["Location"]
    assert part == f"{whole}/day=2024-01-02" and os.path.exists(part.replace("file:", ""))
    assert publish.drop_partitions(spark, table, ["day=2024-01-02"]) == 1
    assert not os.path.exists(part.replace("file:", "")) and ids(spark, table) == [0, 2, 3, 5, 6, 8]


def test_partitions_of_odd_names(spark, table):
    rows = spark.createDataFrame([(1, "a b/c:d%"), (2, "it's"), (3, None), (4, "plain")], "id long, kind string")
    sinks.full_refresh(rows, table, ["kind"])
    publish.publish_partitions(rows.withColumn("id", F.col("id") + 10).filter("id <> 14"), table)
    spark.catalog.refreshTable(table)
    assert sorted(((r.id, r.kind) for r in spark.table(table).collect())) == [(4, "plain"), (11, "a b/c:d%"), (12, "it's"), (13, None)]


def test_append_keeps_old_rows_of_a_partition(spark, table):
    sinks.full_refresh(by_day(spark.range(6)), table, ["day"])
    for _ in range(2):
        sinks.append_new(by_day(spark.range(3, 12)), table, keys=["id", "day"])
        assert ids(spark, table) == list(range(12))
    folder = publish.folder_of(spark, table, "parts").replace("file:", "")
    before = set(os.listdir(folder))
    sinks.append_new(by_day(spark.range(2)), table, keys=["id", "day"])
    assert set(os.listdir(folder)) == before  # nothing new, nothing written


def test_ids_are_handed_out_once(spark, table, monkeypatch):
    sinks.full_refresh(spark.range(1, 8), table)
    assert publish.reserve_ids(spark, table, "id", 5) == 7
    assert publish.reserve_ids(spark, table, "id", 1) == 12
    sinks.full_refresh(spark.range(2), table)
    assert publish.reserve_ids(spark, table, "id", 3) == 13
    sinks.full_refresh(spark.range(2).withColumn("more", F.lit(1)), table)  # another table under the name keeps the mark
    assert publish.reserve_ids(spark, table, "id", 3) == 16
    with monkeypatch.context() as m:
        stop_after(m, 0)
        with pytest.raises(Stopped):
            publish.reserve_ids(spark, table, "id", 3)
    assert publish.reserve_ids(spark, table, "id", 0) == 19


def groups_to_read(folder, column, value):
    """Row groups whose range of the column holds the value, of all."""
    wanted = total = 0
    for path in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            wanted += stats is not None and stats.has_min_max and stats.min <= value <= stats.max
    return wanted, total


def test_two_keys_are_both_skipped_by(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 8).selectExpr("(id * 7919) % 5000 AS a", "date_add(DATE '2000-01-01', cast((id * 104729) % 199999 % 3000 AS int)) AS b", "id")
    sinks.cluster(rows, ["a", "b"], files=64, cuts=32).write.parquet(str(tmp_path / "two"))
    rows.repartitionByRange(64, "a").write.parquet(str(tmp_path / "one"))
    assert spark.read.parquet(str(tmp_path / "two")).exceptAll(rows).count() == 0
    for column, value in (("a", 2500), ("a", 17), ("b", date(2003, 5, 17)), ("b", date(2008, 1, 1))):
        wanted, total = groups_to_read(tmp_path / "two", column, value)
        assert total >= 60 and 1 <= wanted <= 20
    assert groups_to_read(tmp_path / "one", "b", date(2003, 5, 17))[0] > 60


def test_clustering_of_odd_keys(spark):
    """NULLs, one value that is most rows, a key that is NULL in all rows, no rows."""
    rows = spark.range(0, 3000).selectExpr("if(id % 3 = 0, NULL, if(id % 3 = 1, 5, id)) AS a", "cast(NULL AS int) AS b", "id")
    found = sinks.cluster(rows, ["a", "b"], files=4, cuts=16)
    assert found.columns == rows.columns and found.exceptAll(rows).count() == 0 and found.count() == 3000
    assert sinks.cluster(rows.filter("false"), ["a", "b"]).count() == 0


def test_buckets_sorted_by_another_key(spark, table):
    """A read by the bucket's key opens one bucket, a read by the other skips within each."""
    rows = spark.range(0, 100_000, 1, 8).selectExpr("id AS loan", "(id * 7919) % 1000 AS branch")
    sinks.bucketed_refresh(rows, table, "loan", 4, ["branch", "loan"])
    spark.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))  # a task for each file
    try:
        whole, opened = spark.table(table), spark.table(table).filter("loan = 77")
        assert (whole.rdd.getNumPartitions(), opened.rdd.getNumPartitions(), opened.count()) == (4, 1, 1)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for path in glob.glob(publish.described(spark, table)["Location"].replace("file:", "") + "/*.parquet"):
        branches = pq.read_table(path)["branch"].to_pylist()
        assert branches == sorted(branches)


def test_declared_columns_are_reconciled(spark, table):
    assert sinks.ensure_table(spark, table, "a int, day date", ["day"])
    row = spark.createDataFrame([(1, date(2024, 1, 1))], "a int, day date")
    sinks.append_by_name(row, table, ["a", "day"])
    assert not sinks.ensure_table(spark, table, "a int, b string, c decimal(18,2), day date", ["day"])
    sinks.append_new(row.selectExpr("a + 1 AS a", "'x' AS b", "1.5BD AS c", "day"), table, keys=["a"])
    assert sorted((r.a, r.b, r.c) for r in spark.table(table).collect())[0] == (1, None, None)
    assert spark.table(table).filter("b = 'x' AND c = 1.50").count() == 1
    assert not sinks.ensure_table(spark, table, "A int, day date", ["day"])
    for wrong, parts in (("a bigint, day date", ["day"]), ("a int, day date", []), ("a int, day date, c decimal(18,3)", ["day"])):
        with pytest.raises(ValueError):
            sinks.ensure_table(spark, table, wrong, parts)
    assert spark.table(table).count() == 2
