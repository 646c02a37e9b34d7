"""Sources, sinks, projections and predicates."""

import uuid
from contextlib import suppress
from datetime import date

from pyspark.sql import functions as F

from ..functions.flags import not_blank, null_or_no, null_or_not_in, null_or_zero, truthy_text
from ..operators.history import keep_latest_of_type, retain
from ..operators.sequence import global_sequence
from ..session import scratch_path
from ..sources import sinks
from ..sources.publish import add_rows, publish_partitions, reserve_ids
from ..sources.tables import Tables
from .raw import AS_OF, RUN_TS
from .registry import Inputs, query


def scratch_database(spark) -> str:
    """A fresh database whose tables lie below the shared folder."""
    name = f"loanfold_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


@query("s1_scan_raw", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def _(t: Inputs):
    return Tables.from_folder(t.spark, t.sf_dir, ".parquet")["orders"]


@query("s2_scan_silver", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    folder = scratch_path(t.spark, "silver")
    t["orders"].select("o_orderkey", "o_orderstatus").write.parquet(f"{folder}/slv_orders")
    return Tables.from_folder(t.spark, folder)["slv_orders"]


@query("s3_full_refresh", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    table = f"{scratch_database(t.spark)}.slv_orders"
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.full_refresh(orders, table)
    sinks.full_refresh(orders.filter("o_orderstatus = 'F'").drop("o_orderstatus"), table)
    return t.spark.table(table)


@query("s3_stopped_refresh", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    """The state after a stop between the two renamings, then a build that fails: the old rows are read."""
    table = f"{scratch_database(t.spark)}.slv_orders"
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.full_refresh(orders.filter("o_orderstatus = 'F'").drop("o_orderstatus"), table)
    t.spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old")
    with suppress(Exception):
        sinks.full_refresh(orders.select("o_orderkey", F.raise_error(F.lit("stopped")).alias("o_custkey")), table)
    return t.spark.table(table)


@query("s3_published_partitions", """
    SELECT event_id, event_type, CAST(ts AS DATE) AS day FROM events e
    WHERE ts >= TIMESTAMP '2024-01-15' OR event_type = 'click'
       OR NOT EXISTS (SELECT 1 FROM events c WHERE c.event_type = 'click' AND CAST(c.ts AS DATE) = CAST(e.ts AS DATE))""")
def _(t):
    """Days written again are replaced as a whole, the others stay; a run that fails changes no day."""
    table = f"{scratch_database(t.spark)}.snapshots"
    rows = t["events"].select("event_id", "event_type", F.to_date("ts").alias("day"))
    sinks.full_refresh(rows, table, partition_by=["day"])
    early = rows.filter(F.col("day") < F.lit(date(2024, 1, 15)))
    with suppress(Exception):
        publish_partitions(early.withColumn("event_type", F.when(F.col("event_type") == "view", F.raise_error(F.lit("stopped")))), table)
    publish_partitions(early.filter("event_type = 'click'"), table)
    return t.spark.table(table).select("event_id", "event_type", "day")


@query("w10_reserved_ids", """
    SELECT event_id, CAST(event_id % 3 AS INT) AS batch, ROW_NUMBER() OVER (ORDER BY CASE event_id % 3 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END, event_id) AS id
    FROM events""")
def _(t):
    """Batches in any order, each numbered from where the table's mark stands."""
    table = f"{scratch_database(t.spark)}.numbered"
    sinks.ensure_table(t.spark, table, "event_id bigint, id bigint, batch int", ["batch"])
    for batch in (1, 0, 2):
        rows = t["events"].filter(F.col("event_id") % 3 == batch).select("event_id", F.lit(batch).alias("batch"))
        fresh = global_sequence(rows, "event_id", "id")
        highest = reserve_ids(t.spark, table, "id", fresh.count())
        add_rows(fresh.withColumn("id", F.col("id") + highest), table)
    return t.spark.table(table).select("event_id", "batch", "id")


@query("s4_added_column", """
    SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")
def _(t):
    """A column declared later is added to the table and is NULL in the rows it had."""
    table = f"{scratch_database(t.spark)}.snapshots"
    rows = t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("day"))
    sinks.ensure_table(t.spark, table, "id bigint, status string")
    sinks.append_by_name(rows.filter("status = 'F'"), table, ["id", "status"])
    sinks.ensure_table(t.spark, table, "id bigint, status string, day date")
    sinks.append_by_name(rows.filter("status <> 'F'"), table, ["id", "status", "day"])
    return t.spark.table(table)


@query("s4_ensure_table", "SELECT o_orderkey AS id, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day FROM orders")
def _(t):
    table = f"{scratch_database(t.spark)}.snapshots"
    schema = "id bigint, status string, day date"
    sinks.ensure_table(t.spark, table, schema)
    rows = t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
                              F.to_date("o_orderdate").alias("day"))
    sinks.append_by_name(rows, table, ["id", "status", "day"])
    sinks.ensure_table(t.spark, table, schema)
    return t.spark.table(table)


@query("s5_empty_clone", "SELECT DATE '1998-06-30' AS snapshot_date, n_nationkey, n_name FROM nation")
def _(t):
    table = f"{scratch_database(t.spark)}.history"
    nation = t["nation"].select("n_nationkey", "n_name")
    sinks.full_refresh(sinks.empty_clone(nation, [("snapshot_date", "date")]), table)
    sinks.append_by_name(nation.withColumn("snapshot_date", F.lit(AS_OF)), table,
                         ["snapshot_date", "n_nationkey", "n_name"])
    return t.spark.table(table)


@query("s6_append_by_name", "SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem")
def _(t):
    table = f"{scratch_database(t.spark)}.pairs"
    sinks.full_refresh(t["orders"].select("o_orderkey", "o_custkey"), table)
    more = t["lineitem"].select(F.col("l_suppkey").alias("o_custkey"), F.col("l_orderkey").alias("o_orderkey"))
    sinks.append_by_name(more, table, ["o_orderkey", "o_custkey"])
    return t.spark.table(table)


@query("s7_idempotent_append", """
    SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events""")
def _(t):
    table = f"{scratch_database(t.spark)}.snapshots"
    rows = t["events"].select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    sinks.full_refresh(rows.filter(F.col("event_id") % 3 != 0), table, partition_by=["day"])
    for _run in range(2):
        sinks.append_new(rows, table, keys=["event_id", "event_type", "day"])
    return t.spark.table(table).select("event_id", "user_id", "event_type", "day")


# Thirteen months before the last day of February is the last day of January.
@query("s8_retention", "SELECT event_id, CAST(ts + INTERVAL 2 DAY AS DATE) AS day FROM events WHERE ts + INTERVAL 2 DAY >= DATE '2024-01-31'")
def _(t):
    table = f"{scratch_database(t.spark)}.snapshots"
    as_of, months = date(2025, 2, 28), 13
    rows = t["events"].select("event_id", F.date_add(F.to_date("ts"), 2).alias("day"))
    sinks.full_refresh(rows, table, partition_by=["day"])
    sinks.drop_expired(t.spark, table, "day", as_of, months)
    return retain(t.spark.table(table).select("event_id", "day"), "day", as_of, months)


@query("s9_keep_latest_of_type", """
    SELECT event_id, event_type, CAST(ts AS DATE) AS day FROM events
    WHERE event_type <> 'view' OR CAST(ts AS DATE) = (SELECT CAST(MAX(ts) AS DATE) FROM events WHERE event_type = 'view')""")
def _(t):
    rows = t["events"].select("event_id", "event_type", F.to_date("ts").alias("day"))
    return keep_latest_of_type(rows, "event_type", "view", "day")


@query("s10_layout", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders")
def _(t):
    database = scratch_database(t.spark)
    rows = t["orders"].select("o_custkey", "o_orderdate", "o_orderkey")
    sinks.full_refresh(sinks.layout(rows, "o_custkey", ["o_orderdate"]), f"{database}.ranged")
    sinks.bucketed_refresh(t.spark.table(f"{database}.ranged"), f"{database}.bucketed", "o_custkey", 8, ["o_custkey", "o_orderdate"])
    return t.spark.table(f"{database}.bucketed")


@query("s10_two_keys", "SELECT l_partkey, l_suppkey, COUNT(*) AS n, CAST(SUM(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1, 2")
def _(t):
    """A table laid out for reads by part and by supplier."""
    table = f"{scratch_database(t.spark)}.lines"
    sinks.full_refresh(sinks.cluster(t["lineitem"].select("l_partkey", "l_suppkey", "l_quantity"), ["l_partkey", "l_suppkey"], cuts=64), table)
    return t.spark.table(table).groupBy("l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("double").alias("quantity"))


@query("s11_audit_stamp", """
    SELECT o_orderkey, TIMESTAMP '1998-06-30 18:30:15' AS silver_loaded_at, '19980630_183015' AS silver_batch_id FROM orders""")
def _(t):
    return sinks.audit_stamp(t["orders"].select("o_orderkey"), RUN_TS)


@query("s12_star_select", "SELECT *, o_totalprice > 250000 AS is_large FROM orders")
def _(t):
    return t["orders"].select("*", (F.col("o_totalprice") > 250000).alias("is_large"))


@query("p1_project_rename", "SELECT o_orderkey AS loan_application_id, o_custkey AS applicant_id, o_orderdate AS login_date FROM orders")
def _(t):
    return t["orders"].select(F.col("o_orderkey").alias("loan_application_id"), F.col("o_custkey").alias("applicant_id"),
                              F.col("o_orderdate").alias("login_date"))


@query("p2_active_filter", """
    SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linestatus = 'O'
    WHERE o_orderstatus = 'F'""")
def _(t):
    rows = t["lineitem"].filter("l_linestatus = 'O'").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    loans = t["orders"].filter("o_orderstatus = 'F'").select("o_orderkey")
    return loans.join(rows, loans["o_orderkey"] == rows["l_orderkey"], "left").drop("l_orderkey")


@query("p3_code_filter", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 3")
def _(t):
    return t["lineitem"].filter((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 3)).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("p4_in_list", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(t):
    return t["orders"].filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("p5_null_or_not_in", """
    SELECT event_id, kind FROM (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN event_type END AS kind FROM events)
    WHERE kind IS NULL OR kind NOT IN ('click', 'view')""")
def _(t):
    rows = t["events"].select("event_id", F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("kind"))
    return rows.filter(null_or_not_in("kind", ["click", "view"]))


@query("p6_null_or_zero", """
    SELECT event_id, flag FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 3 - 1 END AS flag FROM events)
    WHERE flag IS NULL OR flag = 0""")
def _(t):
    rows = t["events"].select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 3 - 1).alias("flag"))
    return rows.filter(null_or_zero("flag"))


@query("p7_between", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20")
def _(t):
    return t["lineitem"].filter(F.col("l_quantity").between(10, 20)).select("l_orderkey", "l_quantity")


@query("p8_not_blank", """
    SELECT o_orderkey FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' x ' END AS mark FROM orders)
    WHERE TRIM(mark) <> ''""")
def _(t):
    mark = F.when(F.col("o_orderkey") % 3 == 0, "  ").when(F.col("o_orderkey") % 3 == 1, " x ")
    return t["orders"].select("o_orderkey", mark.alias("mark")).filter(not_blank("mark")).select("o_orderkey")


@query("p9_run_date", """
    SELECT l_orderkey, l_shipdate, l_shipdate < DATE '1998-06-30' AS before, l_shipdate <= DATE '1998-06-30' AS until,
           l_shipdate = DATE '1998-06-30' AS same_day, l_shipdate > DATE '1998-06-30' AS after FROM lineitem""")
def _(t):
    d, run = F.col("l_shipdate"), F.lit(AS_OF)
    return t["lineitem"].select("l_orderkey", "l_shipdate", (d < run).alias("before"), (d <= run).alias("until"),
                                (d == run).alias("same_day"), (d > run).alias("after"))


@query("p10_boolean_column", """
    SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN event_type END = 'click' AS is_click FROM events""")
def _(t):
    return t["events"].select("event_id", (F.when(F.col("event_id") % 5 != 0, F.col("event_type")) == "click").alias("is_click"))


@query("p11_mixed_predicate", """
    SELECT l_orderkey, l_linenumber, CASE WHEN (l_returnflag = 'R' AND l_quantity > 30) OR (l_linestatus = 'F' AND l_discount = 0)
           THEN TRUE ELSE FALSE END AS is_npa FROM lineitem""")
def _(t):
    bad = ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 30)) | ((F.col("l_linestatus") == "F") & (F.col("l_discount") == 0))
    return t["lineitem"].select("l_orderkey", "l_linenumber", F.when(bad, True).otherwise(False).alias("is_npa"))


@query("p12_text_flags", """
    SELECT event_id, UPPER(TRIM(flag)) IN ('1', 'TRUE', 'Y') AS said_yes,
           flag IS NULL OR UPPER(TRIM(flag)) IN ('FALSE', '0', 'N') AS said_no
    FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '1' WHEN 1 THEN ' true' WHEN 2 THEN 'y ' WHEN 3 THEN 'False' WHEN 4 THEN 'n' END AS flag
          FROM events)""")
def _(t):
    forms = ["1", " true", "y ", "False", "n"]
    flag = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        flag = F.when(F.col("event_id") % 6 == i, form).otherwise(flag)
    return t["events"].select("event_id", flag.alias("flag")).select(
        "event_id", truthy_text("flag").alias("said_yes"), null_or_no("flag").alias("said_no"))
