import hashlib
import re

import pytest

from loanfold.llm import contentsort
from tests.llm.helpers import documents, rows_of


def plain(rows):
    norm = [re.sub("[ \t\n\x0b\f\r]+", " ", r[1] or "") for r in rows]
    groups = {}
    for k, (r, text) in enumerate(zip(rows, norm)):
        groups.setdefault(text, []).append((r[0] is None, r[0] or 0, k))
    out = []
    for k, (r, text) in enumerate(zip(rows, norm)):
        best = min(groups[text])
        out.append((r[0], None if best[0] else best[1], len(groups[text]), best[2] == k, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def many():
    rows = [(i, f"text  {i % 7}\tof {'x' * (i % 3)}") for i in range(200)]
    rows += [(i, "the same text \n again") for i in range(1000, 1400)] + [(i, "the same text again") for i in range(1400, 1500)]
    rows += [(1, None), (2, ""), (3, " "), (4, "\n\t "), (None, "alone"), (None, "text 1 of "), (None, "only this"), (None, "only this")]
    rows += [(5000, "once"), (5000, "once"), (5001, " once"), (5002, "z" * 3_000_000), (5003, "z" * 3_000_000), (5004, "z" * 2_999_999 + "y")]
    return rows


@pytest.mark.parametrize("partitions,extra", [(1, False), (8, True), (40, False)])
def test_as_by_brute_force(spark, partitions, extra):
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    try:
        assert rows_of(contentsort.copies(documents(spark, many(), extra))) == plain(many())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_large_group_is_cut(spark):
    """Copies that are most of all rows lie in many partitions, and still make one group."""
    docs = spark.range(0, 6000).selectExpr("id AS doc_id", "if(id % 3 < 2, 'copy of it', concat('own ', id)) AS text").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        local = contentsort._local_groups(docs)
        sizes = [r["count"] for r in local.groupBy("part").count().collect()]
        found = contentsort.copies(docs)
        assert len(sizes) >= 6 and max(sizes) < 2500
        assert found.filter("group_size = 4000 AND keep_id = 0").count() == 4000 and found.filter("kept").count() == 2001
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_row_of_each(spark):
    docs = documents(spark, many(), extra=True)
    kept = contentsort.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in plain(many()) if r[3]), key=repr)


def test_empty_table(spark):
    empty = documents(spark, many()).filter("false")
    assert contentsort.copies(empty).collect() == [] and contentsort.one_of_each(empty).collect() == []
