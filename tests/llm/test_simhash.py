import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loanfold.llm import simhash
from tests.llm.helpers import documents


def plain_fingerprint(text):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).translate(
        {i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, distance=2):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= distance:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(prints[i][0])
    return sorted(((d, f, min((x for x in groups[find(i)] if x is not None), default=None))
                   for i, (d, f) in enumerate(prints)), key=repr)


def result(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("extra", [False, True])
def test_components_as_by_brute_force(spark, extra):
    rng = random.Random(5)
    words = ["alpha", "Beta", "gämma", "d", " x", " "]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice((0, 1, 2, 3, 5, 400))))) for i in range(120)]
    for i in range(120, 170):  # near copies: a word of a long text changes
        old = rows[rng.randrange(120)][1].split(" ")
        old[rng.randrange(len(old))] = rng.choice(words)
        rows.append((i, "\t".join(old)))
    rows += [(170, None), (171, ""), (172, " \n\x0b"), (3, rows[9][1]), (None, rows[8][1]), (None, "only this has no id at all"), (8, rows[8][1])]
    assert result(simhash.near_duplicates(documents(spark, rows, extra))) == plain_components(rows)


def test_one_large_group_of_copies(spark):
    rng = random.Random(7)
    body = rng.choices(["a", "b", "c", "d", "e"], k=300)
    rows = [(i, " ".join(body)) for i in range(120)]
    for i in range(120, 240):  # near copies, each with a word of its own
        near = list(body)
        near[rng.randrange(300)] = f"w{i}"
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(rng.choices(["p", "q", "r"], k=40))) for i in range(240, 300)]
    assert result(simhash.near_duplicates(documents(spark, rows))) == plain_components(rows)


def test_copies_of_one_text_are_spread(spark):
    """Empty texts are most rows; no task of the last join gets all of them."""
    docs = spark.range(0, 9000, 1, 6).selectExpr("id AS doc_id", "if(id % 3 < 2, '', concat('own words of ', id)) AS text")
    for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(setting, "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = simhash.near_duplicates(docs)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 9000 and max(sizes) < 3000
        assert found.filter("fp = 0 AND component_id = 0").count() == 6000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_long_text(spark):
    text = "ab Cd " * 200_000
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, []).filter("false")).collect() == []


def test_index_links_what_brute_force_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (900, 3)).astype(np.uint64)
    bits = np.unique(base[rng.integers(0, 6, 900)] ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2])
    group = rng.integers(0, 4, len(bits))
    order = np.lexsort((simhash.gray_rank(bits), group))
    bits, group = bits[order], group[order]
    root = np.arange(len(bits))
    for a, b in simhash.GrayIndex(group, bits).links(2):
        assert (group[a] == group[b]).all() and (np.bitwise_count(bits[a] ^ bits[b]) <= 2 * 2).all()
        simhash.join_roots(root, a, b)
    near = (np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 2) & (group[:, None] == group[None, :])
    plain = np.arange(len(bits))
    simhash.join_roots(plain, *np.nonzero(near))
    assert (root == plain).all() and len(set(plain)) < len(plain)


def test_gray_rank_neighbours_differ_in_one_bit():
    codes = np.arange(64, dtype=np.uint64)
    in_order = codes[np.argsort(simhash.gray_rank(codes))]
    assert (np.bitwise_count(in_order[1:] ^ in_order[:-1]) == 1).all()


def test_long_chain_is_one_component(spark):
    from loanfold.llm.common import components

    edges = spark.range(0, 500).selectExpr("id AS a", "id + 1 AS b")
    found = components(edges).collect()
    assert len(found) == 501 and {r.component for r in found} == {0}


def test_one_row_of_each_component(spark):
    rows = [(5, "a b c d"), (3, "A b  c d"), (3, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (None, "q r s t u"), (9, None), (8, ""), (7, "x y")]
    docs = documents(spark, rows, extra=True)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [3, 7, 8, None]
