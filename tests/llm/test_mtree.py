import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanfold.llm import mtree, queries

TABLE = "vec_id long, embedding array<float>, label int, x string, ids string, score string"


def frames(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], TABLE).repartition(3)
    return df.select("vec_id", mtree.whole_numbers(F.col("embedding")).alias("x"))


def plain(rows, every, k=5):
    whole = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and abs(x) < float("inf") for x in v):
            single = [struct.unpack("f", struct.pack("f", x))[0] for x in v]
            whole.append((i, tuple(int((256 * x) // 1) for x in single)))
    whole = sorted(set(whole))
    out = []
    for q, x in whole:
        if q % every == 0:
            scored = sorted({(-sum(a * b for a, b in zip(x, y)), i, y) for i, y in whole if i != q})[:k]
            seen, rank = set(), 0
            for s, i, _ in scored:
                if (s, i) not in seen:
                    rank += 1
                    seen.add((s, i))
                    out.append((q, rank, i, -s if -1 << 63 <= -s < 1 << 63 else None))
    return sorted(out)


def vectors(n, seed=1):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centers)]) for i in range(n)]


@pytest.mark.parametrize("block,page,pivots", [(2048, 256, 128), (9, 16, 4)])
def test_as_by_brute_force(spark, monkeypatch, block, page, pivots):
    monkeypatch.setattr(mtree, "PAGE", page)
    monkeypatch.setattr(mtree, "FANOUT", 16 if page == 256 else 3)
    monkeypatch.setattr(mtree, "BLOCK_BYTES", mtree.BLOCK_BYTES if page == 256 else 1)  # several blocks
    monkeypatch.setattr(mtree, "PAGES_AT_ONCE", 512 if page == 256 else 7)
    rows = [(i, [struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in vectors(400)]
    rows += [(i, [0.5] * 12) for i in range(400, 460)]  # one vector many times: ties to the smaller id
    rows += [(460, None), (470, [1.0, None] + [0.0] * 10), (480, [float("nan")] * 12), (490, [float("inf")] * 12), (None, [1.0] * 12),
             (500, []), (510, [0.25, -0.75]), (520, [0.0] * 12), (7, rows[7][1]), (20, rows[20][1])]
    df = frames(spark, rows)
    found = mtree.top_k(df, df.filter("vec_id % 10 = 0"), query_block=block, pivots=pivots)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == plain(rows, 10)


def tree(spark, monkeypatch, n):
    """Pages over n vectors that lie along a curve, and the space, pivots and matrix of the vectors."""
    monkeypatch.setattr(mtree, "PAGE", 16)
    monkeypatch.setattr(mtree, "FANOUT", 4)
    rng = random.Random(n)
    points = [rng.uniform(0, 6.28) for _ in range(n)]
    rows = [(i, [math.cos(t), math.sin(t), math.cos(2 * t), math.sin(3 * t)]) for i, t in enumerate(points)]
    df = frames(spark, rows).select("x", F.array("vec_id").alias("ids"))
    vectors = [r.x for r in df.orderBy("ids").collect()]
    space = mtree.Space(4, max(sum(v * v for v in x) for x in vectors))
    matrix = space.matrix(vectors)
    pivots = matrix[:mtree.pivot_count(n)]
    return mtree.build(df, space, pivots), space, pivots, matrix


def test_radii_and_parent_distances_hold(spark, monkeypatch):
    index, space, pivots, matrix = tree(spark, monkeypatch, 900)
    held, seen, nodes = index.collect(), [], {}
    for p in held:
        center, node, rows = (np.frombuffer(p[c], space.kind).reshape(-1, 4) for c in ("center", "node_center", "vectors"))
        assert np.allclose(space.apart(rows, center)[:, 0], np.frombuffer(p["to_center"])) and len(rows) <= 16
        assert space.apart(rows, center).max() <= p["radius"] + 1e-3 and space.apart(rows, node).max() <= p["node_radius"] + 1e-3
        assert np.isclose(space.apart(center, node)[0, 0], p["to_node"])
        assert np.isclose(space.apart(node, pivots[p["pivot"]:p["pivot"] + 1])[0, 0], p["node_to_pivot"])
        seen += [i for ids in p["ids"] for i in ids]
        key = p["pivot"], p["node"], p["node_center"]
        nodes[key] = nodes.get(key, 0) + 1
    assert sorted(seen) == list(range(900)) and max(nodes.values()) <= 4


def test_visits_grow_slower_than_the_vectors(spark, monkeypatch):
    cost = {}
    for n in (1_000, 8_000):
        index, space, pivots, matrix = tree(spark, monkeypatch, n)
        held = [r.asDict() for r in index.collect()]
        best = mtree.search(space, pivots, matrix[:100], np.arange(100), 5, np.full(100, -np.inf), held, False)
        score = space.product(matrix[:100], matrix)
        score[np.arange(100), np.arange(100)] = -np.inf
        assert (best.score.reshape(100, 5) == -np.sort(-score, axis=1)[:, :5]).all()
        cost[n] = best.distances / 100
        assert best.pages / 100 < len(held) / 5
    assert cost[1_000] < 500 and cost[8_000] < 4 * cost[1_000]


def test_few_and_no_rows(spark):
    one = frames(spark, [(0, [1.0, 2.0])])
    assert mtree.top_k(one, one).collect() == []
    two = frames(spark, [(0, [1.0, 2.0]), (1, [-1.0, 0.5])])
    assert [tuple(r) for r in mtree.top_k(two, two.filter("vec_id = 0")).collect()] == [(0, 1, 1, 0)]
    assert mtree.top_k(two.filter("false"), two.filter("false")).collect() == []
    assert mtree.top_k(two, two.filter("false")).collect() == []


def test_large_components_are_exact(spark):
    rows = [(i, [float(1 << (i % 40)), -float(i), 3.0e30 if i % 7 == 0 else 1.0]) for i in range(60)]
    df = frames(spark, rows)
    found = mtree.top_k(df, df.filter("vec_id % 10 = 0"))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == plain(rows, 10)


def test_repeated_rows_among_equal_vectors(spark):
    same = [0.5, -0.25, 1.0]
    rows = [(1, same)] * 6 + [(i, same) for i in range(2, 10)] + [(i, [1.0, 1.0, float(i % 3)]) for i in (0, 10, 11)] * 2
    df = frames(spark, rows)
    found = mtree.top_k(df, df.filter("vec_id % 10 = 0"))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == plain(rows, 10)
    rows = [(i, same) for i in range(9)] * 2
    df = frames(spark, rows)
    found = mtree.top_k(df, df.filter("vec_id % 4 = 0"))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == plain(rows, 4)


@pytest.mark.parametrize("largest", [100_000.0, 6.0e7, 3.0e38])
def test_no_component_is_bounded(spark, largest):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-largest, largest) if i % 3 else rng.gauss(0, 1) for _ in range(6)]) for i in range(700)]
    rows += [(700 + i, [largest, -largest, 0.5 * i, -1.0, 1.0, 0.0]) for i in range(30)]  # equal but for their last bits
    rows = [(i, [struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in rows + [(730, [100_000.0])] + rows[:20]]
    df = spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], TABLE).repartition(3)
    df = df.select("vec_id", mtree.whole_numbers(F.col("embedding")).alias("x"))
    whole = {i: [int(x) * 256 if abs(x) >= 1 << 53 else int((256 * x) // 1) for x in v] for i, v in rows}
    assert whole[730] == [25_600_000]
    expected = []
    for q in range(0, 731, 10):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], y)), i) for i, y in whole.items() if i != q)[:5]
        expected += [(q, n, i, -s if -1 << 63 <= -s < 1 << 63 else None) for n, (s, i) in enumerate(scored, 1)]
    found = mtree.top_k(df, df.filter("vec_id % 10 = 0"), pivots=8)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == expected


def test_query_reads_components_unbounded(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (1, [100_000.0, 0.0]), (2, [90_000.0, 0.0]), (3, [80_000.0, 0.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = sorted((r["rank"], r.vec_id, r.score) for r in queries.op6_mtree(spark, str(tmp_path)).collect())
    assert found == [(1, 1, 25_600_000 * 256), (2, 2, 23_040_000 * 256), (3, 3, 20_480_000 * 256)]
