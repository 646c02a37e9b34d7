"""Exact top-k by inner product: a paged M-tree searched best first with triangle-inequality bounds."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import saved

PAGE = 256
#: Pages below an inner node.
FANOUT = 16
#: Queries that a task searches together, and bytes of query vectors sent to all tasks at a time.
QUERY_BLOCK = 2048
BLOCK_BYTES = 16 << 20
#: Nodes and pages that each query visits below its nearest pivot for a first floor.
FIRST_VISITS = 4
#: Pages of a task that are searched together, and distances to pivots computed together.
PAGES_AT_ONCE = 512
CELLS = 1 << 22
#: Below this squared norm all sums of products are exact in floats.
NARROW = 1 << 51

#: A page, with the inner node above it.
PAGES = ("pivot int, node int, node_to_pivot double, node_radius double, node_center binary, to_node double, radius double, "
         "center binary, vectors binary, to_center binary, ids array<array<long>>")


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * component) of each component; NULL where the vector or a component is NULL or not finite.

    They are whole numbers in doubles, which hold the floor of any float exactly: beyond 2^53 a double is a whole number already.
    """
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def whole(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)

    return F.when(~wrong, F.transform(vector, whole))


@dataclass
class Space:
    """Vectors of one width, shorter ones padded by zeros, with one more coordinate that gives all the same norm.

    With it the nearest vector to (query, 0) is the one of largest inner product, so that a metric tree applies:
    distance squared = norm of the query + norm of all - 2 * inner product.
    """

    width: int
    norm: float  # the largest squared norm, of queries too

    @property
    def narrow(self) -> bool:
        return self.norm < NARROW

    @property
    def kind(self) -> type:
        return np.int32 if self.narrow else np.float64

    def matrix(self, rows) -> np.ndarray:
        out = np.zeros((len(rows), self.width), self.kind)
        for i, row in enumerate(rows):
            out[i, :len(row)] = row
        return out

    def product(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products of the rows of a and b as floats, exact where the space is narrow."""
        return a.astype(float) @ b.astype(float).T

    def doubt(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the products may be off: the rounding of sums of products, at most the product of both norms each."""
        if self.narrow:
            return np.zeros((1, 1))
        lengths = [np.sqrt((x.astype(float) ** 2).sum(axis=1)) for x in (a, b)]
        return np.outer(*lengths) * ((self.width + 8) * 2.0 ** -51)

    def exact(self, a: np.ndarray, b: np.ndarray, products: np.ndarray) -> np.ndarray:
        """Exact inner products of the k-th row of a and the k-th of b, given the rounded ones: longs, or Python integers."""
        if self.narrow:
            return products.astype(np.int64)
        out = np.empty(len(products), object)
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            out[i] = sum(int(p) * int(q) for p, q in zip(x, y))
        return out

    @property
    def key_bytes(self) -> int:
        """Bytes of a sort key that holds any score of a space that is not narrow."""
        return int(self.norm).bit_length() // 8 + 2

    def key(self, score: int) -> bytes:
        """The score as bytes whose order is that of scores."""
        return (score + (1 << 8 * self.key_bytes - 1)).to_bytes(self.key_bytes, "big")

    def extra(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.norm - (rows.astype(float) ** 2).sum(axis=1)))

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances between indexed vectors."""
        inner = self.product(a, b) + np.outer(self.extra(a), self.extra(b))
        return np.sqrt(np.maximum(0.0, 2 * self.norm - 2 * inner))

    def from_queries(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        square = (queries.astype(float) ** 2).sum(axis=1)[:, None] + self.norm - 2 * self.product(queries, rows)
        return np.sqrt(np.maximum(0.0, square))

    @property
    def slack(self) -> float:
        """Rounding that a bound may carry."""
        return max(1e-6, 8 * np.sqrt(self.width * 2.0 ** -52)) * (1 + np.sqrt(self.norm))


def pivot_count(n: int) -> int:
    """Entries of the root: they grow with the square root of the pages, as do the pages below each."""
    return max(16, int(np.ceil(8 * np.sqrt(n / PAGE))))


def build(distinct: DataFrame, space: Space, pivots: np.ndarray) -> DataFrame:
    """The tree over distinct vectors: pivots at the root, inner nodes of FANOUT pages below them, pages of PAGE vectors.

    Each vector goes to its nearest pivot; pages are cut along the distance to it, and successive pages of a pivot share a
    node. Rows are range-partitioned by pivot and distance, so a pivot with many vectors is split over tasks. Nodes and
    pages keep a routing vector (the one nearest to their mean), a covering radius over all vectors below, and the distance
    of their routing vector to that of the parent; a page also keeps the distances of its vectors to its routing vector.
    One row is a page; those of a node follow each other and repeat its columns.
    """
    context = distinct.sparkSession.sparkContext
    shared = context.broadcast(pivots)  # grows with the square root of the pages

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // len(shared.value))
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                apart = space.apart(space.matrix(batch["x"].to_pylist()), shared.value)
                nearest = apart.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nearest, pa.int32()), pa.array(apart[np.arange(len(nearest)), nearest]), batch["x"], batch["ids"]],
                    names=["pivot", "far", "x", "ids"])

    def routing(rows: np.ndarray) -> np.ndarray:
        return rows[((rows - rows.mean(axis=0)) ** 2).sum(axis=1).argmin()][None]

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, list, list]] = []  # of the page that grows
        full: list[tuple[np.ndarray, np.ndarray, list]] = []  # pages of the node that grows
        done = 0

        def close_page() -> None:
            rows = space.matrix([x for _, x, _ in held])
            full.append((rows, routing(rows), [i for _, _, i in held]))
            held.clear()

        def close_node(pivot: int) -> pa.RecordBatch:
            nonlocal done
            centers = np.concatenate([c for _, c, _ in full])
            center = routing(centers)
            to_pivot = float(space.apart(center, shared.value[pivot:pivot + 1])[0, 0])
            radius = max(float(space.apart(rows, center).max()) for rows, _, _ in full)
            within = [space.apart(rows, c)[:, 0] for rows, c, _ in full]
            n = len(full)
            node = pa.RecordBatch.from_arrays(
                [pa.array([pivot] * n, pa.int32()), pa.array([done] * n, pa.int32()), pa.array([to_pivot] * n), pa.array([radius] * n),
                 pa.array([center.tobytes()] * n, pa.binary()), pa.array(space.apart(centers, center)[:, 0]),
                 pa.array([float(w.max()) for w in within]), pa.array([c.tobytes() for _, c, _ in full], pa.binary()),
                 pa.array([rows.tobytes() for rows, _, _ in full], pa.binary()), pa.array([w.tobytes() for w in within], pa.binary()),
                 pa.array([ids for _, _, ids in full], pa.list_(pa.list_(pa.int64())))],
                names=["pivot", "node", "node_to_pivot", "node_radius", "node_center", "to_node", "radius", "center", "vectors",
                       "to_center", "ids"])
            full.clear()
            done += 1
            return node

        pivot = -1
        for batch in batches:
            for row in zip(batch["pivot"].to_pylist(), batch["x"].to_pylist(), batch["ids"].to_pylist()):
                if held and (row[0] != pivot or len(held) == PAGE):
                    close_page()
                if full and (row[0] != pivot or len(full) == FANOUT):
                    yield close_node(pivot)
                pivot = row[0]
                held.append(row)
        if held:
            close_page()
            yield close_node(pivot)

    assigned = distinct.select("x", "ids").mapInArrow(assign, "pivot int, far double, x array<double>, ids array<long>")
    ordered = saved(assigned, "assigned").repartitionByRange("pivot", "far").sortWithinPartitions("pivot", "far")
    return saved(ordered.mapInArrow(pages, PAGES), "pages")


class Best:
    """The k best (score, smaller id first) found so far of each query."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray):
        self.own, self.k, self.floor = ids, k, floor  # floor: a float not above the k-th score of each query
        self.query, self.score, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pages = self.distances = 0  # visited and computed for all queries

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        keep = ids != self.own[query]
        if not keep.any():
            return
        query, score, ids = (np.concatenate([a, b[keep]]) for a, b in ((self.query, query), (self.score, score), (self.ids, ids)))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        new = np.r_[True, (query[1:] != query[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])]
        query, score, ids = query[new], score[new], ids[new]
        first = np.flatnonzero(np.r_[True, np.diff(query) != 0])
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        last = place == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], below(score[last]))
        self.query, self.score, self.ids = query[place < self.k], score[place < self.k], ids[place < self.k]


def below(scores: np.ndarray) -> np.ndarray:
    """Floats not above whole scores."""
    rounded = scores.astype(float)
    return np.where(np.abs(rounded) < 1 << 53, rounded, np.nextafter(rounded, -np.inf))


def search(space: Space, pivots: np.ndarray, queries: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray,
           held: list[dict], first: bool) -> Best:
    """Best-first search of some pages and the nodes above them for a block of queries.

    Each query has a queue of nodes and pages by their bounds, the least distance that a vector below may have. In every
    round each query takes the entry of smallest bound off its queue, until that is beyond its k-th best; the queries
    that took the same entry are worked together. A node enters the queue by the query's distance to its pivot alone; a
    visited one puts its pages there by the distance to its routing vector; in a visited page only the vectors are scored whose
    stored distance differs little enough from the query's. No other distance is computed.

    With first, a query only makes FIRST_VISITS visits below its nearest pivot.
    """
    best = Best(ids, k, floor)
    to_pivots = space.from_queries(queries, pivots)
    best.distances += to_pivots.size
    norms = (queries.astype(float) ** 2).sum(axis=1) + space.norm
    starts = [i for i, p in enumerate(held) if not i or (p["pivot"], p["node"]) != (held[i - 1]["pivot"], held[i - 1]["node"])]
    ends = starts[1:] + [len(held)]
    of, to, radius = (np.array([held[i][c] for i in starts]) for c in ("pivot", "node_to_pivot", "node_radius"))
    to_node, within = (np.array([p[c] for p in held]) for c in ("to_node", "radius"))
    n = len(starts)
    queue = np.full((len(queries), n + len(held)), np.inf)  # nodes, then pages
    queue[:, :n] = np.abs(to_pivots[:, of] - to) - radius
    if first:
        queue[:, :n][to_pivots.argmin(axis=1)[:, None] != of] = np.inf

    def reach(rows: np.ndarray) -> np.ndarray:
        """The distance beyond which no vector can be among the k best."""
        return np.sqrt(np.maximum(0.0, norms[rows] - 2.0 * best.floor[rows])) + space.slack

    def to_routing(rows: np.ndarray, center: bytes) -> np.ndarray:
        best.distances += len(rows)
        return space.from_queries(queries[rows], np.frombuffer(center, space.kind).reshape(1, -1))[:, 0]

    def open_node(node: int, rows: np.ndarray) -> None:
        apart, pages = to_routing(rows, held[starts[node]]["node_center"]), np.arange(starts[node], ends[node])
        bounds = np.maximum(np.abs(apart[:, None] - to_node[pages]) - within[pages], (apart - radius[node])[:, None])
        queue[rows[:, None], n + pages] = bounds

    def score_page(page: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        p, limit = held[page], reach(rows)
        best.pages += len(rows)
        to_center = to_routing(rows, p["center"])
        open_ = np.abs(to_center[:, None] - np.frombuffer(p["to_center"])) <= limit[:, None]
        open_ &= (to_center - p["radius"] <= limit)[:, None]
        some, rows_open = np.flatnonzero(open_.any(axis=0)), open_.any(axis=1)
        if not len(some):
            return None
        rows, open_ = rows[rows_open], open_[rows_open][:, some]
        best.distances += int(open_.sum())
        vectors = np.frombuffer(p["vectors"], space.kind).reshape(-1, space.width)[some]
        score = space.product(queries[rows], vectors)
        doubt = space.doubt(queries[rows], vectors)
        take = open_ & (score + doubt >= best.floor[rows][:, None])
        if score.shape[1] > k + 1:  # one of the ids may be the query's own
            sure = np.where(open_, score - doubt, -np.inf)
            take &= score + doubt >= np.partition(sure, -(k + 1), axis=1)[:, -(k + 1)][:, None]
        at, which = np.nonzero(take)
        names = [p["ids"][some[w]] for w in which]
        sizes = [len(x) for x in names]
        exact = space.exact(queries[rows[at]], vectors[which], score[at, which])
        return np.repeat(rows[at], sizes), np.repeat(exact, sizes), np.array([i for x in names for i in x], np.int64)

    active, rounds = np.arange(len(queries)), 0
    while len(active) and not (first and rounds == FIRST_VISITS):
        choice = queue[active].argmin(axis=1)
        near = queue[active, choice] <= np.minimum(reach(active), np.finfo(float).max)
        active, choice = active[near], choice[near]
        queue[active, choice] = np.inf
        order = np.argsort(choice, kind="stable")
        entries, at = np.unique(choice[order], return_index=True)
        found = []
        for entry, rows in zip(entries.tolist(), np.split(active[order], at[1:])):
            if entry < n:
                open_node(entry, rows)
            elif scored := score_page(entry - n, rows):
                found.append(scored)
        if found:
            best.add(*(np.concatenate(x) for x in zip(*found)))
        rounds += 1
    return best


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK, pivots: int | None = None) -> DataFrame:
    """The k candidates of largest inner product of each query: query_id, rank from 1, vec_id, score.

    candidates and queries: vec_id (long) and x (array of whole numbers, int or double). A candidate with the query's vec_id is its own row and takes no
    part; ties go to the smaller vec_id; fewer than k candidates give fewer rows. Rows without vec_id or x take no part,
    equal rows count once, shorter vectors count as if they ended in zeros. Ranks follow the exact scores whatever their
    size; a score that does not fit a long is shown as NULL.

    Equal vectors are one entry with their k + 1 smallest ids, counted after equal rows became one, which is all that any
    query can need. The pivots are the vectors of the smallest hashes, pivot_count of the distinct vectors unless given; all
    vectors are indexed. Queries go to all tasks in blocks of BLOCK_BYTES of vectors: once for a few visits below the pivot
    nearest to each query, which give a floor under its k-th score, once everywhere with that floor. A task searches
    query_block of them at a time and returns at most k rows per query and batch of pages. Where squared norms exceed NARROW, products in
    floats only rule out what they can't be wrong about, and the rest is scored in Python integers; one such vector among
    small ones makes the bounds loose, so that more pages are visited.
    """
    columns = "vec_id", F.col("x").cast("array<double>").alias("x")
    rows = candidates.select(*columns).filter("vec_id IS NOT NULL AND x IS NOT NULL")
    by_vector = Window.partitionBy("x").orderBy("vec_id")
    few = rows.distinct().withColumn("nth", F.row_number().over(by_vector)).filter(F.col("nth") <= k + 1)
    distinct = saved(few.groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vectors")
    asked = saved(queries.select(*columns).filter("vec_id IS NOT NULL AND x IS NOT NULL").distinct(), "queries")
    square = F.aggregate("x", F.lit(0.0), lambda t, v: t + v * v)
    norm, width, n = distinct.agg(F.max(square), F.max(F.size("x")), F.count(F.lit(1))).first()
    most, wide, n_queries = asked.agg(F.max(square), F.max(F.size("x")), F.count(F.lit(1))).first()
    space = Space(max(width or 0, wide or 0, 1), max(norm or 0.0, most or 0.0))
    roots = pivots or pivot_count(n)
    picked = space.matrix([r.x for r in distinct.select("x").orderBy(F.xxhash64("x"), "x").limit(roots).collect()])
    index = build(distinct, space, picked) if n else None
    results = []
    blocks = max(1, -(-n_queries // max(query_block, BLOCK_BYTES // (8 * space.width))))
    for block in range(blocks if n else 0):
        part = asked.filter(F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)) == block).collect()
        if part:
            found = _search_block(index, space, picked, part, k, query_block)
            results.append(saved(found, "found") if blocks > 1 else found)
    if not results:
        return candidates.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _search_block(index: DataFrame, space: Space, pivots: np.ndarray, part: list, k: int, query_block: int) -> DataFrame:
    context = index.sparkSession.sparkContext
    part = sorted(part, key=lambda r: (r.vec_id, list(r.x)))

    def searched(floor: np.ndarray, first: bool) -> DataFrame:
        shared = context.broadcast((pivots, space.matrix([r.x for r in part]), np.array([r.vec_id for r in part]), floor))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            roots, queries, ids, start = shared.value
            start = start.copy()
            for batch in batches:
                for lo in range(0, batch.num_rows, PAGES_AT_ONCE):
                    held = batch.slice(lo, PAGES_AT_ONCE).to_pylist()
                    for q in range(0, len(queries), query_block):
                        block = slice(q, q + query_block)  # floors of a block are a view: they stay for the next pages
                        best = search(space, roots, queries[block], ids[block], k, start[block], held, first)
                        scores = best.score.tolist()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(best.query + q), pa.array([s if -1 << 63 <= s < 1 << 63 else None for s in scores], pa.int64()),
                             pa.array([None if space.narrow else space.key(s) for s in scores], pa.binary()),
                             pa.array(below(best.score), pa.float64()), pa.array(best.ids)],
                            names=["q", "score", "key", "least", "vec_id"])

        return index.mapInArrow(run, "q long, score long, key binary, least double, vec_id long")

    order = Window.partitionBy("q").orderBy(F.col("score" if space.narrow else "key").desc(), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    floor = np.full(len(part), -np.inf)
    for r in ranked(searched(floor, True)).filter(F.col("rank") == k).collect():  # a row per query of the block
        floor[r.q] = r.least
    found = ranked(searched(floor, False))
    # One row of two longs per query of the block.
    names = index.sparkSession.createDataFrame([(i, r.vec_id) for i, r in enumerate(part)], "q long, query_id long")
    return found.join(F.broadcast(names), "q").select("query_id", "rank", "vec_id", "score")


#: All pairs of queries and candidates, scored in DuckDB.
ORACLE = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
