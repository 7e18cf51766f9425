"""Exact top-k by inner product with a paged M-tree and best-first search.

An M-tree needs a metric.  Candidates y get one more coordinate that brings
them all to the same length M, queries x get a zero; then
|x - y|**2 = |x|**2 + M**2 - 2 x.y, so the nearest candidates are those with the
highest inner product.

Build: vectors are dealt to the nearest of a bounded sample of pivots, large
cells are split by a hash, and each part of bounded size becomes a tree.  Its
nodes are pages, one row each: a centre (one of the vectors), the covering
radius, the distance to the parent's centre; leaves also hold their vectors'
distances to the centre.

Search: a queue orders nodes by the least distance that anything inside can
have, and ends when that passes the k-th distance found.  The triangle
inequality on stored parent distances rules out children and vectors before
their distance is computed.  Each query first searches the tree it would
itself be in, which bounds its k-th score; then blocks of queries meet all
trees with that bound, and the best k of all trees are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.llm.common import column, written

SLACK = 1e-6  # distances are doubles, scores exact integers; for long vectors 1e-9 of the length more
PAGE = "tree long, node int, parent int, centre binary, radius double, parent_distance double, ids binary, vectors binary, distances binary"
FOUND = "query_id long, vec_id long, score long"


def _augment(vectors: np.ndarray, longest: int) -> np.ndarray:
    v = vectors.astype(np.float64)
    return np.hstack([v, np.sqrt(np.maximum(0.0, longest - (v * v).sum(axis=1)))[:, None]])


def _distances(centre: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def build_tree(ids: np.ndarray, vectors: np.ndarray, longest: int, leaf: int, fanout: int) -> list[dict]:
    """Nodes of an M-tree over some vectors, parents before children."""
    points = _augment(vectors, longest)
    order = np.argsort(ids, kind="stable")
    nodes: list[dict] = []
    waiting = [(order, order[0], -1)]
    while waiting:
        members, centre, parent = waiting.pop()
        away = _distances(points[centre], points[members])
        node = {"node": len(nodes), "parent": parent, "centre": points[centre], "radius": float(away.max())}
        node["parent_distance"] = float(np.linalg.norm(points[centre] - nodes[parent]["centre"])) if parent >= 0 else 0.0
        nodes.append(node)
        if len(members) <= leaf:
            node |= {"ids": ids[members], "vectors": vectors[members], "distances": away}
            continue
        # Farthest-first routing objects; equal vectors cannot be told apart and are split evenly.
        pivots, least = [members[0]], _distances(points[members[0]], points[members])
        while len(pivots) < min(fanout, -(-len(members) // leaf) + 1) and least.max() > 0:
            pivots.append(members[least.argmax()])
            least = np.minimum(least, _distances(points[pivots[-1]], points[members]))
        if len(pivots) == 1:
            parts = [(x, x[0]) for x in np.array_split(members, -(-len(members) // leaf))]
        else:
            nearest = np.stack([_distances(points[p], points[members]) for p in pivots]).argmin(axis=0)
            parts = [(members[nearest == i], p) for i, p in enumerate(pivots)]
        waiting.extend((x, c, node["node"]) for x, c in parts if len(x))
    return nodes


def _build(longest: int, leaf: int, fanout: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("vector"))
        nodes = build_tree(table.column("id").to_numpy(), vectors, longest, leaf, fanout)
        names = [x.split()[0] for x in PAGE.split(", ")]
        rows = {x: [] for x in names}
        for n in nodes:
            rows["tree"].append(key[0].as_py())
            for x in names[1:]:
                value = n.get(x)
                rows[x].append(value.tobytes() if isinstance(value, np.ndarray) else value)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array(rows[x], k) for x, k in zip(names, kinds)], names=names)

    return run


def _matrix(vectors) -> np.ndarray:
    n = len(vectors)
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64) if n else np.zeros((0, 0), np.int64)


NOTHING = -(1 << 62)  # lower than any score


class Tree:
    """The pages of a tree, ready to search."""

    def __init__(self, pages: pa.Table, longest: int):
        self.longest = longest
        rows = sorted(pages.to_pylist(), key=lambda r: r["node"])
        dim = len(rows[0]["centre"]) // 8
        # Without the last coordinate a centre is the vector it was made from.
        self.centre = np.rint(np.stack([np.frombuffer(r["centre"]) for r in rows])[:, :-1]).astype(np.int64)
        self.radius = np.array([r["radius"] for r in rows])
        self.parent_distance = np.array([r["parent_distance"] for r in rows])
        parent = np.array([r["parent"] for r in rows])
        self.children = [np.flatnonzero(parent == i) for i in range(len(rows))]
        self.leaves = [
            None if r["ids"] is None else (np.frombuffer(r["ids"], np.int64), np.frombuffer(r["vectors"], np.int64).reshape(-1, dim - 1), np.frombuffer(r["distances"]))
            for r in rows
        ]
        self.largest = max((int(np.abs(x[1]).max()) for x in self.leaves if x is not None and x[1].size), default=0)

    def search(self, own: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best ``k`` of the tree for each query: ids and scores, (queries, k), NOTHING where there are fewer.

        Ties go to smaller ids; ``floor`` are scores below which nothing is
        wanted.  Every query has a queue of its own and takes its nearest node
        from it; queries that take the same node are served together.
        """
        n, dim = vectors.shape
        # Doubles multiply matrices faster, and add up whole numbers exactly below 2**53.
        kind = np.float64 if max(self.largest, int(np.abs(vectors).max(initial=0))) ** 2 * dim < 1 << 52 else np.int64
        asked, centre = vectors.astype(kind), self.centre.astype(kind)
        leaves = [x and (x[0], x[1].astype(kind), x[2]) for x in self.leaves] if kind is np.float64 else self.leaves
        square = (asked * asked).sum(axis=1) + self.longest

        def distance(queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
            """From whole numbers, as all centres have the same length; only the root is rounded."""
            return np.sqrt(np.maximum(0.0, square[queries, None] - 2.0 * (asked[queries] @ centre[nodes].T)))

        def reach(queries: np.ndarray, score: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0.0, square[queries] - 2.0 * score)) + SLACK + 1e-9 * self.longest**0.5

        everyone = np.arange(n)
        ids, scores = np.full((n, k), np.iinfo(np.int64).max), np.full((n, k), NOTHING)
        least_wanted = floor.astype(np.int64)
        limit = np.where(least_wanted > NOTHING, reach(everyone, np.maximum(least_wanted, -(1 << 52))), np.inf)
        away = np.full((n, len(centre)), np.inf)
        queue = np.full((n, len(centre)), np.inf)
        root = np.zeros(1, np.int64)
        away[:, :1] = distance(everyone, root)
        queue[:, 0] = np.maximum(0.0, away[:, 0] - self.radius[0])
        while True:
            node = queue.argmin(axis=1)
            bound = queue[everyone, node]
            going = everyone[(bound <= limit) & (bound < np.inf)]
            if not len(going):
                return ids, scores
            queue[going, node[going]] = np.inf
            order = going[np.argsort(node[going], kind="stable")]
            for who in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
                at = node[who[0]]
                if leaves[at] is None:
                    below = self.children[at]
                    # Without computing: a child is at least this far.
                    could = np.abs(away[who, at][:, None] - self.parent_distance[below]) - self.radius[below] <= limit[who, None]
                    below = below[could.any(axis=0)]
                    if len(below):
                        d = distance(who, below)
                        away[np.ix_(who, below)] = d
                        queue[np.ix_(who, below)] = np.maximum(0.0, d - self.radius[below])
                    continue
                leaf_ids, rows, distances = leaves[at]
                near = np.abs(away[who, at][:, None] - distances) <= limit[who, None]
                near &= leaf_ids != own[who, None]
                need = near.any(axis=0)
                if not need.any():
                    continue
                got = (asked[who] @ rows[need].T).astype(np.int64)
                near = near[:, need] & (got >= np.maximum(scores[who, -1], least_wanted[who])[:, None])
                use, better = near.any(axis=1), near.any(axis=0)
                if not use.any():
                    continue
                who, got, near = who[use], got[np.ix_(use, better)], near[np.ix_(use, better)]
                all_scores = np.hstack([scores[who], np.where(near, got, NOTHING)])
                all_ids = np.hstack([ids[who], np.where(near, leaf_ids[need][better], np.iinfo(np.int64).max)])
                best = np.lexsort((all_ids, -all_scores), axis=-1)[:, :k]
                ids[who], scores[who] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_scores, best, 1)
                full = who[scores[who, -1] > NOTHING]
                limit[full] = np.minimum(limit[full], reach(full, scores[full, -1]))


def _search(longest: int, k: int):
    def run(key: tuple[pa.Scalar, ...], pages: pa.Table, queries: pa.Table) -> pa.Table:
        ids, scores, own = (np.zeros((0, k), np.int64),) * 2 + (np.zeros(0, np.int64),)
        if pages.num_rows and queries.num_rows:
            own = queries.column("id").to_numpy()
            floor = queries.column("floor").fill_null(NOTHING).to_numpy()
            ids, scores = Tree(pages, longest).search(own, _matrix(queries.column("vector")), k, floor)
        there = scores > NOTHING
        query = np.repeat(own, there.sum(axis=1))
        return pa.table([pa.array(query, pa.int64()), pa.array(ids[there]), pa.array(scores[there])], names=["query_id", "vec_id", "score"])

    return run


def quantized(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(id, vector) with components floor(scale * x); vectors that are NULL or hold NULL or non-finite numbers are left out."""
    x = column(vectors, vector_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    rows = vectors.select(column(vectors, id_col).cast("long").alias("id"), x.alias("vector")).where(F.col("id").isNotNull() & x.isNotNull() & ~bad & (F.size(x) > 0))
    return rows.select("id", F.transform("vector", lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vector"))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    pivots: int = 256,
    tree_rows: int = 8_192,
    leaf: int = 256,
    fanout: int = 16,
    block: int = 1_024,
) -> DataFrame:
    """The ``k`` vectors with the highest integer inner product for each query, exactly.

    Both tables have (id, vector) with integer components, as ``quantized``
    makes them.  A query does not find its own id.  Returns query_id, rank
    (from 1), vec_id, score; equal scores go to the smaller id, and a query
    gets all there are if fewer than ``k``.

    Rows that repeat an id count once, with the smallest vector.  Vectors that
    have not the commonest length take no part.  ``pivots`` only steer which
    vectors share a tree.  Empty tables give an empty table.
    """
    spark = vectors.sparkSession
    vectors = vectors.groupBy("id").agg(F.min("vector").alias("vector"))
    sizes = vectors.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = sizes["size"] if sizes else 0
    vectors = written(vectors.where(F.size("vector") == size), "vectors")
    queries = queries.groupBy("id").agg(F.min("vector").alias("vector")).where(F.size("vector") == size)
    square = F.aggregate("vector", F.lit(0).cast("long"), lambda s, v: s + v * v)
    facts = vectors.agg(F.count("*").alias("n"), F.coalesce(F.max(square), F.lit(0)).alias("longest")).first()
    n, longest = int(facts["n"]), int(facts["longest"])
    n_pivots = max(1, min(pivots, n // tree_rows))
    # One pivot for each of as many hash classes: the sample is bounded by its parameter.
    picked = vectors.groupBy(F.pmod(F.xxhash64("id"), F.lit(n_pivots)).alias("class")).agg(F.min_by("vector", F.xxhash64(F.lit("pivot"), "id")).alias("vector"))
    pivot_rows = np.array([r["vector"] for r in picked.orderBy("class").collect()], dtype=np.float64).reshape(-1, max(1, size))

    def nearest(df: DataFrame) -> DataFrame:
        return df.mapInArrow(_nearest(pivot_rows, longest), "id long, vector array<long>, cell long")

    celled = nearest(vectors)
    parts = celled.groupBy("cell").agg(F.count("*").alias("rows")).select("cell", F.ceil(F.col("rows") / tree_rows).alias("parts"))
    # At most one row for each pivot.
    parts = F.broadcast(parts)
    tree = F.pmod(F.xxhash64("id"), F.col("parts")) * n_pivots + F.col("cell")
    dealt = celled.join(parts, "cell").select("id", "vector", tree.alias("tree"))
    pages = written(dealt.groupBy("tree").applyInArrow(_build(longest, leaf, fanout), PAGE), "pages")

    # First bound: the query's own tree.
    none = F.lit(None).cast("long")
    # Queries whose cell is empty find no bound here, and search everything.
    home = nearest(queries).join(parts, "cell").select("id", "vector", none.alias("floor"), tree.alias("tree"))
    n_blocks = max(1, -(-queries.count() // block))
    blocks = F.pmod(F.xxhash64(F.lit("block"), "id"), F.lit(n_blocks)).cast("int")
    first = _meet(pages, home.withColumn("block", blocks), longest, k)
    floors = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") >= k)
    asked = written(queries.join(floors.select(F.col("query_id").alias("id"), "floor"), "id", "left").select("id", "vector", "floor", blocks.alias("block")), "queries")

    # Then all trees: each block of queries meets each tree once.
    pairs = pages.select("tree").distinct().select("tree", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    found = _meet(pages, asked.join(pairs, "block"), longest, k)
    rank = F.row_number().over(_by_query())
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _by_query():
    from pyspark.sql import Window

    return Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")


def _nearest(pivots: np.ndarray, longest: int):
    def run(batches):
        centres = _augment(pivots, longest)
        for batch in batches:
            points = _augment(_matrix(batch.column("vector")), longest) if batch.num_rows else np.zeros((0, centres.shape[1]))
            gap = (centres**2).sum(axis=1)[None, :] - 2 * points @ centres.T
            yield pa.record_batch([batch.column("id"), batch.column("vector"), pa.array(gap.argmin(axis=1).astype(np.int64))], names=["id", "vector", "cell"])

    return run


def _meet(pages: DataFrame, queries: DataFrame, longest: int, k: int) -> DataFrame:
    """Search each (tree, block) with the queries that are there."""
    # New names keep the two sides of the cogroup apart.
    wanted = queries.select(F.col("tree").alias("t"), F.col("block").alias("b")).distinct()
    pages = pages.select(*(F.col(x).alias(x) for x in pages.columns))
    sent = pages.join(wanted, F.col("tree") == F.col("t")).drop("t").withColumnRenamed("b", "block")
    return sent.groupBy("tree", "block").cogroup(queries.groupBy("tree", "block")).applyInArrow(_search(longest, k), FOUND)
