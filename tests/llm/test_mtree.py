import numpy as np
import pytest
from pyspark.sql import functions as F

from cardamom.llm import mtree
from cardamom.llm.mtree import build_tree, quantized, top_k


def brute(ids, vectors, k, asked):
    out = set()
    for q in asked:
        scores = sorted((-int(vectors[q] @ vectors[j]), int(ids[j])) for j in range(len(ids)) if ids[j] != ids[q])
        out |= {(int(ids[q]), rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])}
    return out


def rows(df):
    return {tuple(r) for r in df.collect()}


def frame(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [int(x) for x in v]) for i, v in zip(ids, vectors)], "id long, vector array<long>")


def test_against_brute_force(spark):
    rng = np.random.default_rng(8)
    centres = rng.integers(-60, 60, (6, 8))
    vectors = centres[rng.integers(0, 6, 700)] + rng.integers(-4, 5, (700, 8))
    vectors[100:400] = vectors[100]  # a third of all are the same vector: ties
    ids = rng.permutation(5000)[:700]
    df = frame(spark, ids, vectors)
    asked = np.flatnonzero(ids % 20 == 0)
    got = rows(top_k(df, df.where("id % 20 = 0"), k=7, tree_rows=90, leaf=8, fanout=3, block=9, pivots=4))
    assert got == brute(ids, vectors, 7, asked)


def test_tree_bounds_and_fewer_distances():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-50, 50, (20, 6))[rng.integers(0, 20, 2000)] + rng.integers(-2, 3, (2000, 6))
    longest = int((vectors**2).sum(axis=1).max())
    nodes = build_tree(np.arange(2000), vectors, longest, 32, 8)
    points = mtree._augment(vectors, longest)
    inside = {}
    for node in reversed(nodes):
        own = set(node.get("ids", [])) | set().union(*[inside[n["node"]] for n in nodes if n["parent"] == node["node"]])
        inside[node["node"]] = own
        assert mtree._distances(node["centre"], points[sorted(own)]).max() <= node["radius"] + 1e-9
    assert inside[0] == set(range(2000))
    import pyarrow as pa

    pages = pa.Table.from_pylist(
        [{k: v.tobytes() if isinstance(v, np.ndarray) else v for k, v in ({"ids": None, "vectors": None, "distances": None} | n).items()} for n in nodes]
    )
    tree = mtree.Tree(pages, longest)
    computed = []
    tree.leaves = [x and (x[0], _Counted(x[1], computed), x[2]) for x in tree.leaves]
    ids, scores = tree.search(np.array([5]), vectors[5:6], 10, np.array([mtree.NOTHING]))
    assert set(zip(ids[0].tolist(), scores[0].tolist())) == {(i, s) for _, _, i, s in brute(np.arange(2000), vectors, 10, [5])}
    assert sum(computed) < 1000  # of 2000 vectors


class _Counted:
    def __init__(self, rows, log):
        self.rows, self.log = rows, log

    def astype(self, kind):
        return _Counted(self.rows.astype(kind), self.log)

    def __getitem__(self, near):
        self.log.append(int(near.sum()))
        return self.rows[near]


def test_very_large_components(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-(1 << 28), 1 << 28, (300, 4))
    df = frame(spark, np.arange(300), vectors)
    got = rows(top_k(df, df.where("id % 20 = 0"), k=5, tree_rows=64, leaf=8, fanout=4, block=4))
    assert got == brute(np.arange(300), vectors, 5, range(0, 300, 20))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    raw = [(0, [0.5, -0.01]), (20, [nan, 1.0]), (40, [inf, 1.0]), (60, None), (80, [None, 1.0]), (100, [1.0, 0.99]), (3, [0.25, 0.25]), (None, [1.0, 1.0]), (7, [1.0]), (9, []), (3, [9.0, 9.0])]
    df = spark.createDataFrame(raw, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as vector")
    q = quantized(df)
    assert {(r.id, tuple(r.vector)) for r in q.collect()} == {(0, (32, -1)), (100, (64, 63)), (3, (16, 16)), (7, (64,)), (3, (576, 576))}
    got = rows(top_k(q, q.where("id % 20 = 0")))
    assert got == {(0, 1, 100, 32 * 64 - 63), (0, 2, 3, 16 * 31), (100, 1, 3, 16 * 127), (100, 2, 0, 32 * 64 - 63)}
    assert top_k(q.where("false"), q.where("false")).count() == 0
    assert top_k(q, q.where("false")).count() == 0
    with pytest.raises(Exception):
        q.select(F.col("nothing")).collect()
