import random
from itertools import combinations_with_replacement

import numpy as np
from helpers import spaced
from pyspark.sql import functions as F

from cardamom.llm import queries as Q
from cardamom.llm.packing import best_plan, pack, packed_texts, word_count


def placed(spark, lengths, **options):
    df = spark.createDataFrame(lengths, "doc_id long, n long")
    return pack(df, F.col("n"), **options).collect()


def test_every_piece_has_its_own_place(spark):
    rng = random.Random(4)
    lengths = [(i, rng.choice([rng.randint(1, 60), rng.randint(1, 600), 2500])) for i in range(800)]
    found = placed(spark, lengths, capacities=(128, 256, 512, 1000), shard_pieces=300)
    bins = {}
    for r in found:
        bins.setdefault(r.bin_id, []).append(r)
    for rows in bins.values():
        assert len({r.capacity for r in rows}) == 1
        end = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        fits = [c for c in (128, 256, 512, 1000) if c >= end]
        assert rows[0].capacity == fits[0]  # downsized
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
    for i, n in lengths:
        end = 0
        for start, length in sorted(by_doc[i]):
            assert start == end and 0 < length <= 1000
            end += length
        assert end == n
    assert len({b.split("-")[0] for b in bins}) > 1
    slots = sum(rows[0].capacity for rows in bins.values())
    assert sum(n for _, n in lengths) / slots > 0.97


def cheapest(lengths, sizes, fixed):
    """Least cost over all ways to share small inputs out."""
    best = [float("inf")]

    def put(rest, bins):
        if not rest:
            best[0] = min(best[0], sum(min(s for s in sizes if s >= b) + fixed for b in bins))
            return
        x, *rest = rest
        for i in range(len(bins)):
            if bins[i] + x <= sizes[-1]:
                put(rest, [*bins[:i], bins[i] + x, *bins[i + 1 :]])
        put(rest, [*bins, x])

    put(sorted(lengths, reverse=True), [])
    return best[0]


def test_close_to_the_cheapest_packing():
    sizes, fixed, ratios = (4, 8, 16), 1.0, []
    rng = random.Random(9)
    for _ in range(60):
        lengths = [rng.randint(1, 16) for _ in range(6)]
        x, n = np.unique(lengths, return_counts=True)
        bins, cost = best_plan(x, n, sizes, fixed)
        assert sorted(k for number, _, contents in bins for k, times in contents for _ in range(number * times)) == sorted(lengths)
        ratios.append(cost / cheapest(lengths, sizes, fixed))
    assert min(ratios) >= 1 - 1e-9 and max(ratios) <= 1.35 and np.mean(ratios) < 1.03


def test_joint_choice_beats_one_size():
    x, n = np.array([3, 5]), np.array([400, 400])
    _, joint = best_plan(x, n, (3, 5, 8), 0.0)
    assert joint == 400 * 8
    for size in combinations_with_replacement((5, 8), 1):
        assert joint <= best_plan(x, n, size, 0.0)[1]


def test_odd_rows_and_texts(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", 5), (2, None, 5), (3, " \n", 6), (4, "d  e\nf g h", 1), (4, "d  e\nf g h", 1), (None, "x", 2)], "doc_id long, text string, piece long"
    )
    found = pack(docs, word_count(F.col("text")), capacities=(4, 2))
    got = sorted(((r.doc_id, r.piece, r.start, r.length) for r in found.collect()), key=repr)
    assert got == sorted([(1, 0, 0, 3), (4, 0, 0, 4), (4, 0, 0, 4), (4, 1, 4, 1), (4, 1, 4, 1), (None, 0, 0, 1)], key=repr)
    texts = packed_texts(found, docs).collect()
    assert sorted(" ".join(r.text for r in texts).split()) == sorted("a b c d e f g h d e f g h x".split())
    assert all(r.used == len(r.text.split()) <= r.capacity for r in texts)
    assert pack(docs.where("false"), word_count(F.col("text"))).count() == 0
    assert pack(docs, F.lit(0)).count() == 0


def test_query_on_a_table(spark):
    """Every word of every text has one place, no place is used twice, and bins are as small as their contents allow."""
    sf = "/root/testdata/sf0.01"
    words = {r.doc_id: len(spaced(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = Q.op3_best_fit_packing(spark, sf).collect()
    pieces, bins = {}, {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        bins.setdefault((r.bin_id, r.capacity), []).append((r.offset, r.length))
    for i, n in words.items():
        end = 0
        for start, length in sorted(pieces.get(i, [])):
            assert start == end and 0 < length <= 4096
            end += length
        assert end == n
    used = 0
    for (_, capacity), parts in bins.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert capacity == min(c for c in (512, 1024, 2048, 4096) if c >= end)
        used += capacity
    assert sum(words.values()) / used > 0.97


def test_equal_rows_are_dealt_over_the_shards(spark):
    lengths = [(7, 40)] * 3000 + [(i, 10 + i % 90) for i in range(6000)]
    found = placed(spark, lengths, capacities=(128, 256), shard_pieces=500)
    assert len(found) == 9000
    shards = {}
    for r in found:
        shards[r.bin_id.split("-")[0]] = shards.get(r.bin_id.split("-")[0], 0) + 1
    assert max(shards.values()) < 2 * sorted(shards.values())[len(shards) // 2]
