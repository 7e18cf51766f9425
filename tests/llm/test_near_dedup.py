import random

import numpy as np
import pyarrow as pa
from helpers import classes

from cardamom.llm import near_dedup, probminhash
from cardamom.llm import queries as Q
from cardamom.llm import words as W
from cardamom.llm.components import components
from cardamom.llm.near_dedup import near_duplicates


def as_classes(df):
    return {r.doc_id: r.class_id for r in df.collect() if r.doc_id is not None}


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    shingle = rng.integers(1, 2**63, 300, dtype=np.uint64)
    a, b = rng.integers(1, 5, 200).astype(float), rng.integers(1, 5, 200).astype(float)
    x, y = dict(zip(shingle[:200].tolist(), a)), dict(zip(shingle[100:].tolist(), b))
    expected = 0.0
    for i in x.keys() & y.keys():
        expected += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
    text = np.repeat([0, 1], 200)
    sig = probminhash.signatures(2, text, np.concatenate((shingle[:200], shingle[100:])), np.concatenate((a, b)), 20_000)
    assert abs((sig[0] == sig[1]).mean() - expected) < 0.015


def test_shingles_and_copies():
    words = W.find_words(pa.array(["a b c d e f", "A b-c D, e f.", "a b", "a b", None, "a a a a a a a"]))
    text, shingle, times = probminhash.shingle_sets(words)
    sets = [sorted(zip(shingle[text == i].tolist(), times[text == i].tolist())) for i in range(6)]
    assert sets[0] == sets[1] and len(sets[0]) == 2
    assert sets[2] == sets[3] and len(sets[2]) == 1
    assert sets[4] == [] and [t for _, t in sets[5]] == [3]


def family(rng, n, length, edits, first):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(length)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(length)] = f"v{rng.randint(0, 10**6)}"
        out.append((first + i, " ".join(words)))
    return out


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    docs = family(rng, 120, 150, 6, 1000) + family(rng, 60, 60, 3, 2000) + family(rng, 30, 12, 1, 3000)
    docs += [(i, " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(80))) for i in range(50)]
    docs += [(4000 + i, docs[i][1].upper()) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    expected = classes(docs)
    assert len(set(expected.values())) < len(docs) - 100
    assert as_classes(near_duplicates(df)) == expected
    monkeypatch.setattr(near_dedup, "BLOCK", 8)  # buckets in several blocks
    assert as_classes(near_duplicates(df)) == expected


def test_passages_repeated_on_one_side(spark):
    rng = random.Random(5)
    docs = []
    for i in range(0, 160, 2):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(100)]
        end = [[f"w{rng.randint(0, 10**6)}" for _ in range(n)] for n in (6, 10)]
        docs += [(i, " ".join(base[:33] * 100 + base[33:] + end[0])), (i + 1, " ".join(base + end[1]))]
    expected = classes(docs)
    assert all(expected[i + 1] == i for i in range(0, 160, 2))
    assert as_classes(near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == expected


def test_odd_rows(spark):
    long = " ".join(f"z{i}" for i in range(40_000))
    docs = [
        (1, "a b"), (2, "A, b!"), (3, "a"), (4, None), (5, ""), (6, "..."), (None, "a b"), (8, long), (9, long + " end"),
        (10, "same words here again and again"), (10, "same words here again and again"), (11, "same words here again and again"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as id", "'x' as band", "2 as k1")
    out = near_duplicates(df)
    assert out.count() == len(docs) and out.columns == ["doc_id", "class_id", "copy_of"]
    assert as_classes(out) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 8: 8, 9: 8, 10: 10, 11: 10}
    assert [tuple(r) for r in out.where("doc_id is null").collect()] == [(None, None, None)]
    assert near_duplicates(df.where("false")).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 103), (7, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 103: 100, 105: 100}
    star = spark.range(1, 3000).selectExpr("id as a", "0L as b")
    assert components(star, "a", "b").where("component <> 0").count() == 0
    assert components(star.where("false"), "a", "b").count() == 0


def test_query_on_a_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert as_classes(Q.op2_near_dedup(spark, sf)) == classes(docs)
