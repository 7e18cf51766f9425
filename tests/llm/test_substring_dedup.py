import random

import pytest
from helpers import cut, sha, spaced

from cardamom.llm import queries as Q
from cardamom.llm.substring_dedup import dedup_substrings


def check(spark, docs, window, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = dedup_substrings(df, window=window, **options).selectExpr("doc.doc_id", "n_words", "n_removed", "text", "removed").collect()
    got = sorted(((r[0], r[1], r[2], " ".join(spaced(r[3]))) for r in found), key=repr)
    assert got == sorted(cut(docs, window), key=repr)
    return found


def test_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(4, 30))] for _ in range(12)]
    docs = []
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.4 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 20))]
        docs.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    docs += [(200 + i, docs[3][1]) for i in range(20)]
    check(spark, docs, 5, chunk_bytes=1 << 10)
    check(spark, docs, 9, depth=1)


def test_odd_rows(spark):
    run = "one two three four five six"
    docs = [
        (1, run), (1, run), (2, None), (3, ""), (4, " \n\t "), (None, run), (None, run),
        (5, "x " + run + "\ny"), (6, run[:-1]), (7, "é" * 200_000 + " " + run), (8, (run + " ") * 300),
    ]
    found = check(spark, docs, 6)
    by_id = {r[0]: r for r in found if r[0] is not None}
    assert by_id[2]["text"] is None and by_id[4]["text"] == " \n\t "
    # The text around a cut stays as it was.
    assert by_id[5]["text"] == "x y" and [tuple(x) for x in by_id[5]["removed"]] == [(1, 6)]


def test_columns_with_clashing_names_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b c", 7, "q"), (2, "a b c d", 8, "r")], "doc_id long, text string, chunk long, `n_words` string")
    out = dedup_substrings(df, window=3)
    assert sorted(tuple(r) for r in out.selectExpr("doc.doc_id", "doc.chunk", "doc.n_words", "n_words", "n_removed", "text").collect()) == [
        (1, 7, "q", 3, 0, "a b c"), (2, 8, "r", 4, 3, "d"),
    ]
    assert dedup_substrings(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        dedup_substrings(df, window=1)


def test_query_on_a_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in Q.op1_substring_dedup(spark, sf).collect())
    assert got == sorted((i, n, k, sha(text)) for i, n, k, text in cut(docs, 50))
