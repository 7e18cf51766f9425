import random

import pytest
from helpers import contamination

from cardamom.llm.decontaminate import decontaminate


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in df.select("doc.doc_id", "n_words", "n_hit", "items", "contaminated").collect()), key=repr)


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture(scope="module")
def data():
    rng = random.Random(2)
    vocabulary = [f"W{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 13, 20, 30])))) for i in range(3, 25)]
    items += [(30, items[4][1]), (30, "other text of this item"), (31, None), (32, "..."), (None, items[6][1] + " and more words")]
    docs = []
    for i in range(80):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if i % 3 == 0:
            words[len(words) // 2 : len(words) // 2] = (rng.choice(items)[1] or "").split()
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words).lower()))
    docs += [(5, docs[5][1]), (None, docs[6][1]), (90, None), (91, ""), (92, "é " * 100_000)]
    return docs, [x for x in items if x[1] is None or len(x[1].split()) != 1 or rng.random() < 0.3]


@pytest.mark.parametrize("broadcast_words", [1 << 19, 0])
def test_both_ways_against_brute_force(spark, data, broadcast_words):
    docs, items = data
    got = rows(decontaminate(*tables(spark, docs, items), broadcast_words=broadcast_words))
    assert got == sorted(contamination(docs, items), key=repr)
    assert any(x[4] for x in got) and not all(x[4] for x in got)


@pytest.mark.parametrize("broadcast_words", [1 << 19, 0])
def test_empty_tables_and_clashing_columns(spark, data, broadcast_words):
    docs, items = data
    df, bench = tables(spark, docs, items)
    none = bench.where("false")
    assert all(x[2:] == (0, [], False) for x in rows(decontaminate(df, none, broadcast_words=broadcast_words)))
    assert decontaminate(df.where("false"), bench, broadcast_words=broadcast_words).count() == 0
    odd = df.where("doc_id < 9").selectExpr("*", "'a' as item", "1 as n_hit", "2 as row", "3 as len")
    out = decontaminate(odd, bench, broadcast_words=broadcast_words)
    assert out.select("doc.*").columns == ["doc_id", "item", "n_hit", "row", "len"] and out.count() == odd.count()


def test_one_word_in_twenty_is_enough(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    docs = [(i, passage + " " + " ".join(f"q{k}" for k in range(n))) for i, n in ((1, 247), (2, 248))]
    assert [x[4] for x in rows(decontaminate(*tables(spark, docs, [(7, passage)])))] == [True, False]
