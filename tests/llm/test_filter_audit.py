import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
from helpers import spaced

from cardamom.llm import filter_audit as A
from cardamom.llm import queries as Q


def judged(docs):
    """[(id, part, text)] -> [(id, part, set of filters failed)]."""
    least = {}
    for i, _, text in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    out = []
    for i, part, text in docs:
        t, w = text or "", spaced(text)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and i > least[t],
        }
        out.append((i, part or "", {k for k, x in fails.items() if x}))
    return out


def audit(docs, labels):
    """The report by applying the filters one after the other, order by order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, part, fails in judged(docs):
        parts[part].append((i, fails))
    rows = []
    for part, members in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        mine = []
        for order in permutations("ABCDE"):
            left = members
            for step, x in enumerate(order, 1):
                lost = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                shapley[x] += len(lost)
                redundant = sum(x in f for _, f in members) - len(lost)
                unique = sum(f == {x} for _, f in members)
                mine.append((part, "".join(order), step, len(left), len(lost), redundant, unique, sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost), x))
        rows += [(*r[:-1], shapley[r[-1]]) for r in mine]
    return sorted(rows)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def check(spark, docs, labels):
    df = spark.createDataFrame([(i, t, p) for i, p, t in docs], "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in A.audit_filters(df, marks).select(COLUMNS).collect()) == audit(docs, labels)
    fails = [(r.id, r.part, {x for k, x in enumerate("ABCDE") if r.mask >> k & 1}) for r in A.judge_filters(df).collect()]
    assert sorted(fails, key=repr) == sorted(judged(docs), key=repr)


def corpus(rng, n):
    docs = []
    for i in range(n):
        words = [rng.choice(["ab", "Cde", "f", "ghi#", "é", "X"]) + str(rng.randrange(rng.choice([3, 3000]))) for _ in range(rng.choice([0, 5, 199, 200, 201, 400]))]
        text = docs[rng.randrange(i)][2] or "" if i and rng.random() < 0.3 else rng.choice([" ", "\n", "  "]).join(words)
        docs.append((rng.randrange(3 * n) if i % 9 else None, rng.choice(["aa", "bb", "", None]), rng.choice([text, text.lower(), None if i % 17 == 0 else text])))
    labels = [(rng.randrange(3 * n), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(2 * n)]
    return docs, labels


def test_against_every_order(spark):
    check(spark, *corpus(random.Random(8), 400))


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(300_000))
    base = " ".join(f"w{k}" for k in range(200))
    docs = [
        (1, "x", None), (2, "x", ""), (None, "x", ""), (3, None, " \n"), (5, "y", base), (5, "y", base), (4, "y", base), (9, "", base + " Z"),
        (7, "y", long), (8, "y", long + "|"), (6, "z", "ABC " * 100_000), (10, "x", " " * 40), (None, "z", base),
    ]
    check(spark, docs, [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (77, 1, 1)])
    check(spark, docs, [])


def test_a_third_of_all_rows_equal(spark):
    docs = [(4, "x", "the same row")] * 200 + [(1000 + i, "x", "one text") for i in range(200)] + [(i, "y", f"row {i}") for i in range(200)]
    check(spark, docs, [(4, 1, 0), (1000, 0, 1), (1001, 1, 1)])


def test_columns_with_clashing_names_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", "x", 7, 8, "q", True)], "doc_id long, text string, lang string, part int, mask int, digest string, first boolean")
    marks = spark.createDataFrame([(1, 1, 1, "m")], "doc_id long, quality int, toxic int, part string")
    assert A.audit_filters(df, marks).count() == 600
    assert A.audit_filters(df.where("false"), marks).count() == 0
    assert A.audit_filters(df, marks.where("false")).selectExpr("sum(good_lost + toxic_lost) as n").first().n == 0


def test_words_of_32_bits():
    for mask in range(32):
        assert [A.SURVIVAL[mask] >> s & 1 for s in range(32)] == [int(s & mask == 0) for s in range(32)]
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 3, 10, 1000, 4097):
        words = rng.integers(0, 2**32, n, dtype=np.uint32)
        bits = np.unpackbits(words.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        assert (A.positional_popcount(words) == bits.astype(int).sum(axis=0)).all()


def test_words_are_counted_by_pieces():
    text = (" ".join(f"w{k % 77}" for k in range(5000)) + " \t\n").encode()
    for piece in (1, 3, 100, 1 << 20):
        assert A.count_words(text, piece) == (5000, 77)
    assert A.count_words(b"") == (0, 0) and A.count_words("a\u00a0b\x1cc".encode()) == (1, 1)


def test_query_on_a_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert sorted(tuple(r) for r in Q.op13_filter_audit(spark, sf).select(COLUMNS).collect()) == audit(docs, labels)
