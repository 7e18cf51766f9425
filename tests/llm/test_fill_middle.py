import hashlib
import random

import numpy as np
import pytest
from helpers import sha

from cardamom.llm import queries as Q
from cardamom.llm.fill_middle import ERROR, RankIndex, fill_in_middle, fit_lines, restored


def plainly(i, text):
    """(n, form, prefix, middle, output) by the rule, on characters."""
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def found(spark, rows):
    df = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    picked = df.select("doc.doc_id", "n", "form", "prefix_chars", "middle_chars", "output", restored(df.output, df.form).alias("again"))
    return [tuple(r) for r in picked.collect()]


def check(spark, rows):
    got = found(spark, rows)
    assert sorted(got, key=repr) == sorted(((i, *plainly(i, t), t or "") for i, t in rows), key=repr)
    return got


def test_against_the_rule(spark):
    rng = random.Random(3)
    letters = "ab <>PSM\néßж漢🦊\u0000‍"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(600)]
    got = check(spark, rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_odd_rows(spark):
    long = "漢a🦊é " * 2_000_000  # 24 MB in one text
    check(
        spark,
        [
            (1, None), (2, ""), (3, "a"), (4, "🦊"), (5, "x<P>y"), (6, "<S>"), (7, "z <M>"), (8, "<P"), (8, "<P"), (8, "other text"),
            (None, "no id at all"), (None, None), (-9, "negative"), (11, "S>P>M> <<<"), (12, long), (13, long), (14, "b" * 3_000_000),
        ],
    )


def test_many_equal_rows_and_none(spark):
    rows = [(5, "the same row, é")] * 300 + [(i, f"row {i}") for i in range(600)]
    check(spark, rows)
    df = spark.createDataFrame([(1, "a b c", 7, "q", "r")], "doc_id long, text string, n int, form string, output string")
    out = fill_in_middle(df)
    assert out.columns == ["doc", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert tuple(out.select("doc.n", "doc.form", "doc.output", "n").first()) == (7, "q", "r", 5)
    assert fill_in_middle(df.where("false")).count() == 0


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_index_is_exact(block):
    rng = random.Random(5)
    text = "".join(rng.choice(["a", "é", "漢", "🦊"]) * rng.randint(1, 400) for _ in range(300))
    data = np.frombuffer(text.encode(), np.uint8)
    at = np.array([0, 0, len(data), len(data)])
    index, ranks = RankIndex.of(data, at, block)
    assert list(ranks) == [0, 0, len(text), len(text)]
    want = np.cumsum([0] + [len(x.encode()) for x in text])
    assert (index.lookup(np.arange(len(text) + 1)) == want).all()
    if block > len(data):
        # Runs of one kind of letter are lines; the index is far smaller than the text.
        assert len(index.first) < len(text) / 50


def test_lines_stay_within_their_error():
    steps = np.random.default_rng(1).integers(1, 5, 50_000)
    offsets = np.cumsum(steps)
    first, slope = fit_lines(offsets)
    line = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(offsets))))
    off = offsets - offsets[first[line]] - slope[line] * (np.arange(len(offsets)) - first[line])
    assert np.abs(off).max() <= ERROR + 1e-6 and 1 < len(first) < 200
    assert len(fit_lines(np.arange(1000))[0]) == 1 and len(fit_lines(np.zeros(0, np.int64))[0]) == 0


def test_sentinels_must_not_overlap(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P>", "><", "<M>"), ("<P><", "<S>", "<M>"), ("P", "<P>", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle(df, sentinels=bad)


def test_query_on_a_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = sorted((i, n, form, p, m, sha(out), sha(t or "")) for i, t in docs for n, form, p, m, out in [plainly(i, t)])
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(tuple(r) for r in Q.op11_fill_in_middle(spark, sf).select(names).collect()) == want
