from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cardamom.llm import queries as Q
from cardamom.llm.language_id import _grams, build_filters, fit_languages, has_letter, identify_language


def grams(text):
    return np.unique(_grams(pa.array([text]))[1])


def test_grams_stay_inside_texts_and_words():
    text, found = _grams(pa.array(["abcd", "", None, "ab cd", "x Abcd1efgh"]))
    as_text = [(t, int(g).to_bytes(4, "little").decode()) for t, g in zip(text, found)]
    assert as_text == [(0, "abcd"), (4, " abc"), (4, "abcd"), (4, "bcd "), (4, " efg"), (4, "efgh")]


def test_filters_return_all_languages_of_a_gram():
    names = [f"l{i:03}" for i in range(70)]  # more than one word of the mask
    own = {x: np.arange(1000 * i, 1000 * i + 1500, dtype=np.uint32) for i, x in enumerate(names)}
    model = build_filters(own, "l000")
    some = np.arange(0, 72_000, 37, dtype=np.uint32)
    masks = model.masks(some)
    for i, name in enumerate(model.languages):
        has = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) == 1
        truly = np.isin(some, own[name])
        assert has[truly].all()
        assert abs(has[~truly].mean() - model.false_rate[i]) < 0.02


def test_correction_for_false_positives():
    rng = np.random.default_rng(1)
    crowded = {"a": rng.integers(0, 2**32, 3000, dtype=np.uint32), "b": grams("zebra quilt yonder")}
    model = build_filters(crowded, "a", slots_per_gram=1, hashes=1)
    assert model.false_rate[0] > 0.5
    names, _ = model.predict(pa.array(["zebra quilt yonder"]))
    assert names == ["b"]


def test_letters():
    assert has_letter(pa.array(["a", "1", None, "", "é", "日", "—…", "12 b", "_"])).tolist() == [True, False, False, False, True, True, False, True, False]


def test_odd_rows(spark):
    text = {"xx": "lorem ipsum dolor sit amet consectetur ", "yy": "zwart kraai vliegt over het water "}
    rows = [(i, text[k] * 3, k) for i, k in enumerate(["xx", "yy"] * 30)] + [(100, None, "xx"), (101, "", "yy"), (102, "12 34", "xx"), (None, text["xx"], "yy"), (103, text["yy"] * 20_000, None), (104, "q", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as gram", "2 as lang_pred", "3 as n")
    out = identify_language(df, fit_languages(df))
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.select("doc.doc_id", F.col("lang_pred"), "score").collect()}
    assert all(got[i][0] == k for i, _, k in rows[:60])
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[None][0] == "xx" and got[103][0] == "yy" and got[104][0] in ("xx", "yy")
    assert all(0 <= s <= 1 for _, s in got.values())
    nothing = fit_languages(df.where("false"))
    assert {r.lang_pred for r in identify_language(df, nothing).select(F.col("lang_pred")).collect()} == {"und"}
    assert identify_language(df.where("false"), nothing).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.op8_language_id(spark, sf).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and len(held) > 250
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.99 * len(held)


def plain_grams(text):
    """n-grams of four bytes by the rule, each as bytes."""
    raw = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in (text or "").encode())
    out = []
    for k in range(len(raw) - 3):
        g = raw[k : k + 4]
        if 32 not in g[1:3] and not (g[0] == 32 and g[3] == 32) and g[0] & 0xC0 != 0x80:
            out.append(g)
    return out


def test_learning_and_prediction_by_a_plain_version(spark):
    """Sets in place of filters: the same n-grams are learned, and with few false positives the same languages found."""
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(10_000 + i, t, None) for i, t in enumerate([None, "", "123 456", "日本語の文", "xx"])]
    counts = {}
    for i, text, lang in rows:
        if lang is not None and crc32(str(i).encode()) % 3 != 1:
            counts.setdefault(lang, Counter()).update(plain_grams(text))
    rate = {x: {g: n / sum(c.values()) for g, n in c.items()} for x, c in counts.items()}
    own = {x: {g for g, n in c.items() if n >= 3 and rate[x][g] >= 0.5 * max(r.get(g, 0) for r in rate.values())} for x, c in counts.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_languages(df)
    assert model.languages == tuple(sorted(own))
    some = np.unique([int.from_bytes(g, "little") for c in counts.values() for g in c]).astype(np.uint32)
    masks = model.masks(some)[:, 0]
    for i, name in enumerate(model.languages):
        found = (masks >> np.uint64(i)) & np.uint64(1) == 1
        truly = np.isin(some, [int.from_bytes(g, "little") for g in own[name]])
        assert found[truly].all() and found[~truly].mean() < 2 * model.false_rate[i] + 0.01
    got = {r[0]: r[1] for r in identify_language(df, model).select("doc.doc_id", "lang_pred").collect()}
    sure = 0
    for i, text, _ in rows:
        mine = plain_grams(text)
        shares = sorted(((sum(g in own[x] for g in mine) / max(1, len(mine)), x) for x in own), reverse=True)
        if not any(c.isalpha() for c in text or ""):
            assert got[i] == "und"
        elif shares[0][0] > shares[1][0] + 0.1:  # beyond what false positives can do
            assert got[i] == shares[0][1]
            sure += 1
    assert sure > 150
