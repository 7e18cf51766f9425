import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cardamom.llm import queries as Q
from cardamom.llm import words as W
from cardamom.llm.quality import ABSTAIN, BAD, GOOD, LABELLERS, fit_labels, fit_quality, score_quality, statistics, votes


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(0)
    n, accuracy, speaks = 60_000, np.array([0.9, 0.8, 0.7, 0.85, 0.6, 0.75]), np.array([0.9, 0.7, 0.8, 0.5, 0.9, 0.6])
    truth = rng.random(n) < 0.65
    right = rng.random((n, 6)) < accuracy
    vote = np.where(right, truth[:, None], ~truth[:, None]).astype(int)
    vote[rng.random((n, 6)) >= speaks] = ABSTAIN
    patterns, times = np.unique(vote, axis=0, return_counts=True)
    model = fit_labels(patterns, times.astype(float))
    assert np.abs(model.accuracy - accuracy).max() < 0.03 and abs(model.good - 0.65) < 0.03
    posterior = model.posterior(vote)
    majority = (vote == GOOD).sum(axis=1) - (vote == BAD).sum(axis=1) > 0
    assert ((posterior > 0.5) == truth).mean() > (majority == truth).mean()


def test_statistics_and_votes():
    texts = ["One two three four. Five six seven eight nine.", "WHY!! NOT!! THIS!!", "a### b$$$ c%%%", "go go go go go go go go", "x | y | z | w", "same line\nsame line\nsame line", None, ""]
    stats = statistics(pa.array(texts))
    vote = dict(zip((x[0] for x in LABELLERS), votes(stats).T.tolist()))
    assert stats["length"].tolist() == [9, 3, 3, 8, 7, 6, 0, 0]
    assert vote["shouts"][:2] == [ABSTAIN, BAD] and vote["capitals"][1] == BAD
    assert vote["symbols"][2] == BAD and vote["signed"][2] == BAD
    assert vote["repeats"][3] == BAD and vote["bars"][4] == BAD and vote["lines"][5] == BAD
    assert vote["prose"][0] == GOOD and vote["length"][6:] == [BAD, BAD]
    assert all(v[6] == ABSTAIN for k, v in vote.items() if k != "length")


def test_variety_of_whole_texts():
    opening = ". ".join(" ".join(f"word{10 * i + k}" for k in range(10)) for i in range(12)) + "."
    menu = " ".join(["home", "news", "shop", "about"] * 25)
    good = " ".join(f"w{i}" + "." * (i % 10 == 9) for i in range(1900))
    short = " ".join(f"w{i % 40}" for i in range(50))
    texts = [f"{opening} " + "buy this now here today. " * 1000, f"{menu} {good}", opening, None, short, menu, " ".join(f"w{i}" for i in range(250))]
    stats = statistics(pa.array(texts))
    names = [x[0] for x in LABELLERS]
    vote = dict(zip(names, votes(stats).T.tolist()))
    assert vote["variety"] == [BAD, ABSTAIN, ABSTAIN, ABSTAIN, ABSTAIN, BAD, ABSTAIN]
    assert vote["prose"][:3] == [ABSTAIN, GOOD, GOOD]
    assert np.isnan(stats["variety"][3]) and np.allclose(stats["variety"][[1, 2, 4, 5, 6]], [(4 + 1900) / 2000, 1, 0.8, 0.04, 1])


def test_odd_rows(spark):
    plain = "The river runs past the old mill and the children play there. It was late when they went home again."
    rows = [(i, f"{plain} Number {i} of them.") for i in range(60)] + [(100 + i, f"BUY{i}### NOW$$$ | " * 20) for i in range(20)]
    rows += [(1, rows[1][1]), (None, plain), (200, None), (201, ""), (202, (plain + " ") * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "2 as pattern", "3 as all")
    model = fit_quality(df)
    out = score_quality(df, model)
    got = {r[0]: (r[1], r[2]) for r in out.select("doc.doc_id", out["score"], "predicted").collect()}
    assert all(got[i][1] == 1 for i in range(60)) and all(got[100 + i][1] == 0 for i in range(20))
    assert all(0 <= s <= 1 for s, _ in got.values()) and got[200] == got[201]
    nothing = fit_quality(df.where("false"))
    assert {r.score for r in score_quality(df.select("doc_id", "text"), nothing).select("score").collect()} == {0.5}
    assert score_quality(df.where("false"), nothing).count() == 0


def test_against_true_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = Q.op10_quality(spark, sf).collect()
    assert len(got) == 1000
    good = [r.score for r in got if labels.get(r.doc_id) == 1]
    bad = [r.score for r in got if labels.get(r.doc_id) == 0]
    above = np.mean([[g > b for b in bad] for g in good])
    assert above > 0.97


def plain_statistics(text):
    raw = (text or "").encode()
    words = raw.split()
    n, letters = len(words), sum(chr(b).isalpha() for b in raw if b < 128)
    signs = {b for b in range(33, 128) if not chr(b).isalnum()} - set(b".,;:'\"-?()")
    share = lambda x, of: x / of if of else float("nan")
    stops = sum(raw.count(x) for x in (b".", b"!", b"?"))
    lines = [x for x in re.findall(rb"[^\n]*\n|[^\n]+\Z", raw)]
    blocks = [words[k : k + 100] for k in range(0, n, 100)]
    out = {
        "symbols": share(sum(b in signs for b in raw), len(raw)),
        "signed": share(sum(w[-1] in signs for w in words), n),
        "bars": share(raw.count(b"|"), n),
        "capitals": share(sum(65 <= b <= 90 for b in raw), letters),
        "shouts": share(raw.count(b"!"), n),
        "repeats": share(sum(a == b for a, b in zip(words, words[1:])), n),
        "variety": 1 - share(sum(len(b) - len(set(b)) for b in blocks), n),
        "lines": share(len(lines) - len(set(lines)), len(lines) if len(lines) > 1 else 0),
        "sentence": n / (stops or 0.5) if n else float("nan"),
        "length": float(n),
    }
    least = (("symbols", 0.03), ("signed", 0.05), ("bars", 0.02), ("capitals", 0.2), ("shouts", 0.1), ("repeats", 0.03), ("lines", 0.1))
    return out | {"prose": all(not out[x] >= most for x, most in least) and n > 0 and not out["variety"] < 0.25}


def plain_score(model, text):
    """Logistic curve of the weights of a text's trigrams and bins, added up one by one."""
    raw, stats = (text or "").encode(), plain_statistics(text)
    slot = lambda x: int(W.mix(np.array([x], np.uint64))[0]) >> (64 - model.log_size)
    slots = Counter(slot(1 + int.from_bytes(raw[k : k + 3], "little")) for k in range(len(raw) - 2))
    z = model.bias + sum(10 * math.sqrt(n / (len(raw) - 2)) * model.weights[s] for s, n in slots.items())
    for j, (name, *_) in enumerate(LABELLERS):
        x = float(stats[name])
        x = -1.0 if math.isnan(x) else x
        with np.errstate(divide="ignore"):
            tenth = np.clip(np.floor(np.log2(x + 1) * 10 if name in ("length", "sentence") else x * 20), -1, 400) + 2
        z += model.weights[slot(int(tenth * 64 + j + (1 << 32)))]
    return 1 / (1 + math.exp(-min(40, max(-40, z))))


def test_scores_by_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = fit_quality(docs)
    odd = [None, "", " ", "a", "ab", "| | |", "x\n\nx\n\nx\n", "é 漢 字 " * 40, "one one one\none one one\n"]
    rows = [tuple(r) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(odd)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in score_quality(frame, model).select("doc.doc_id", "score", "predicted").collect()}
    found = statistics(pa.array([t for _, t in rows]))
    for k, (i, text) in enumerate(rows):
        plain = plain_statistics(text)
        assert all(found[x][k] == pytest.approx(plain[x], nan_ok=True) for x in plain), text
        score = plain_score(model, text)
        assert got[i] == (pytest.approx(score, abs=1e-9), int(score >= 0.5))
