import random

import pytest
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from cardamom.llm import queries as Q
from cardamom.llm.token_counts import SPACE, Vocabulary, _Counter, count_tokens, load_vocabulary


def library(v):
    model = Tokenizer(Unigram(list(zip(v.pieces, v.scores)), 0, v.byte_fallback))

    def count(text):
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        return len(model.encode(SPACE + text if v.prefix else text, add_special_tokens=False).ids)

    return count


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(Q.VOCABULARY)


def random_texts(n, letters):
    rng = random.Random(n)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_same_counts_as_the_library(spark, vocabulary):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = docs + random_texts(600, "ab e\nthé🙂ing 日\t") + ["", " ", "\n\n", "<s> <0x0A>", "  lead", "trail  ", "\0"]
    count = library(vocabulary)
    import pyarrow as pa

    counter = _Counter(vocabulary)
    expected = [count(t) for t in texts]
    assert counter(pa.array(texts)).tolist() == expected
    assert counter(pa.array(texts[::-1])).tolist() == expected[::-1]  # now from memory


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_ties_and_odd_vocabularies(byte_fallback):
    import pyarrow as pa

    # Many equal scores, entries across spaces, and characters that are no entry.
    pieces = ["<unk>", "a", "b", "aa", "ab", "ba", "aab", "bab", "abab", f"a{SPACE}b", SPACE, f"{SPACE}a", "\n"]
    scores = [0.0, -2.0, -2.0, -4.0, -4.0, -4.0, -6.0, -6.0, -8.0, -5.0, -1.0, -3.0, -2.0]
    if byte_fallback:
        pieces += [f"<0x{i:02X}>" for i in range(256)]
        scores += [0.0] * 256
    v = Vocabulary(tuple(pieces), tuple(scores), byte_fallback=byte_fallback)
    assert not v.segmented
    texts = random_texts(800, "aab b\nxé")
    count = library(v)
    assert _Counter(v)(pa.array(texts)).tolist() == [count(t) for t in texts]
    split = Vocabulary(tuple(x for x in pieces if x != f"a{SPACE}b"), tuple(s for x, s in zip(pieces, scores) if x != f"a{SPACE}b"), byte_fallback=byte_fallback)
    count = library(split)
    assert split.segmented and _Counter(split)(pa.array(texts)).tolist() == [count(t) for t in texts]


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_scores_that_are_no_whole_numbers(byte_fallback):
    import pyarrow as pa

    # Tenths: sums of equal worth differ in their last bits, by what the text has added up before.
    rng = random.Random(12)
    pieces = ["<unk>", SPACE, "\n"] + [f"{s}{x}" for s in ("", SPACE) for x in ("a", "b", "aa", "ab", "ba", "bb", "aab", "abab", "é")]
    scores = [0.0] + [-len(x) / 10 - rng.choice([0, 0.1, 0.2]) for x in pieces[1:]]
    if byte_fallback:
        pieces += [f"<0x{i:02X}>" for i in range(256)]
        scores += [0.0] * 256
    v = Vocabulary(tuple(pieces), tuple(scores), byte_fallback=byte_fallback)
    assert v.segmented and not v.exact_sums
    texts = ["".join(rng.choice("aaabbb  \néx") for _ in range(rng.randint(0, 300))) for _ in range(1000)]
    count = library(v)
    assert _Counter(v)(pa.array(texts)).tolist() == [count(t) for t in texts]
    loose = Vocabulary(("<unk>", "a", "b"), (0.0, -1.0, -2.0), byte_fallback=False)
    count = library(loose)
    assert not loose.segmented and _Counter(loose)(pa.array(texts)).tolist() == [count(t) for t in texts]


def test_equal_segments_are_counted_once(vocabulary, monkeypatch):
    import pyarrow as pa

    # Some entries of this vocabulary cost 10**9, so that only very long texts have rounded sums.
    assert vocabulary.exact_sums and vocabulary.exact_bytes > 1 << 22
    expected = library(vocabulary)("some words over and over ")
    seen, plain = [], Vocabulary.count
    monkeypatch.setattr(Vocabulary, "count", lambda self, text, *reached: seen.append(text) or plain(self, text, *reached))
    assert _Counter(vocabulary)(pa.array(["some words over and over "] * 500)).tolist() == [expected] * 500
    assert len(seen) == len(set(seen)) <= 6


def test_whole_numbers_in_texts_too_long_for_exact_sums(monkeypatch):
    import pyarrow as pa

    rng = random.Random(9)
    pieces = ["<unk>", SPACE] + [f"{s}{x}" for s in ("", SPACE) for x in ("a", "b", "aa", "ab", "ba", "bb", "aab", "abab")]
    scores = [0.0] + [float(-len(x) * 2**45 - rng.choice([0, 1, 2, 3])) for x in pieces[1:]]
    v = Vocabulary(tuple(pieces), tuple(scores), byte_fallback=False)
    assert v.segmented and v.exact_sums and 40 < v.exact_bytes < 100
    texts = ["".join(rng.choice("aaabbb x") for _ in range(rng.choice([0, 20, 40, 60, 400, 2000]))) for _ in range(300)]
    assert {len(t) <= v.exact_bytes for t in texts} == {True, False}
    count = library(v)
    expected = [count(t) for t in texts]
    assert _Counter(v)(pa.array(texts)).tolist() == expected
    monkeypatch.setattr(Vocabulary, "exact_bytes", 1 << 30)  # segments put together regardless: near ties come out otherwise
    assert _Counter(v)(pa.array(texts)).tolist() != expected


def test_odd_rows(spark, vocabulary, monkeypatch):
    rows = [(1, None), (1, ""), (2, "word " * 50_000), (None, "x" * 20_000), (2, "word")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as doc", "2 as n_tokens")
    count = library(vocabulary)
    out = count_tokens(df, vocabulary)
    got = sorted(((r[0], r[1]) for r in out.select("doc.doc_id", "n_tokens").collect()), key=repr)
    assert got == sorted([(i, count(t)) for i, t in rows], key=repr)
    assert out.select("doc.*").columns == ["doc_id", "doc", "n_tokens"]
    assert count_tokens(df.where("false"), vocabulary).count() == 0


def test_memory_is_bounded(vocabulary, monkeypatch):
    import pyarrow as pa

    from cardamom.llm import token_counts

    monkeypatch.setattr(token_counts, "CACHE", 50)
    counter, count = _Counter(vocabulary), library(vocabulary)
    for k in range(5):
        texts = [f"item{k}{i} and more" for i in range(30)]
        assert counter(pa.array(texts)).tolist() == [count(t) for t in texts]
        assert len(counter.keys) <= 80


def test_query(spark):
    got = Q.op9_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and min(r.n_tokens for r in got) > 0
