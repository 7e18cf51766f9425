import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import folded, spaced

from cardamom.llm import probminhash as P
from cardamom.llm import words as W


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    some = ["a b  C-d\né x", None, "", " \t\n", "x" * 5000, "Ünï cödé 日本 語", "\x0b\x0c\r end"]
    return some + ["".join(rng.choice("ab C\n\té.-9") for _ in range(rng.randint(0, 60))) for _ in range(200)]


@pytest.mark.parametrize("alphabet, brute", [(W.SPACED, spaced), (W.FOLDED, folded)])
def test_words_are_those_of_the_pattern(texts, alphabet, brute, monkeypatch):
    monkeypatch.setattr(W, "PIECE", 100)
    words = W.find_words(pa.array(texts), alphabet)
    expected = [brute(t) for t in texts]
    assert words.counts.tolist() == [len(x) for x in expected]
    by_word = {}
    for word, h in zip([w for x in expected for w in x], words.hash.tolist()):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_words_that_a_polynomial_cannot_tell_apart():
    """A Thue-Morse word and its complement: equal modulo 2**64 for any base."""
    ones = [bin(k).count("1") % 2 for k in range(1 << 11)]
    pair = ["".join("ab"[x ^ flip] for x in ones) for flip in (0, 1)]
    for size in (8, 63, 64, 65, 1024, 2048):
        for alphabet in (W.SPACED, W.FOLDED):
            assert len(set(W.find_words(pa.array([x[:size] for x in pair]), alphabet).hash.tolist())) == 2
    for which in (0, 1):  # as words of a text
        assert len(set(P.sequence_hash(W.find_words(pa.array([" ".join(x) for x in pair]), W.SPACED), which).tolist())) == 2


def test_window_hashes_tell_runs_apart(texts):
    words = W.find_words(pa.array(texts), W.SPACED)
    flat = [w for t in texts for w in spaced(t)]
    for which in (0, 1):
        seen = {}
        for k, h in enumerate(W.window_hashes(words, 3, which).tolist()):
            assert seen.setdefault(tuple(flat[k : k + 3]), h) == h
        assert len(set(seen.values())) == len(seen)


def test_sliding_min():
    h = np.random.default_rng(1).integers(0, 99, 60).astype(np.uint64)
    for width in (1, 2, 3, 7, 26, 60, 61):
        assert W.sliding_min(h, width).tolist() == [h[i : i + width].min() for i in range(60 - width + 1)]


def test_slices_keep_every_row():
    batch = pa.record_batch([pa.array(["a" * 50, None, "", "b" * 500, "c"])], names=["text"])
    parts = list(W.slices(batch, "text", 60))
    assert sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()
    assert all(p.num_rows for p in parts) and len(parts) > 1
    assert list(W.slices(batch.slice(0, 0), "text")) == []
    assert W.find_words(pa.array([], pa.string())).counts.tolist() == []
