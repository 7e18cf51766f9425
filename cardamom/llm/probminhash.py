"""ProbMinHash signatures of weighted shingles.

Every distinct shingle of a document is a Poisson process whose rate is its
weight; each arrival falls on a random register, and a register keeps the
shingle of its earliest arrival.  Two documents agree in a register with
probability equal to the probability Jaccard similarity of their weights.

All shingles of a batch of documents advance together, one arrival a round.  A
shingle is finished as soon as its last arrival is later than the latest
register of its document: none of its further arrivals could win.
"""

from __future__ import annotations

import numpy as np

from cardamom.llm import words as W

EMPTY = np.uint64(0)


def sequence_hash(words: W.Words, which: int) -> np.ndarray:
    """A hash of each text's whole word sequence: words scrambled with their places, added up."""
    seed = np.uint64((0x5851F42D4C957F2D, 0x14057B7EF767814F)[which])
    place = np.arange(len(words.hash)) - words.first[:-1][W.text_of_word(words)]
    values = W.mix(W.mix(words.hash ^ seed) + W.mix(place.astype(np.uint64) + seed))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return W.mix(sums[words.first[1:]] - sums[words.first[:-1]] + words.counts.astype(np.uint64))


def shingle_sets(words: W.Words, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (text, shingle, times), in no particular order.

    A text of fewer words than ``width``, but not none, is one shingle.
    """
    owner = W.text_of_word(words)
    at = np.flatnonzero(W.whole_windows(words, width))
    text, shingle = owner[at], W.window_hashes(words, width)[at]
    few = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(few):
        text = np.concatenate((text, few))
        shingle = np.concatenate((shingle, sequence_hash(words, 0)[few]))
    # One sort by a hash of both brings equal shingles of a text together.
    both = W.mix(shingle + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(both)
    both = both[order]
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else order
    return text[order[first]], shingle[order[first]], np.diff(np.append(first, len(both)))


def signatures(n_texts: int, text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, registers: int) -> np.ndarray:
    """Register contents, (n_texts, registers); all EMPTY for a text without shingles."""
    earliest = np.full(n_texts * registers, np.inf)
    winner = np.full(n_texts * registers, EMPTY)
    time, pace = np.zeros(len(text)), 1.0 / weight
    step = 0
    while len(text):
        step += 1
        draw = W.mix(shingle ^ W.mix(np.array([step], np.uint64)))
        time = time - np.log1p(-((draw >> np.uint64(11)).astype(np.float64) * 2.0**-53)) * pace
        cell = text * registers + (W.mix(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, cell, time)
        won = np.flatnonzero(time == earliest[cell])
        winner[cell[won]] = shingle[won]
        latest = earliest.reshape(n_texts, registers).max(axis=1)
        going = np.flatnonzero(time < latest[text])
        text, shingle, time, pace = text[going], shingle[going], time[going], pace[going]
    return winner.reshape(n_texts, registers)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band of registers, different in different bands."""
    n, registers = signature.shape
    rows = signature.reshape(n, bands, registers // bands)
    keys = np.zeros((n, bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows.shape[2]):
        keys = W.mix(keys ^ rows[:, :, i])
    return keys
