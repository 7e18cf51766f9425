"""What each filter of a chain removes, in every order the chain could have.

Whether a document survives depends on the set of filters applied, not on
their order.  So a document that fails the filters in ``mask`` becomes a word
of 32 bits, one for each subset of the five filters, set where the document
survives that subset.  Counting each bit over all words (a positional popcount,
by carry-save adders on whole vectors of words) gives the survivors of every
subset; with them, every figure of every order is a difference.

Words are counted in the tasks, by part and label, and only the 32 sums travel.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.llm import words as W
from cardamom.llm.common import column, written

LETTERS = "ABCDE"
SUBSETS = 1 << len(LETTERS)
ORDERS = ["".join(x) for x in permutations(LETTERS)]
COPY = 1 << LETTERS.index("E")
PIECE = 1 << 20  # bytes of a text split into words at a time

# Bit S is set for the subsets S that a document failing ``mask`` survives.
SURVIVAL = np.array([sum(1 << s for s in range(SUBSETS) if not s & mask) for mask in range(SUBSETS)], np.uint32)

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#$%&*|")] = True


def count_words(text: bytes, piece: int = PIECE) -> tuple[int, int]:
    """Words and distinct words of a text; splitting bytes knows ASCII white space only, as it should."""
    if len(text) <= piece:
        words = text.split()
        return len(words), len(set(words))
    n, distinct, at = 0, set(), 0
    while at < len(text):
        gap = _SPACE.search(text, at + piece)
        end = gap.start() if gap else len(text)
        words = text[at:end].split()
        n += len(words)
        distinct.update(words)
        at = end
    return n, len(distinct)


def failures(texts: pa.Array) -> np.ndarray:
    """Filters A to D that each text fails, a bit each; they look at the text alone."""
    data, at = W.text_bytes(texts)
    upper, marks, chars = (np.empty(len(at) - 1, np.int64) for _ in range(3))
    words, distinct = np.empty(len(at) - 1, np.int64), np.empty(len(at) - 1, np.int64)
    for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
        text = data[a:b]
        upper[i], marks[i] = np.count_nonzero(_UPPER[text]), np.count_nonzero(_MARKS[text])
        chars[i] = np.count_nonzero((text & 0xC0) != 0x80)
        words[i], distinct[i] = count_words(text.tobytes())
    fails = words < 200, 100 * distinct < 50 * words, 100 * upper > 3 * chars, marks > 0
    return sum(x.astype(np.int8) << k for k, x in enumerate(fails))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch, "text"):
            texts = part.column("text")
            digest = [hashlib.sha256(x or b"").digest() for x in texts.cast(pa.binary()).to_pylist()]
            yield pa.record_batch(
                [part.column("id"), part.column("part"), pa.array(digest, pa.binary()), pa.array(failures(texts), pa.int8())],
                names=["id", "part", "digest", "mask"],
            )


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of their 32 bits set.

    A carry-save adder turns three vectors of words into their sum without
    carries and a vector of carries, which weigh twice as much.  It is run on
    thirds of what there is of a weight until fewer than three words are left.
    """
    total = np.zeros(32, np.int64)
    weight = 1
    while len(words):
        carries = []
        while len(words) >= 3:
            n = len(words) // 3
            a, b, c = words[:n], words[n : 2 * n], words[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate((half ^ c, words[3 * n :]))
        for word in words.tolist():
            total += weight * (word >> np.arange(32) & 1)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return total


SURVIVORS = "part string, " + ", ".join(f"{x} array<long>" for x in ("everyone", "good", "toxic"))


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Survivors of each subset by part: of all documents, of the good and of the toxic ones."""
    for batch in batches:
        if not batch.num_rows:
            continue
        words = SURVIVAL[batch.column("mask").to_numpy()]
        good, toxic = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("good", "toxic"))
        parts = batch.column("part").dictionary_encode()
        code = parts.indices.to_numpy()
        out = {"part": parts.dictionary, "everyone": [], "good": [], "toxic": []}
        for k in range(len(parts.dictionary)):
            mine = code == k
            out["everyone"].append(positional_popcount(words[mine]))
            out["good"].append(positional_popcount(words[mine & good]))
            out["toxic"].append(positional_popcount(words[mine & toxic]))
        yield pa.record_batch([out["part"], *(pa.array([x.tolist() for x in out[c]], pa.list_(pa.int64())) for c in ("everyone", "good", "toxic"))], names=list(out))


def order_figures(everyone: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, list]:
    """The rows of one part: each step of each order, from the survivors of all subsets."""
    full = SUBSETS - 1
    out = {x: [] for x in ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")}
    shares = dict.fromkeys(LETTERS, 0)
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << LETTERS.index(letter)
            after = before | own
            removed = int(everyone[before] - everyone[after])
            shares[letter] += removed
            out["filter_order"].append(order)
            out["step"].append(step)
            out["kept"].append(int(everyone[after]))
            out["removed"].append(removed)
            out["redundant"].append(int(everyone[0] - everyone[own]) - removed)
            out["unique_fails"].append(int(everyone[full ^ own] - everyone[full]))
            out["good_lost"].append(int(good[before] - good[after]))
            out["toxic_lost"].append(int(toxic[before] - toxic[after]))
            before = after
    out["shapley"] = [shares[order[step - 1]] for order, step in zip(out["filter_order"], out["step"])]
    return out


AUDIT = "part string, filter_order string, step int, " + ", ".join(
    f"{x} long" for x in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
)


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = order_figures(*(np.array(row[x], np.int64) for x in ("everyone", "good", "toxic")))
            n = len(found["step"])
            yield pa.record_batch(
                [pa.array([row["part"]] * n, pa.string()), *(pa.array(v, {"filter_order": pa.string(), "step": pa.int32()}.get(k, pa.int64())) for k, v in found.items())],
                names=["part", *found],
            )


def judge_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Which filters each document fails: (id, part, ``mask``), a row per input row.

    Bits of ``mask``, from the lowest: A fewer than 200 words; B fewer than
    half of the words distinct; C more than 3 % capital letters; D one of
    ``#$%&*|``; E the text of a document with a smaller id.

    Words are runs of anything but white space, texts are judged whole and NULL
    is empty.  Equal texts are found by SHA-256, taken as exact.  The document
    of the smallest id of a text is looked up by its id, so a text that very
    many documents share is one row in every shuffle but the count of ids.
    Rows without an id are no copies; rows that repeat an id do not make each
    other copies.
    """
    rows = docs.select(
        column(docs, id_col).cast("long").alias("id"),
        F.coalesce(column(docs, part_col).cast("string"), F.lit("")).alias("part"),
        column(docs, text_col).alias("text"),
    )
    judged = written(rows.mapInArrow(_judge, "id long, part string, digest binary, mask byte"), "judged")
    first = judged.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    found = judged.join(first, ["id", "digest"], "left")
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), F.lit(COPY)).otherwise(F.lit(0))
    return found.select("id", "part", F.col("mask").cast("int").bitwiseOR(copy).cast("byte").alias("mask"))


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Five filters in all 120 orders: a row for each part, order and step.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (failing its
    filter but removed before), ``unique_fails`` (failing its filter only),
    ``good_lost`` and ``toxic_lost`` (removed by it, labelled ``quality`` or
    ``toxic`` 1), and ``shapley``: what its filter removes, summed over all
    orders.  The filters and odd rows are those of :func:`judge_filters`.

    A part is a value of ``part_col``, NULL being the empty text; parts are
    added up a row each, so there may be many.  A document is good or toxic if
    any label of its id says so; labels without an id or of other documents
    count nowhere.  An empty table of documents gives an empty table, an empty
    table of labels zeros.
    """
    marks = (
        labels.select(column(labels, id_col).cast("long").alias("id"), column(labels, "quality").alias("q"), column(labels, "toxic").alias("t"))
        .where("id is not null")
        .groupBy("id")
        .agg(F.max(F.expr("coalesce(q = 1, false)")).alias("good"), F.max(F.expr("coalesce(t = 1, false)")).alias("toxic"))
    )
    no = F.lit(False)
    marked = judge_filters(docs, id_col, text_col, part_col).join(marks, "id", "left")
    marked = marked.select("part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    partial = marked.mapInArrow(_survivors, SURVIVORS)
    sums = partial.groupBy("part").agg(*(F.array(*(F.sum(F.col(x)[s]) for s in range(SUBSETS))).alias(x) for x in ("everyone", "good", "toxic")))
    return sums.mapInArrow(_orders, AUDIT)
