"""Document quality from weak labels: heuristic labellers, EM, and a hashed linear scorer.

Each labeller votes good, bad or abstains.  How often every combination of
votes occurs is counted over all documents; there are at most 3**labellers
combinations (177,147 with the eleven here), so expectation-maximisation runs on that table and estimates
each labeller's accuracy and the share of good documents without a true label.
The posterior of a document's votes is its soft label, and a logistic scorer on
hashed features is trained on soft labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cardamom.llm import words as W
from cardamom.llm.common import column, hash_sample, written

BAD, GOOD, ABSTAIN = 0, 1, 2

# Per labeller its statistic and the ranges in which it votes.
# Most know one defect and say nothing without it; several defects have two
# labellers that overlap.
LABELLERS = (
    # statistic, bad below, bad from, good from, good below
    ("symbols", None, 0.06, None, None),  # share of signs other than ordinary punctuation
    ("signed", None, 0.25, None, None),  # share of words that end in such a sign
    ("bars", None, 0.15, None, None),  # "|" for each word
    ("capitals", None, 0.35, None, None),  # share of capitals among letters
    ("shouts", None, 0.25, None, None),  # "!" for each word
    ("repeats", None, 0.10, None, None),  # words equal to the word before
    ("variety", 0.15, None, None, None),  # distinct words in each hundred, for each word of the text
    ("lines", None, 0.30, None, None),  # lines that occurred before in the text
    ("sentence", 1.0, 60.0, 4.0, 40.0),  # words for each sentence end
    ("prose", None, None, 0.5, None),  # 1 if none of the defects above is there in a lesser degree
    ("length", 1.0, None, 25.0, None),  # words
)

_ORDINARY = np.zeros(256, bool)
_ORDINARY[[ord(c) for c in " \t\n\r.,;:'\"-?()"]] = True
_SIGN = np.array([b < 128 and not chr(b).isalnum() and b > 32 for b in range(256)]) & ~_ORDINARY


def _per_text(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(mask)))
    return sums[at[1:]] - sums[at[:-1]]


def _repeated(text: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """By text: how many values occurred before in it."""
    both = W.mix(values + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(both, return_index=True)
    return np.bincount(text, minlength=n) - np.bincount(text[first], minlength=n)


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """What the labellers look at, for each text; NaN where there is nothing to look at."""
    data, at = W.text_bytes(texts)
    n = len(at) - 1
    words = W.find_words(texts, W.SPACED)
    owner = W.text_of_word(words)
    count = words.counts
    size = np.diff(at)
    letters = _per_text(((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128), at)
    capitals = _per_text((data >= 65) & (data <= 90), at)
    stops = _per_text((data == 46) | (data == 33) | (data == 63), at)
    same = np.zeros(len(owner), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    # Blocks of a hundred words, so that the share does not fall with the length of a text.
    block = (np.arange(len(owner)) - words.first[owner]) // 100 + np.concatenate(([0], np.cumsum(-(-count // 100))))[owner]
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else block
    again = np.bincount(owner[starts], _repeated(block, words.hash, len(starts)), minlength=n)
    line_at = np.flatnonzero(np.concatenate(([True], data[:-1] == 10)) | np.isin(np.arange(len(data)), at[:-1])) if len(data) else np.zeros(0, np.int64)
    line_text = np.searchsorted(at, line_at, "right") - 1
    line_hash = W.run_hashes(data, line_at, np.append(line_at[1:], len(data))) if len(line_at) else np.zeros(0, np.uint64)
    lines = np.bincount(line_text, minlength=n)
    with np.errstate(divide="ignore", invalid="ignore"):
        found = {
            "symbols": _per_text(_SIGN[data], at) / np.where(size, size, np.nan),
            "capitals": capitals / np.where(letters, letters, np.nan),
            "repeats": np.bincount(owner[same], minlength=n) / np.where(count, count, np.nan),
            "bars": _per_text(data == 124, at) / np.where(count, count, np.nan),
            "shouts": _per_text(data == 33, at) / np.where(count, count, np.nan),
            "signed": np.bincount(owner[_SIGN[data[words.ends - 1]]], minlength=n) / np.where(count, count, np.nan),
            "sentence": count / np.where(stops, stops, 0.5) * np.where(count, 1, np.nan),
            "lines": _repeated(line_text, line_hash, n) / np.where(lines > 1, lines, np.nan),
            "variety": 1 - again / np.where(count, count, np.nan),
            "length": count.astype(float),
        }
        clean = [~(found[x] >= most) for x, most in (("symbols", 0.03), ("signed", 0.05), ("bars", 0.02), ("capitals", 0.2), ("shouts", 0.1), ("repeats", 0.03), ("lines", 0.1))]
        return found | {"prose": np.logical_and.reduce(clean) & (count > 0) & ~(found["variety"] < 0.25)}


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, labellers): BAD, GOOD or ABSTAIN."""
    out = []
    for name, bad_below, bad_from, good_from, good_below in LABELLERS:
        x = stats[name]
        vote = np.full(len(x), ABSTAIN)
        if good_from is not None:
            vote[(x >= good_from) & (x < (np.inf if good_below is None else good_below))] = GOOD
        if bad_below is not None:
            vote[x < bad_below] = BAD
        if bad_from is not None:
            vote[x >= bad_from] = BAD
        out.append(vote)
    return np.stack(out, axis=1)


def _pattern(vote: np.ndarray) -> np.ndarray:
    return vote @ 3 ** np.arange(vote.shape[1])


@dataclass(frozen=True)
class LabelModel:
    good: float  # share of good documents
    table: np.ndarray  # (class, labeller, vote) probabilities

    def posterior(self, vote: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes; to abstain is an outcome like the others."""
        log = np.stack([np.full(len(vote), np.log(1 - self.good)), np.full(len(vote), np.log(self.good))], axis=1)
        for j in range(vote.shape[1]):
            log += np.log(self.table[:, j, vote[:, j]]).T
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -40, 40)))

    @property
    def accuracy(self) -> np.ndarray:
        """By labeller: how often its vote, where it votes, is right."""
        p = self.table[:, :, :2] * np.array([1 - self.good, self.good])[:, None, None]
        return (p[0, :, 0] + p[1, :, 1]) / p.sum(axis=(0, 2))


def fit_labels(vote: np.ndarray, times: np.ndarray, rounds: int = 200) -> LabelModel:
    """EM over vote patterns and how often they occur; starts from labellers that are mostly right."""
    n_labellers = vote.shape[1]
    table = np.empty((2, n_labellers, 3))
    table[0], table[1] = (0.3, 0.2, 0.5), (0.05, 0.45, 0.5)
    model = LabelModel(0.8, table)
    for _ in range(rounds):
        p = model.posterior(vote) * times
        q = times - p
        new = np.empty_like(table)
        for j in range(n_labellers):
            for c, weight in enumerate((q, p)):
                # One imagined vote of each kind for a class keeps chances off zero.
                new[c, j] = np.bincount(vote[:, j], weights=weight, minlength=3) + (1.0, 0.5, 0.5) if c == 0 else np.bincount(vote[:, j], weights=weight, minlength=3) + (0.5, 1.0, 0.5)
                new[c, j] /= new[c, j].sum()
        good = float(np.clip((p.sum() + 1) / (times.sum() + 2), 1e-3, 1 - 1e-3))
        done = np.abs(new - model.table).max() < 1e-7
        model = LabelModel(good, new)
        if done:
            break
    return model


def _features(texts: pa.Array, vote: np.ndarray, stats, log_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hashed feature, value): byte trigrams by their share, and which tenth each statistic falls in."""
    data, at = W.text_bytes(texts)
    n = len(at) - 1
    m = max(0, len(data) - 2)
    gram = data[:m].astype(np.uint64) | data[1 : m + 1].astype(np.uint64) << np.uint64(8) | data[2 : m + 2].astype(np.uint64) << np.uint64(16)
    text = np.searchsorted(at, np.arange(m), "right") - 1
    whole = np.arange(m) + 2 < at[text + 1] if m else np.zeros(0, bool)
    text, gram = text[whole], gram[whole]
    shift = np.uint64(64 - log_size)
    keys = (text.astype(np.uint64) << np.uint64(log_size)) | (W.mix(gram + np.uint64(1)) >> shift)
    keys, times = np.unique(keys, return_counts=True)
    text = (keys >> np.uint64(log_size)).astype(np.int64)
    value = 10 * np.sqrt(times / np.bincount(text, weights=times, minlength=n)[text])
    bins = []
    for j, (name, *_) in enumerate(LABELLERS):
        x = np.nan_to_num(stats[name].astype(float), nan=-1.0)
        tenth = np.floor(np.log2(x + 1) * 10 if name in ("length", "sentence") else x * 20).clip(-1, 400) + 2
        bins.append(W.mix((tenth * 64 + j + (1 << 32)).astype(np.uint64)) >> shift)
    own = np.repeat(np.arange(n), len(bins))
    return (
        np.concatenate((text, own)),
        np.concatenate(((keys & np.uint64((1 << log_size) - 1)).astype(np.int64), np.stack(bins, axis=1).ravel().astype(np.int64))),
        np.concatenate((value, np.full(len(own), 1.0))),
    )


@dataclass(frozen=True)
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float
    log_size: int

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Score and posterior of each text."""
        stats = statistics(texts)
        vote = votes(stats)
        text, feature, value = _features(texts, vote, stats, self.log_size)
        z = self.bias + np.bincount(text, weights=value * self.weights[feature], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40))), self.labels.posterior(vote)


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch, "text"):
            pattern, n = np.unique(_pattern(votes(statistics(part.column("text")))), return_counts=True)
            yield pa.record_batch([pa.array(pattern, pa.int64()), pa.array(n, pa.int64())], names=["pattern", "n"])


def _train(labels: LabelModel, log_size: int, epochs: int, rate: float):
    """Logistic regression on soft labels by AdaGrad, on one shard of the sample."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        texts = table.column("text").combine_chunks()
        stats = statistics(texts)
        vote = votes(stats)
        target = labels.posterior(vote)
        text, feature, value = _features(texts, vote, stats, log_size)
        order = np.argsort(text, kind="stable")
        text, feature, value = text[order], feature[order], value[order]
        first = np.searchsorted(text, np.arange(len(target) + 1))
        weights, seen = np.zeros(1 << log_size), np.full(1 << log_size, 1.0)
        bias, bias_seen = 0.0, 1.0
        rng = np.random.default_rng(1)
        for _ in range(epochs):
            for i in rng.permutation(len(target)):
                f, x = feature[first[i] : first[i + 1]], value[first[i] : first[i + 1]]
                p = 1 / (1 + np.exp(-np.clip(bias + x @ weights[f], -40, 40)))
                error = p - target[i]
                g = error * x + 1e-5 * weights[f]
                seen[f] += g * g
                weights[f] -= rate * g / np.sqrt(seen[f])
                bias_seen += error * error
                bias -= rate * error / bias_seen**0.5
        return pa.table([pa.array([len(target)], pa.int64()), pa.array([bias]), pa.array([weights.tobytes()], pa.binary())], names=["n", "bias", "weights"])

    return run


def fit_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = 16_384,
    shard_rows: int = 2_048,
    log_size: int = 16,
    epochs: int = 4,
    rate: float = 0.2,
) -> QualityModel:
    """Fit the label model on all documents' votes, and the scorer on about ``fit_rows`` of them.

    The scorer's rows are chosen by a hash of the id and dealt into shards of
    about ``shard_rows``; each shard trains a scorer, and the scorers are
    averaged by their numbers of rows.  No true label is used.  Very long texts
    vote and teach whole; NULL texts vote but teach nothing; repeated rows count
    each.  With no documents every score is one half.
    """
    spark = docs.sparkSession
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("text"))
    counted = rows.select("text").mapInArrow(_vote_rows, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toArrow()
    pattern, times = counted.column("pattern").to_numpy(), counted.column("n").to_numpy().astype(float)
    vote = pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    labels = fit_labels(vote, times)
    sample = hash_sample(rows.where(F.col("text").isNotNull()).withColumn("all", F.lit(1)), "id", "all", fit_rows)
    shards = max(1, fit_rows // shard_rows)
    sample = written(sample.select(F.pmod(F.xxhash64(F.lit("shard"), "id"), F.lit(shards)).alias("shard"), "id", "text"), "quality-sample")
    fitted = sample.groupBy("shard").applyInArrow(_train(labels, log_size, epochs, rate), "n long, bias double, weights binary").collect()
    total = sum(r["n"] for r in fitted)
    if not total:
        return QualityModel(labels, np.zeros(1 << log_size), 0.0, log_size)
    weights = sum(np.frombuffer(r["weights"]) * (r["n"] / total) for r in fitted)
    return QualityModel(labels, weights, sum(r["bias"] * r["n"] / total for r in fitted), log_size)


def _score(sent, schema: StructType, threshold: float):
    to = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", 2 << 20):
                score, posterior = sent.value.score(part.column("text"))
                yield pa.record_batch(
                    [part.column("doc"), part.column("text"), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(posterior)], schema=to
                )

    return run


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """A row per input row: ``doc`` (struct of its other columns), ``text``, ``score``
    (0 to 1, higher is better), ``predicted`` and ``posterior`` (of its votes).

    On NULL and empty texts all labellers but the one for length abstain, and
    that one votes bad.  Equal texts get equal scores, and very long ones are
    looked at whole.  An empty table gives an empty table.
    """
    others = [column(docs, x) for x in docs.columns if x != text_col]
    rows = docs.select(F.struct(*others).alias("doc"), column(docs, text_col).alias("text"))
    schema = rows.withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "posterior": F.lit(0.0)}).schema
    for x in schema.fields:
        x.nullable = True
    # 2**log_size weights, whatever the size of the corpus.
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_score(sent, schema, threshold), schema)
