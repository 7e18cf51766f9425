"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

The lexicon is learned: whole words and stems (beginnings of words) that are
far commoner in documents labelled toxic than in others, each weighted by its
log-odds.  Occurrences are counted by distinct neighbours, so that copies of a
document count once.  Phrases around a lexicon word that labelled clean
documents use and toxic ones do not are exceptions: matches inside them do not
count.  The sum of the weights matched, for each hundred words, goes through a
logistic curve, together with the sum itself, fitted on the same rows.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cardamom.llm import words as W
from cardamom.llm.common import column, hash_sample, held_out, written
from cardamom.llm.folding import fold

SHORTEST, LONGEST = 3, 12  # letters of a stem


@dataclass(frozen=True)
class ToxicityModel:
    """``lexicon`` maps patterns to weights: " word " for a word, " stem" for a beginning."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-4.0, 1.0, 0.0)
    _automaton: list = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_automaton"} | {"_automaton": []}

    def automaton(self) -> ahocorasick.Automaton:
        if not self._automaton:
            a = ahocorasick.Automaton()
            for phrase in self.exceptions:
                folded = fold(phrase)
                if folded != " ":
                    a.add_word(folded, (len(folded), None))
            for pattern, weight in self.lexicon.items():
                a.add_word(pattern, (len(pattern), weight))
            a.make_automaton()
            self._automaton.append(a)
        return self._automaton[0]

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, length, weight) by word start, heaviest pattern each, without those in exceptions."""
        a = self.automaton()
        if not len(a):
            return []
        found, free = {}, []
        for at, (n, weight) in a.iter(folded):
            start = at - n + 1
            if weight is None:
                free.append((start, at))
            elif start not in found or weight > found[start][1]:
                found[start] = (n, weight)
        # Where exceptions begin, and the furthest end of any that begin up to there.
        free.sort()
        begins, ends = [x for x, _ in free], list(accumulate((y for _, y in free), max))
        kept = []
        for start, (n, weight) in sorted(found.items()):
            before = bisect_right(begins, start)
            if not before or ends[before - 1] <= start:
                kept.append((start, n, weight))
        return kept

    def probability(self, weight: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        z = _features(weight, n_words) @ np.array(self.curve)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with a hash of their neighbours, once for each slice of a batch and label."""
    for batch in batches:
        for part in W.slices(batch, "text", 1 << 20):
            seen: dict[tuple[int, str], set[int]] = {}
            for toxic, text in zip(part.column("toxic").to_pylist(), part.column("text")):
                words = fold(text.as_py()).split()
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    if len(word) >= SHORTEST:
                        seen.setdefault((toxic, word), set()).add(hash_pair(before, after))
            rows = [(toxic, word, x) for (toxic, word), s in seen.items() for x in s]
            toxic, word, context = zip(*rows) if rows else ((), (), ())
            yield pa.record_batch([pa.array(toxic, pa.int32()), pa.array(word, pa.string()), pa.array(context, pa.int64())], names=["toxic", "word", "context"])


def hash_pair(a: str, b: str) -> int:
    """The same in every Python process, unlike ``hash``."""
    from zlib import crc32

    return crc32(a.encode()) << 31 | crc32(b.encode())


def _least(n_toxic: int, n_clean: int, evidence: float) -> int:
    """Toxic contexts without which no form can be worth ``evidence``, not even one that no clean row has."""
    if not n_toxic or not n_clean:
        return 1
    return max(1, math.ceil(evidence / (2 * math.log((n_toxic + n_clean) / n_toxic)) - 1e-9))


def _select(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, odds: float, evidence: float) -> dict[str, float]:
    """Forms to keep, with weights.

    Forms are a tree: a stem's children are the stems and the word that are one
    letter or the word's end longer.  A form is worth its log-likelihood ratio
    less ``evidence``, the price of an entry; a stem stands for all below it
    where it is worth more than the best choice among them.
    """
    rate = n_toxic / max(1, n_toxic + n_clean)
    best: dict[str, tuple[float, dict[str, float]]] = {}
    below: dict[str, tuple[float, dict[str, float]]] = {}
    for form in sorted(toxic, key=lambda x: (-len(x), x)):
        n1, n0 = toxic[form], clean.get(form, 0)
        weight = math.log((n1 + 0.5) / (n_toxic + 1)) - math.log((n0 + 0.5) / (n_clean + 1))
        share = n1 / (n1 + n0)
        worth = 2 * (n1 * math.log(share / rate) + (n0 * math.log((1 - share) / (1 - rate)) if n0 else 0)) - evidence
        choice = below.pop(form, (0.0, {}))
        if weight >= math.log(odds) and worth > choice[0] + 1e-9:
            choice = (worth, {form: weight})
        parent = form[: min(len(form) - 1, 1 + LONGEST)]
        if choice[1]:
            if len(parent) > SHORTEST:
                value, forms = below.get(parent, (0.0, {}))
                below[parent] = (value + choice[0], forms | choice[1])
            else:
                best[form] = choice
    return {form: weight for _, forms in best.values() for form, weight in forms.items()}


def _totals(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 20):
                weight, n_words, around = [], [], []
                for text in part.column("text"):
                    folded = fold(text.as_py())
                    found = model.matches(folded)
                    weight.append(sum(w for _, _, w in found))
                    n_words.append(folded.count(" ") - 1 if len(folded) > 1 else 0)
                    around.append(sorted({p for s, n, _ in found for p in _phrases(folded, s)}))
                yield pa.record_batch(
                    [part.column("toxic"), pa.array(weight, pa.float64()), pa.array(n_words, pa.int64()), pa.array(around, pa.list_(pa.string()))],
                    names=["toxic", "weight", "n_words", "phrases"],
                )

    return run


def _phrases(folded: str, start: int) -> Iterator[str]:
    """The word that starts there, with the word before and with the word after."""
    end = folded.index(" ", start + 1)
    if start:
        yield folded[folded.rindex(" ", 0, start) + 1 : end]
    if end + 1 < len(folded):
        yield folded[start + 1 : folded.index(" ", end + 1)]


def _features(weight: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """One, the weight for each hundred words (short texts count as a little longer), and the weight damped."""
    return np.stack([np.ones_like(weight), 100 * weight / (n_words + 20), np.log1p(weight)], axis=1)


def _logistic(a: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients by Newton's method; the ridge keeps separable data finite."""
    b = np.zeros(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(b)), a.T @ (y - p) - ridge * b)
        b = b + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return b


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fit_rows: int = 20_000,
    odds: float = 5.0,
    evidence: float = 30.0,
    exceptions: tuple[str, ...] = (),
) -> ToxicityModel:
    """Learn lexicon, exceptions and curve from labelled rows that are not held out.

    About ``fit_rows`` rows of each label are used, chosen by a hash of the
    id; ``odds`` and ``evidence`` (a log-likelihood ratio) are what a form
    needs to enter the lexicon.  All words of these rows are looked at; what
    comes to the driver are the forms that have enough toxic contexts and the
    exceptions found, which ``fit_rows`` bounds.  Rows without id or label
    teach nothing; NULL and empty texts have no words.  Without toxic rows,
    and from empty tables, the lexicon is empty and every score is the same.
    """
    spark = docs.sparkSession
    marks = (
        labels.select(column(labels, id_col).alias("id"), column(labels, label_col).cast("int").alias("toxic"))
        .where("id is not null and toxic in (0, 1)")
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    picked = hash_sample(marks, "id", "toxic", fit_rows)
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("text"))
    # About 2 * fit_rows ids and marks are broadcast, however many rows there are.
    sample = written(rows.join(F.broadcast(picked), "id").select("toxic", "text"), "labelled")

    # Words count by their distinct neighbours, in toxic and in clean rows alike.
    contexts = sample.mapInArrow(_contexts, "toxic int, word string, context long").distinct()
    by_word = contexts.groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"))
    by_word = written(by_word, "by_word")
    n_toxic, n_clean = by_word.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in ("toxic", "clean"))).first()
    # Patterns that a word may be matched by: itself, and its beginnings.
    stems = F.transform(F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST))), lambda n: F.concat(F.lit(" "), F.substring("word", F.lit(1), n)))
    patterns = F.concat(F.array(F.concat(F.lit(" "), "word", F.lit(" "))), stems)
    forms = by_word.select(F.explode(patterns).alias("form"), "toxic", "clean").groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    enough = forms.where(F.col("toxic") >= _least(n_toxic, n_clean, evidence))
    counts = {r["form"]: (r["toxic"], r["clean"]) for r in enough.toLocalIterator()}
    toxic, clean = ({x: n[k] for x, n in counts.items()} for k in (0, 1))
    model = ToxicityModel(_select(toxic, clean, n_toxic, n_clean, odds, evidence), exceptions)

    totals = sample.mapInArrow(_totals(model), "toxic int, weight double, n_words long, phrases array<string>")
    around = (
        totals.select("toxic", F.explode("phrases").alias("phrase"))
        .groupBy("phrase")
        .agg(F.sum(F.lit(1) - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic"))
        .where("clean >= 3 and clean >= 10 * toxic")
    )
    learned = tuple(sorted(r["phrase"] for r in around.toLocalIterator()))
    if learned:
        model = ToxicityModel(model.lexicon, (*exceptions, *learned))
        totals = sample.mapInArrow(_totals(model), "toxic int, weight double, n_words long, phrases array<string>")
    points = totals.select("toxic", "weight", "n_words").toArrow()
    y, weight, n_words = (points.column(x).to_numpy().astype(float) for x in ("toxic", "weight", "n_words"))
    if not len(y) or y.min() == y.max():
        return model
    curve = _logistic(_features(weight, n_words), y)
    return ToxicityModel(model.lexicon, model.exceptions, tuple(float(x) for x in curve))


def _score(model: ToxicityModel, schema: StructType, threshold: float):
    to = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                weight, n_words, terms = [], [], []
                for text in part.column("text"):
                    folded = fold(text.as_py())
                    found = model.matches(folded)
                    weight.append(sum(w for _, _, w in found))
                    n_words.append(folded.count(" ") - 1 if len(folded) > 1 else 0)
                    terms.append(sorted({folded[s : s + n].strip() for s, n, _ in found}))
                score = model.probability(np.array(weight, float), np.array(n_words, float))
                yield pa.record_batch(
                    [part.column("doc"), part.column("text"), pa.array(terms, pa.list_(pa.string())), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    schema=to,
                )

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """A row per input row: ``doc`` (struct of its other columns), ``text``, ``terms``
    (folded lexicon entries that matched), ``score`` (0 to 1) and ``predicted``.

    NULL, empty and wordless texts match nothing and get the lowest score.
    Equal texts get equal scores.  Whole texts are matched, however long.  An
    empty table gives an empty table.
    """
    others = [column(docs, x) for x in docs.columns if x != text_col]
    rows = docs.select(F.struct(*others).alias("doc"), column(docs, text_col).alias("text"))
    schema = rows.withColumns({"terms": F.expr("cast(null as array<string>)"), "score": F.lit(0.0), "predicted": F.lit(0)}).schema
    for x in schema.fields:
        x.nullable = True
    return rows.mapInArrow(_score(model, schema, threshold), schema)
