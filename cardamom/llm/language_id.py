"""Language identification with bit-sliced Bloom filters of n-grams.

All languages share one table of slots, each a bit mask over the languages: an
n-gram of a language sets that language's bit in its slots.  Looking up an
n-gram is one AND of its slots, which returns all languages that have it at
once.  Over a text, each language's number of set bits is corrected for the
false positives that its filter is known to give, and the largest decides.
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
from cardamom.llm.common import column, hash_sample, held_out, written

GRAM = 4  # bytes; a letter outside ASCII has two or more
UNKNOWN = "und"

# Bytes that n-grams are made of: small ASCII letters, bytes of other characters, spaces for all else.
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, n-gram) for every n-gram that starts with a character and has at most one space, at an end."""
    data, at = W.text_bytes(texts)
    letters = _LETTER[data]
    n = len(letters) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    gram = np.zeros(n, np.uint32)
    for i in range(GRAM):
        gram |= letters[i : i + n].astype(np.uint32) << np.uint32(8 * i)
    space = letters == 32
    inner = np.zeros(n, bool)
    for i in range(1, GRAM - 1):
        inner |= space[i : i + n]
    good = ~inner & ~(space[:n] & space[GRAM - 1 :])
    # One for each character, so that letters of two bytes do not count twice.
    good &= (letters[:n] & 0xC0) != 0x80
    for i in range(1, GRAM):  # across the end of a text
        edge = at[1:-1] - i
        good[edge[(edge >= 0) & (edge < n)]] = False
    places = np.flatnonzero(good)
    return np.searchsorted(at, places, "right") - 1, gram[places]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    slots: np.ndarray  # (slots, words of the mask): bit l % 64 of word l // 64 is language l
    hashes: int
    false_rate: np.ndarray  # by language: share of n-grams it lacks that its filter returns
    usual: str  # answer for texts without n-grams

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """Bit mask of the languages that have each n-gram."""
        out = None
        for slot in _slots_of(grams, len(self.slots), self.hashes):
            found = self.slots[slot]
            out = found if out is None else out & found
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        lettered = has_letter(texts)
        n = len(texts)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        text, grams = _grams(texts)
        masks = self.masks(grams)
        total = np.bincount(text, minlength=n).astype(float)
        share = np.empty((n, len(self.languages)))
        for i, rate in enumerate(self.false_rate):
            bits = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits = np.bincount(text, weights=bits, minlength=n)
            share[:, i] = np.maximum(0.0, (hits - total * rate) / (np.maximum(total, 1) * (1 - rate)))
        best = share.argmax(axis=1)
        sums = share.sum(axis=1)
        score = np.where(sums > 0, share[np.arange(n), best] / np.where(sums > 0, sums, 1), 1 / len(self.languages))
        names = [self.languages[b] if s > 0 else self.usual for b, s in zip(best, sums)]
        return [x if ok else UNKNOWN for x, ok in zip(names, lettered)], np.where(lettered, score, 0.0)


def _slots_of(grams: np.ndarray, n_slots: int, hashes: int) -> Iterator[np.ndarray]:
    mixed = W.mix(grams.astype(np.uint64))
    a, b = mixed & np.uint64(0xFFFFFFFF), mixed >> np.uint64(32) | np.uint64(1)
    for i in range(hashes):
        yield ((a + np.uint64(i) * b) & np.uint64(n_slots - 1)).astype(np.int64)


def build_filters(grams: dict[str, np.ndarray], usual: str, slots_per_gram: int = 8, hashes: int = 3) -> LanguageModel:
    """Filters of each language's n-grams, sized by the language with the most."""
    languages = tuple(sorted(grams))
    most = max((len(x) for x in grams.values()), default=1)
    n_slots = 1 << max(10, int(slots_per_gram * most).bit_length())
    slots = np.zeros((n_slots, -(-max(1, len(languages)) // 64)), np.uint64)
    filled = np.zeros(len(languages))
    for i, name in enumerate(languages):
        own = np.zeros(n_slots, bool)
        for slot in _slots_of(grams[name], n_slots, hashes):
            own[slot] = True
        slots[own, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        filled[i] = own.mean()
    return LanguageModel(languages, slots, hashes, filled**hashes, usual)


def has_letter(texts: pa.Array) -> np.ndarray:
    data, at = W.text_bytes(texts)
    low = data | 32
    ascii_letters = np.concatenate(([0], np.cumsum((low >= 97) & (low <= 122) & (data < 128))))
    out = ascii_letters[at[1:]] > ascii_letters[at[:-1]]
    for i in np.flatnonzero(~out & (at[1:] > at[:-1])):
        out[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each n-gram occurs in each language, once for each slice of a batch."""
    for batch in batches:
        for part in W.slices(batch, "text"):
            names = part.column("lang").to_pylist()
            known = sorted(set(names))
            code = np.array([known.index(x) for x in names], np.uint64)
            text, grams = _grams(part.column("text"))
            keys, n = np.unique(code[text] << np.uint64(32) | grams, return_counts=True)
            lang = pa.array(known, pa.string()).take(pa.array((keys >> np.uint64(32)).astype(np.int64)))
            yield pa.record_batch([lang, pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])


def fit_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    fit_rows: int = 5_000,
    share: float = 0.5,
) -> LanguageModel:
    """Learn filters from rows that are not held out and have a language.

    About ``fit_rows`` rows of each language are used, chosen by a hash of the
    id.  A language has an n-gram if it occurs three times or more, and at
    least ``share`` times as often as in the language where it is commonest.
    All such n-grams are kept; their number is bounded by ``fit_rows``.
    """
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("text"), column(docs, lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    sample = hash_sample(rows, "id", "lang", fit_rows).select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).toLocalIterator()}
    spread = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").first()
    if spread is None:
        return build_filters({}, UNKNOWN)
    rate = F.lit(0.0)
    for name, n in totals.items():
        rate = F.when(F.col("lang") == name, F.col("n") / F.lit(float(n))).otherwise(rate)
    rated = counts.withColumn("rate", rate)
    most = rated.groupBy("gram").agg(F.max("rate").alias("most"))
    own = rated.join(most, "gram").where((F.col("n") >= 3) & (F.col("rate") >= share * F.col("most")))
    kept = {
        name: np.sort(own.where(F.col("lang") == name).select("gram").toArrow().column("gram").to_numpy()).astype(np.uint32)
        for name in totals
    }
    return build_filters({k: v for k, v in kept.items() if len(v)}, spread["lang"])


def _predict(sent, schema: StructType):
    to = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                names, score = sent.value.predict(part.column("text"))
                yield pa.record_batch([part.column("doc"), part.column("text"), pa.array(names, pa.string()), pa.array(score)], schema=to)

    return run


def identify_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """A row per input row: ``doc`` (struct of its other columns), ``text``, ``lang_pred``, ``score``.

    The score is the language's share of all languages' corrected counts.  A
    NULL text, or one without a letter, is "und" with score 0; a text with
    letters but no known n-gram gets the commonest language.  Equal counts go
    to the smaller name; repeated rows are answered alike.  Whole texts are
    read, however long.  An empty table gives an empty table, and a model that
    learned no language answers "und" with score 0.
    """
    others = [column(docs, x) for x in docs.columns if x != text_col]
    rows = docs.select(F.struct(*others).alias("doc"), column(docs, text_col).alias("text"))
    schema = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    for x in schema.fields:
        x.nullable = True
    # The filters are bounded by the number of n-grams kept, not by the corpus.
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict(sent, schema), schema)
