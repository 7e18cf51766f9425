"""Token counts of a unigram tokenizer, without building the tokens.

Aho-Corasick finds every vocabulary entry that ends at each character; dynamic
programming over the characters carries the best score and the number of
pieces on the best path.  Rules are those of the tokenizers library's Unigram
model: scores add up in double precision, a later candidate must be strictly
better, candidates for an end come in the order of their starts, and a
character that is no entry costs 10 more than the worst entry and, with byte
fallback, counts as its UTF-8 bytes.

No entry continues past a space, so the best path of a text is put together
from the best paths of its space-separated segments.  Where all scores are
whole numbers their sums are exact up to 2**53, so in texts too short to reach
that equal segments are counted once.  In longer texts, and with other scores,
sums are rounded, which can settle near ties; each segment then begins with the
score that its text has reached, as it does in the library.  A vocabulary with
entries across spaces is run on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cardamom.llm import words as W
from cardamom.llm.common import column

SPACE = "▁"
CACHE = 4 << 20  # distinct segments remembered by a task


@dataclass(frozen=True)
class Vocabulary:
    """Entries and scores of a unigram model; spaces are written as U+2581."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_fallback: bool = True
    prefix: bool = True  # a space is put before the text
    _automaton: list = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_automaton"} | {"_automaton": []}

    @property
    def segmented(self) -> bool:
        """Whether no entry has a space after another character, and no run of unknown characters goes on past one."""
        return (self.byte_fallback or SPACE in self.pieces) and not any(SPACE in x.lstrip(SPACE) for x in self.pieces)

    @property
    def exact_sums(self) -> bool:
        """Whether all scores are whole numbers, which add up without rounding as far as ``exact_bytes``."""
        return all(float(x).is_integer() for x in self.scores)

    @property
    def exact_bytes(self) -> int:
        """Bytes that a text can have for its scores to add up without rounding, in any order; below 1 for none.

        A path has at most a step for each byte and one for the space before the
        text; none costs more than the largest score and the 10 of an unknown character.
        """
        return int(2**53 // (max(map(abs, self.scores), default=0.0) + 10)) - 1 if self.exact_sums else 0

    @property
    def lines_apart(self) -> bool:
        """Whether a line feed is always a token of its own."""
        return self.byte_fallback and not any("\n" in x for x in self.pieces)

    def automaton(self) -> ahocorasick.Automaton:
        if not self._automaton:
            a = ahocorasick.Automaton()
            for piece, score in zip(self.pieces, self.scores):
                if piece and piece not in a:
                    a.add_word(piece, (len(piece), float(score)))
            if not len(a):
                a.add_word("\0" * 2, (2, -np.inf))  # an automaton needs an entry
            a.make_automaton()
            self._automaton.extend((a, min(self.scores, default=0.0) - 10.0))
        return self._automaton[0]

    def count(self, text: str, reached: float = 0.0) -> tuple[int, float]:
        """Pieces on the best path of a text whose spaces are already U+2581, and its score from ``reached`` on."""
        automaton = self.automaton()
        unknown = self._automaton[1]
        n = len(text)
        best: list[float | None] = [reached] + [None] * n
        count, loose = [0] * (n + 1), [False] * (n + 1)
        done, single = 0, False
        # The last entry closes the text.
        for at, (size, score) in chain(automaton.iter(text), ((n, (0, 0.0)),)):
            while done < at:
                # No entry is this one character: the last candidate for its end.
                if not single:
                    other = best[done] + unknown
                    if best[done + 1] is None or other > best[done + 1]:
                        best[done + 1], loose[done + 1] = other, True
                        count[done + 1] = count[done] + (len(text[done].encode()) if self.byte_fallback else not loose[done])
                done, single = done + 1, False
            if size:
                start = at + 1 - size
                score += best[start]
                if best[at + 1] is None or score > best[at + 1]:
                    best[at + 1], loose[at + 1], count[at + 1] = score, False, count[start] + 1
                single = single or size == 1
        return count[n], best[n]


def load_vocabulary(path: str) -> Vocabulary:
    """Entries, scores and settings of a sentencepiece model file on the driver."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    return Vocabulary(
        tuple(model.id_to_piece(i) for i in range(n)),
        tuple(model.get_score(i) for i in range(n)),
        byte_fallback=any(model.is_byte(i) for i in range(n)),
    )


_ALL = np.arange(256, dtype=np.uint8)


def _segments(data: np.ndarray, at: np.ndarray, lines_apart: bool) -> np.ndarray:
    """Where segments begin: at texts, at spaces after something else, around line feeds."""
    n = len(data)
    space = data == 32
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    if lines_apart:
        line = data == 10
        begin |= line
        begin[1:] |= line[:-1]
    begin[at[:-1][at[:-1] < n]] = True
    return np.flatnonzero(begin)


class _Counter:
    """Counts of segments, remembered by a 64-bit hash of the segment."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.exact_bytes = vocabulary.exact_bytes
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        v = self.vocabulary
        data, at = W.text_bytes(texts)
        if not len(data):
            return np.zeros(len(at) - 1, np.int64)
        starts = _segments(data, at, v.lines_apart) if v.segmented else at[:-1][at[1:] > at[:-1]]
        ends = np.append(starts[1:], len(data))
        text = np.searchsorted(at, starts, "right") - 1
        leads = starts == at[text]
        raw, n = data.tobytes(), len(at) - 1
        exact = (np.diff(at) <= self.exact_bytes)[text]
        rounded = self._one_after_the_other(raw, *(x[~exact] for x in (starts, ends, text, leads)), n)
        starts, ends, text, leads = (x[exact] for x in (starts, ends, text, leads))
        keys = W.run_hashes(data, starts, ends) ^ np.where(leads, np.uint64(0x6A09E667F3BCC909), np.uint64(0))
        distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        counts = np.empty(len(distinct), np.int64)
        counts[known] = self.counts[place[known]]
        new = np.flatnonzero(~known)
        for i in new:
            s = first[i]
            counts[i] = v.count(self._segment(raw, starts[s], ends[s], leads[s]))[0]
        if len(self.keys) + len(new) > CACHE:
            self.keys, self.counts = self.keys[:0], self.counts[:0]
            place = np.zeros(len(distinct), np.int64)
        self.keys, self.counts = np.insert(self.keys, place[new], distinct[new]), np.insert(self.counts, place[new], counts[new])
        return rounded + np.bincount(text, weights=counts[which], minlength=n).astype(np.int64)

    def _segment(self, raw: bytes, start: int, end: int, leads: bool) -> str:
        segment = raw[start:end].decode().replace(" ", SPACE)
        return SPACE + segment if leads and self.vocabulary.prefix else segment

    def _one_after_the_other(self, raw: bytes, starts, ends, text, leads, n: int) -> np.ndarray:
        """Counts with the running score of each text carried from segment to segment."""
        total, reached = np.zeros(n, np.int64), 0.0
        for s, (start, end, i) in enumerate(zip(starts, ends, text)):
            pieces, reached = self.vocabulary.count(self._segment(raw, start, end, leads[s]), 0.0 if leads[s] else reached)
            total[i] += pieces
        return total


def _count(sent, schema: StructType):
    to = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(sent.value)
        for batch in batches:
            for part in W.slices(batch, "text"):
                counts = counter(part.column("text"))
                yield pa.record_batch([part.column("doc"), part.column("text"), pa.array(counts)], schema=to)

    return run


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """A row per input row: ``doc`` (struct of its other columns), ``text`` and ``n_tokens``.

    NULL and empty texts have no tokens; repeated rows have equal counts, and an
    empty table gives an empty table.  Whole texts are counted, however long;
    nothing is shuffled, and the vocabulary is all that is broadcast.
    """
    others = [column(docs, x) for x in docs.columns if x != text_col]
    rows = docs.select(F.struct(*others).alias("doc"), column(docs, text_col).alias("text"))
    schema = rows.withColumn("n_tokens", F.lit(0).cast("long")).schema
    for x in schema.fields:
        x.nullable = True
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return rows.mapInArrow(_count(sent, schema), schema)
