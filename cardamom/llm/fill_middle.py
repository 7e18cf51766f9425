"""Fill-in-the-middle: texts cut in three at random characters and put together anew.

Cuts are numbers of characters, texts are UTF-8 bytes, so each cut has to be
turned from a rank among the characters into an offset among the bytes.  A
learned index does that without decoding: for all character boundaries of many
texts laid end to end, straight lines predict the offset from the rank.  Each
line is kept as long as some slope stays within ``ERROR`` bytes of all its
boundaries; what a line is off by at each boundary is stored in one byte.  A
cut is looked up as line + residual, which is exact.  Text is gone through a
block at a time, so besides the text itself one byte for each character is
held, however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cardamom.llm import words as W
from cardamom.llm.common import column

ERROR = 100  # bytes that a line may be off by; with rounding the residual fits in one signed byte
BLOCK = 1 << 20  # bytes whose boundaries are fitted at a time
SENTINELS = ("<P>", "<S>", "<M>")


def fit_lines(offsets: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray]:
    """First ranks and slopes of lines that stay within ``error`` of increasing offsets.

    From its first boundary on, a line keeps the cone of slopes that pass all
    boundaries so far closely enough; the boundary that would close the cone
    begins the next line.
    """
    firsts, slopes = [], []
    at, n = 0, len(offsets)
    while at < n:
        low, high = -np.inf, np.inf
        end, span = at + 1, 1 << 8
        while end < n:
            stop = min(n, end + span)
            run = np.arange(end - at, stop - at, dtype=np.float64)
            rise = (offsets[end:stop] - offsets[at]).astype(np.float64)
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            shut = np.flatnonzero(lows > highs)
            keep = int(shut[0]) if len(shut) else stop - end
            if keep:
                low, high = lows[keep - 1], highs[keep - 1]
            end += keep
            if len(shut):
                break
            span *= 2
        firsts.append(at)
        slopes.append((low + high) / 2 if end > at + 1 else 0.0)
        at = end
    return np.array(firsts, np.int64), np.array(slopes, np.float64)


@dataclass
class RankIndex:
    """Byte offset of every character boundary: lines by first rank, and residuals by rank."""

    first: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, at: np.ndarray, block: int = BLOCK, error: int = ERROR) -> tuple[RankIndex, np.ndarray]:
        """The index of UTF-8 bytes, and the ranks of the offsets ``at``, which must be boundaries."""
        firsts, offsets, slopes, residuals = [], [], [], []
        ranks = np.empty(len(at), np.int64)
        done = 0
        for begin in range(0, len(data) + 1, block):
            end = min(len(data), begin + block)
            here = np.flatnonzero((data[begin:end] & 0xC0) != 0x80) + begin
            if begin + block > len(data):
                here = np.append(here, len(data))  # the end closes the last character
            mine = slice(*np.searchsorted(at, (begin, begin + block)))
            ranks[mine] = done + np.searchsorted(here, at[mine])
            first, slope = fit_lines(here, error)
            line = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(here))))
            ahead = np.rint(slope[line] * (np.arange(len(here)) - first[line])).astype(np.int64)
            residuals.append((here - here[first[line]] - ahead).astype(np.int8))
            firsts.append(first + done)
            offsets.append(here[first])
            slopes.append(slope)
            done += len(here)
        return cls(*(np.concatenate(x) for x in (firsts, offsets, slopes, residuals))), ranks

    def lookup(self, rank: np.ndarray) -> np.ndarray:
        """Exact byte offsets of character boundaries."""
        line = np.searchsorted(self.first, rank, "right") - 1
        ahead = np.rint(self.slope[line] * (rank - self.first[line])).astype(np.int64)
        return self.offset[line] + ahead + self.residual[rank]


def _check(sentinels: Sequence[str]) -> tuple[str, str, str]:
    """Sentinels that can be told from a text holding none of them, wherever it is cut."""
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for x in sentinels:
        for y in sentinels:
            if (x != y and x in y) or any(y.startswith(x[k:]) for k in range(1, len(x))):
                raise ValueError("sentinels must not overlap")
    return tuple(sentinels)


def _rearrange(schema: StructType, sentinels: tuple[str, str, str], plain_share: int, spm_share: int):
    to = to_arrow_schema(schema)
    p, s, m = (x.encode() for x in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                data, at = W.text_bytes(part.column("text"))
                index, ranks = RankIndex.of(data, at)
                n = np.diff(ranks)
                draws = [part.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4)]
                one, two = draws[0] % (n + 1), draws[1] % (n + 1)
                cuts = np.minimum(one, two), np.maximum(one, two)
                first, second = (index.lookup(ranks[:-1] + x) for x in cuts)
                spm = draws[3] % 100 < spm_share
                plain = (n == 0) | (draws[2] % 100 >= 100 - plain_share)
                outputs, forms = [], []
                for i in range(part.num_rows):
                    text = data[at[i] : at[i + 1]].tobytes()
                    if plain[i] or p in text or s in text or m in text:
                        plain[i] = True
                        outputs.append(text)
                        forms.append("plain")
                        continue
                    a, b = first[i] - at[i], second[i] - at[i]
                    prefix, middle, suffix = text[:a], text[a:b], text[b:]
                    outputs.append(b"".join((s, suffix, p, prefix, m, middle) if spm[i] else (p, prefix, s, suffix, m, middle)))
                    forms.append("spm" if spm[i] else "psm")
                yield pa.record_batch(
                    [
                        part.column("doc"),
                        pa.array(n),
                        pa.array(forms, pa.string()),
                        pa.array(cuts[0], mask=plain),
                        pa.array(cuts[1] - cuts[0], mask=plain),
                        pa.array(outputs, pa.binary()).cast(pa.string()),
                    ],
                    schema=to,
                )

    return run


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1",
    plain_share: int = 10,
    spm_share: int = 20,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """Each text as prefix, suffix and middle, told apart by sentinels.

    A row per input row: ``doc`` (a struct of the input's other columns,
    whatever their names), ``n`` (characters of the text), ``form``,
    ``prefix_chars``, ``middle_chars`` and ``output``.  Draws come from the
    SHA-256 of the seed, a colon and the id, so a run that is repeated gives
    the same rows.  ``plain_share`` of a hundred texts stay as they are,
    ``spm_share`` of a hundred others have the suffix first.

    Characters are code points.  A NULL or empty text is plain and gives an
    empty output; so is a text that holds a sentinel, which stays as it is.  A
    missing id counts as an empty one; rows that repeat an id draw the same
    numbers, and equal rows give equal rows.  Very long texts are cut whole,
    anywhere.  An empty table gives an empty table.  Nothing is shuffled.
    """
    marks = _check(sentinels)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(column(docs, id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    others = [column(docs, x) for x in docs.columns if x != text_col]
    rows = docs.select(F.struct(*others).alias("doc"), column(docs, text_col).alias("text"), *draws)
    long = F.lit(0).cast("long")
    schema = rows.select("doc", long.alias("n"), F.lit("").alias("form"), long.alias("prefix_chars"), long.alias("middle_chars"), F.lit("").alias("output")).schema
    for x in schema.fields:
        x.nullable = True
    return rows.mapInArrow(_rearrange(schema, marks, plain_share, spm_share), schema)


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text that an output was made from."""
    p, s, m = _check(sentinels)
    head, middle = F.substring_index(output, m, 1), F.substring_index(output, m, -1)
    after_p = F.substring_index(head, p, -1)  # psm: prefix, S, suffix; spm: prefix
    psm = F.concat(F.substring_index(after_p, s, 1), middle, F.substring_index(after_p, s, -1))
    spm = F.concat(after_p, middle, F.substring_index(F.substring_index(head, p, 1), s, -1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
