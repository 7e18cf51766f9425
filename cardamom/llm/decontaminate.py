"""Find benchmark passages in documents: a prefix-filtered set join.

The windows of a benchmark item are sets of word shingles with places.  A
document holds a window only if it holds all of the window's shingles, so the
prefix that has to be joined is one shingle: the window's rarest, by counts
over all documents.  Each place where a document has such a shingle gives one
place where the window could start; length and position bounds throw out
starts outside the document, and a 128-bit hash of the window's words decides.

A benchmark of at most ``broadcast_words`` words is sent to all tasks, and
documents are never shuffled.  A larger one is joined through shuffles, and a
Bloom filter of its shingles, of a fixed size, keeps at home the shingles of
documents that it cannot have.  Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cardamom.llm import words as W
from cardamom.llm.common import column, row_places, written

SHINGLE = 3
_WIDTH_SEED = (0, 0x632BE59BD9B4E019, 0x8CB92BA72F3D8DD7, 0xDB4F0B9175AE2165)

WINDOWS = "item string, len int, h1 long, h2 long, shingles array<long>"


def _shingles(words: W.Words, width: int) -> np.ndarray:
    """A hash for the shingle that starts at each word, as far as there are words."""
    return W.window_hashes(words, width, 0) ^ np.uint64(_WIDTH_SEED[width])


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                words = W.find_words(part.column("text"), W.FOLDED)
                items = part.column("item").to_pylist()
                counts = words.counts
                out = {x: [] for x in ("item", "len", "h1", "h2", "shingles")}
                for width in {size} | set(counts[(counts > 0) & (counts < size)].tolist()):
                    mine = np.flatnonzero(counts >= size if width == size else counts == width)
                    k = min(SHINGLE, width)
                    shingles = _shingles(words, k).view(np.int64)
                    for i in mine:
                        starts = np.arange(words.first[i], words.first[i + 1] - width + 1)
                        h1, h2 = (hash_at(words, starts, width, x).view(np.int64) for x in (0, 1))
                        for at, a, b in zip(starts, h1, h2):
                            out["item"].append(items[i])
                            out["len"].append(width)
                            out["h1"].append(int(a))
                            out["h2"].append(int(b))
                            out["shingles"].append(shingles[at : at + width - k + 1])
                yield pa.record_batch(
                    [pa.array(out["item"], pa.string()), pa.array(out["len"], pa.int32()), pa.array(out["h1"], pa.int64()), pa.array(out["h2"], pa.int64()), pa.array(out["shingles"], pa.list_(pa.int64()))],
                    names=list(out),
                )

    return run


def hash_at(words: W.Words, starts: np.ndarray, width: int, which: int) -> np.ndarray:
    """``window_hashes`` at some places only."""
    values = words.hash[starts[:, None] + np.arange(width)] if len(starts) else np.zeros((0, width), np.uint64)
    if which:
        values = W.mix(values ^ np.uint64(0x5851F42D4C957F2D))
    return W.mix((values * W.powers(W._WINDOW_BASES[which], width)).sum(axis=1, dtype=np.uint64))


class Keys:
    """Sorted 64-bit keys, with a small table that turns most strangers away first."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(12, int(16 * len(keys)).bit_length()))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[keys >> self.shift] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``values`` that hold a key, and which key."""
        at = np.flatnonzero(self.seen[values >> self.shift])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        which = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        good = self.keys[which] == values[at]
        return at[good], which[good]


def _places(words: W.Words, widths: list[int], keys: Keys):
    """Word places whose shingle is one of the keys: (place, key)."""
    for width in widths:
        shingles = _shingles(words, width)
        at, which = keys.find(shingles)
        whole = W.whole_windows(words, width)[at]
        yield at[whole], which[whole]


def _count(keys_sent, widths):
    """How often each key occurs, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Keys(keys_sent.value)
        total = np.zeros(len(keys.keys), np.int64)
        for batch in batches:
            for part in W.slices(batch, "text"):
                words = W.find_words(part.column("text"), W.FOLDED)
                for _, which in _places(words, widths, keys):
                    total += np.bincount(which, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(keys.keys[at].view(np.int64)), pa.array(total[at])], names=["key", "n"])

    return run


class Table:
    """Prefix shingles of a benchmark's windows, sorted, with all that is needed to check a match."""

    def __init__(self, prefix, offset, length, h1, h2, items, item_first, names):
        order = np.argsort(prefix, kind="stable")
        self.keys = Keys(np.unique(prefix))
        self.first = np.searchsorted(prefix[order], self.keys.keys)
        self.count = np.diff(np.append(self.first, len(order)))
        self.offset, self.length, self.h1, self.h2, self.window = offset[order], length[order], h1[order], h2[order], order
        self.items, self.item_first, self.names = items, item_first, names


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs first[i] … first[i]+count[i]-1: the run of each member, and the members."""
    run = np.repeat(np.arange(len(first)), count)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + first[run]


def _verify(words: W.Words, start, entry_len, h1, h2):
    """Which candidate windows are really there, and the text of each."""
    owner = W.text_of_word(words)
    n = len(owner)
    inside = (start >= 0) & (start + entry_len <= n)
    good = np.flatnonzero(inside)
    good = good[owner[start[good]] == owner[start[good] + entry_len[good] - 1]]
    ok = np.zeros(len(good), bool)
    for width in np.unique(entry_len[good]):
        mine = np.flatnonzero(entry_len[good] == width)
        for a in range(0, len(mine), 1 << 16):
            at = mine[a : a + (1 << 16)]
            c = good[at]
            ok[at] = (hash_at(words, start[c], int(width), 0) == h1[c]) & (hash_at(words, start[c], int(width), 1) == h2[c])
    good = good[ok]
    return good, owner[start[good]]


def _hit_counts(words: W.Words, start, length) -> np.ndarray:
    edge = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    sums = np.concatenate(([0], np.cumsum(np.cumsum(edge[:-1]) > 0)))
    return sums[words.first[1:]] - sums[words.first[:-1]]


def _results(part, words: W.Words, n_hit, doc, item, names, schema: pa.Schema, carried: list[str]):
    """Rows of the result; (doc, item) are pairs, items numbered in the order of their names."""
    pairs = np.unique(doc.astype(np.int64) * max(1, len(names)) + item) if len(doc) else np.zeros(0, np.int64)
    doc, item = np.divmod(pairs, max(1, len(names)))
    n_items = np.bincount(doc, minlength=part.num_rows)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_items))), pa.int32()), pa.array(names, pa.string()).take(pa.array(item)))
    n_words = words.counts
    done = [part.column(x) for x in carried] + [
        pa.array(n_words),
        pa.array(n_hit),
        pa.array(n_items, pa.int64()),
        lists,
        pa.array((n_hit > 0) & (20 * n_hit >= n_words)),
    ]
    return [x.cast(f.type) if isinstance(x, pa.Array) and x.type != f.type else x for x, f in zip(done, schema)]


def _match(table_sent, widths, schema):
    to = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Table = table_sent.value
        for batch in batches:
            for part in W.slices(batch, "text"):
                words = W.find_words(part.column("text"), W.FOLDED)
                found = [(t.first[k], t.count[k], at) for at, k in _places(words, widths, t.keys)]
                first, count, at = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
                run_of, entry = _spread(first, count)
                start = at[run_of] - t.offset[entry]
                good, doc = _verify(words, start, t.length[entry], t.h1[entry], t.h2[entry])
                n_hit = _hit_counts(words, start[good], t.length[entry[good]])
                window = t.window[entry[good]]
                run_of, item_at = _spread(t.item_first[window], t.item_first[window + 1] - t.item_first[window])
                yield pa.record_batch(_results(part, words, n_hit, doc[run_of], t.items[item_at], t.names, to, ["doc", "text"]), schema=to)

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    broadcast_words: int = 1 << 19,
) -> DataFrame:
    """For each document, how much of it is covered by passages of benchmark items.

    Words are lower-cased runs of ASCII letters, digits and non-ASCII
    characters.  An item's windows are its runs of ``window`` words, or the
    whole item if it has fewer.  Returns a row per input row: ``doc`` (struct
    of the input's other columns), ``text``, ``n_words``, ``n_hit`` (words
    inside an occurrence), ``n_items`` and ``items`` (ids of items that occur,
    sorted as text) and ``contaminated`` (5 % of the words or more are hit).

    NULL or empty texts have no words and are clean; items without words match
    nothing; an item without an id marks words but is not listed; rows of the
    same id are one item.  Repeated documents are judged each for itself, and
    very long texts whole.  An empty table of documents gives an empty table;
    against an empty benchmark all documents are clean.
    """
    spark = docs.sparkSession
    if window < SHINGLE:
        raise ValueError(f"window must be {SHINGLE} or more")
    others = [column(docs, x) for x in docs.columns if x != text_col]
    rows = docs.select(F.struct(*others).alias("doc"), column(docs, text_col).alias("text"))
    schema = StructType(
        rows.withColumns(
            {
                "n_words": F.lit(0).cast("long"),
                "n_hit": F.lit(0).cast("long"),
                "n_items": F.lit(0).cast("long"),
                "items": F.expr("cast(null as array<string>)"),
                "contaminated": F.lit(False),
            }
        ).schema.fields
    )
    for field in schema.fields:
        field.nullable = True
    items = benchmark.select(column(benchmark, item_col).cast("string").alias("item"), column(benchmark, item_text_col).alias("text"))
    windows = items.mapInArrow(_windows(window), WINDOWS)
    # An item has at most as many words as half its bytes and one.
    size = items.agg(F.coalesce(F.sum((F.octet_length("text") + 1) / 2), F.lit(0)).alias("n")).first()["n"]
    if size <= broadcast_words:
        return _by_broadcast(spark, rows, windows, schema)
    row = F.xxhash64(F.to_json(F.struct(*others)), column(docs, text_col), *row_places(docs))
    told = docs.select(F.struct(*others).alias("doc"), column(docs, text_col).alias("text"), row.alias("row"))
    return _by_shuffle(told, windows, schema)


def _by_broadcast(spark, rows: DataFrame, windows: DataFrame, schema: StructType) -> DataFrame:
    got = windows.toArrow()
    item = np.array(got.column("item").to_pylist(), dtype=object)
    length = got.column("len").to_numpy().astype(np.int64)
    h1, h2 = (got.column(x).to_numpy().view(np.uint64) for x in ("h1", "h2"))
    lists = got.column("shingles").combine_chunks()
    shingles = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    n_shingles = np.diff(lists.offsets.to_numpy())
    widths = sorted(set(np.minimum(length, SHINGLE).tolist()))

    keys = np.unique(shingles)
    sent = spark.sparkContext.broadcast(keys)
    counted = rows.select("text").mapInArrow(_count(sent, widths), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(len(keys), np.int64)
    often[np.searchsorted(keys, counted.column("key").to_numpy().view(np.uint64))] = counted.column("n").to_numpy()

    # Each distinct window once, with its rarest shingle; one whose rarest shingle never occurs cannot occur.
    order = np.lexsort((h2, h1, length))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0) | (np.diff(length[order]) != 0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    pick = order[new]
    names = sorted({x for x in item if x is not None})
    code = {x: i for i, x in enumerate(names)}
    pairs = np.unique([g * max(1, len(names)) + code[x] for g, x in zip(group, item) if x is not None]).astype(np.int64)
    window_of, items = np.divmod(pairs, max(1, len(names)))

    rank = often[np.searchsorted(keys, shingles)]
    ends = np.cumsum(n_shingles)
    window_no = np.repeat(np.arange(len(length)), n_shingles)
    best = np.lexsort((shingles, rank, window_no))[ends - n_shingles] if len(length) else np.zeros(0, np.int64)
    prefix, offset, count = shingles[best], best - (ends - n_shingles), rank[best]
    pick = pick[count[pick] > 0] if len(pick) else pick
    table = Table(prefix[pick], offset[pick], length[pick], h1[pick], h2[pick], items, np.searchsorted(window_of, np.arange(new.sum() + 1)), names)
    table.window = group[pick][table.window]
    sent = spark.sparkContext.broadcast(table)
    return rows.mapInArrow(_match(sent, widths, schema), schema)


FILTER_BITS = 28  # log2 of the filter's size: 32 MB, whatever the benchmark's
FILTER_BLOCK = 20  # log2 of the bits that are merged at a time


def _filter_places(keys: np.ndarray) -> Iterator[np.ndarray]:
    """Two bits of the filter for each key; keys are scrambled already."""
    yield keys >> np.uint64(64 - FILTER_BITS)
    yield (keys >> np.uint64(64 - 2 * FILTER_BITS)) & np.uint64((1 << FILTER_BITS) - 1)


def _own_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of a filter that a task's windows set bits in."""
    bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for batch in batches:
        keys = batch.column("shingles").flatten().to_numpy().view(np.uint64)
        for place in _filter_places(keys):
            np.bitwise_or.at(bits, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    blocks = bits.reshape(-1, 1 << FILTER_BLOCK >> 3)
    for i in np.flatnonzero(blocks.any(axis=1)):
        yield pa.record_batch([pa.array([i], pa.int64()), pa.array([blocks[i].tobytes()], pa.binary())], names=["block", "bits"])


def _merged(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    out = np.zeros(1 << FILTER_BLOCK >> 3, np.uint8)
    for bits in table.column("bits"):
        out |= np.frombuffer(bits.as_buffer(), np.uint8)
    return pa.table([pa.array([key[0].as_py()]), pa.array([out.tobytes()], pa.binary())], names=["block", "bits"])


def key_filter(windows: DataFrame) -> np.ndarray:
    """A Bloom filter of all shingles of the benchmark's windows, built by the tasks and merged block by block."""
    blocks = windows.select("shingles").mapInArrow(_own_filter, "block long, bits binary").groupBy("block").applyInArrow(_merged, "block long, bits binary")
    bits = np.zeros((1 << FILTER_BITS - FILTER_BLOCK, 1 << FILTER_BLOCK >> 3), np.uint8)
    for row in blocks.toLocalIterator():
        bits[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.ravel()


def _known_shingles(widths, filter_sent):
    """Shingles of documents that the benchmark may have, by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_sent.value
        for batch in batches:
            for part in W.slices(batch, "text"):
                words = W.find_words(part.column("text"), W.FOLDED)
                owner = W.text_of_word(words)
                keys = part.column("row").to_numpy(zero_copy_only=False)
                for width in widths:
                    shingles = _shingles(words, width)
                    known = W.whole_windows(words, width)
                    for place in _filter_places(shingles):
                        known &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
                    at = np.flatnonzero(known)
                    yield pa.record_batch(
                        [pa.array(shingles[at].view(np.int64)), pa.array(keys[owner[at]]), pa.array(at - words.first[owner[at]], pa.int64())],
                        names=["key", "row", "at"],
                    )

    return run


def _check(schema):
    to = to_arrow_schema(schema)

    def of_row(key: tuple[pa.Scalar, ...], texts: pa.Table, found: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return to.empty_table()
        words = W.find_words(texts.column("text"), W.FOLDED)
        n = texts.num_rows
        start, length = (found.column(x).to_numpy().astype(np.int64) for x in ("start", "len"))
        h1, h2 = (found.column(x).to_numpy().view(np.uint64) for x in ("h1", "h2"))
        item = found.column("item").to_pylist()
        names = sorted({x for x in item if x is not None})
        code = {x: i for i, x in enumerate(names)}
        code = np.array([code.get(x, -1) for x in item], np.int64)
        # Rows of one group have the same id and text, so each candidate counts for each of them.
        at = (words.first[:-1, None] + start[None, :]).ravel()
        good, doc = _verify(words, at, np.tile(length, n), np.tile(h1, n), np.tile(h2, n))
        n_hit = _hit_counts(words, at[good], np.tile(length, n)[good])
        code = np.tile(code, n)[good]
        listed = code >= 0
        return pa.table(_results(texts, words, n_hit, doc[listed], code[listed], names, to, ["doc", "text"]), schema=to)

    return of_row


def _by_shuffle(rows: DataFrame, windows: DataFrame, schema: StructType) -> DataFrame:
    widths = sorted(r[0] for r in windows.select(F.least("len", F.lit(SHINGLE)).alias("w")).distinct().collect())
    sent = rows.sparkSession.sparkContext.broadcast(key_filter(windows))
    # What passes the filter follows the benchmark's hits, not the corpus.
    places = written(rows.select("text", "row").mapInArrow(_known_shingles(widths, sent), "key long, row long, at long"), "places")
    sent.destroy()
    parts = windows.select("item", "len", "h1", "h2", F.posexplode("shingles").alias("offset", "key"))
    counts = places.groupBy("key").agg(F.count("*").alias("n"))
    prefix = (
        parts.join(counts, "key")
        .groupBy("len", "h1", "h2", "item")
        .agg(F.min(F.struct("n", "key", "offset")).alias("best"), F.count("*").alias("n_found"))
        .where(F.col("n_found") >= F.col("len") - F.least(F.col("len"), F.lit(SHINGLE)) + 1)
        .select("len", "h1", "h2", "item", "best.key", "best.offset")
    )
    found = places.join(prefix, "key").select("row", (F.col("at") - F.col("offset")).alias("start"), "len", "h1", "h2", "item").where("start >= 0")
    return rows.groupBy("row").cogroup(found.groupBy("row")).applyInArrow(_check(schema), schema)
