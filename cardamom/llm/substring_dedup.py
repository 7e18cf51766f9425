"""Remove passages that also start in a document with a smaller id.

A count-min sketch finds the windows that may repeat, and only those are
grouped exactly:

1. Documents are dealt into chunks of bounded size by a hash.  Each chunk
   counts its windows in a sketch of its own.  A window is counted under its
   anchor, the smallest hash of the shorter word runs inside it; equal windows
   have equal anchors, so the count of the anchor is never below the count of
   the window, and one anchor stands for many overlapping windows.
2. The chunks' sketches are merged by adding them up, block of cells by block
   of cells.  Each chunk gets back one bit for each of its own cells: whether
   the merged count is two or more.  The sketch is never in one place, so its
   width can follow the input and its false alarms stay the same at any size.
3. In a second pass each chunk sends the windows whose estimate (the least
   over the rows of the sketch) is two or more, once for each chunk, to an
   exact grouping by 128-bit hash, and gets back one bit each: whether a
   smaller document elsewhere has that window.

No window that repeats is lost, because estimates never fall short; false
alarms cost a little work in step 3 and change nothing.  All of it is one lazy
plan without broadcasts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.llm import words as W
from cardamom.llm.common import column, row_places, text_size

ROW_SEEDS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
NO_ID = np.iinfo(np.int64).max  # a missing id counts as larger than all others


@dataclass(frozen=True)
class Sizes:
    window: int
    gram: int  # words in the runs that anchors are chosen from
    chunks: int
    shards: int
    depth: int
    log_cells: int
    log_block: int

    @classmethod
    def of(cls, n_bytes: int, window: int, depth: int, chunk_bytes: int, parallel: int) -> Sizes:
        """Sizes that follow the input: eight cells for each anchor expected."""
        gram = max(1, window // 2)
        chunks = max(1, -(-n_bytes // chunk_bytes), min(parallel, n_bytes // (chunk_bytes // 16)))
        anchors = max(1, n_bytes // 3 // (window - gram + 2))
        log_cells = max(16, int(8 * anchors - 1).bit_length())
        return cls(window, gram, chunks, chunks, depth, log_cells, min(log_cells, 22))


@dataclass
class Chunk:
    """The words of a chunk and, for each word, the window that starts there."""

    ids: np.ndarray
    words: W.Words
    owner: np.ndarray
    at: np.ndarray  # first words of the windows
    anchor: np.ndarray


def _chunk(table: pa.Table, s: Sizes) -> Chunk:
    ids = table.column("id").fill_null(NO_ID).to_numpy()
    words = W.find_words(table.column("text"), W.SPACED)
    owner = W.text_of_word(words)
    at = np.flatnonzero(W.whole_windows(words, s.window))
    anchor = W.sliding_min(W.window_hashes(words, s.gram), s.window - s.gram + 1)[at]
    return Chunk(ids, words, owner, at, anchor)


def _cells(anchor: np.ndarray, row: int, s: Sizes) -> np.ndarray:
    return W.mix(anchor ^ np.uint64(ROW_SEEDS[row])) >> np.uint64(64 - s.log_cells)


def _anchors_by_document(c: Chunk) -> np.ndarray:
    """Each anchor once for each document that has it."""
    doc = c.owner[c.at]
    new = np.ones(len(doc), bool)
    new[1:] = (c.anchor[1:] != c.anchor[:-1]) | (doc[1:] != doc[:-1])
    doc, anchor = doc[new], c.anchor[new]
    order = np.lexsort((anchor, doc))
    doc, anchor = doc[order], anchor[order]
    new = np.ones(len(doc), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    return anchor[new]


def _own_cells(c: Chunk, s: Sizes):
    """For each row of the sketch: this chunk's cells, sorted, with counts."""
    anchors = _anchors_by_document(c)
    for row in range(s.depth):
        yield row, *np.unique(_cells(anchors, row, s), return_counts=True)


def _blocks(row: int, cells: np.ndarray, s: Sizes):
    """Block numbers and where each block's cells begin and end."""
    block = cells >> np.uint64(s.log_block)
    edges = np.flatnonzero(np.diff(block)) + 1 if len(cells) else []
    bounds = np.concatenate(([0], edges, [len(cells)])).astype(np.int64)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            yield row << (s.log_cells - s.log_block) | int(block[a]), a, b


SKETCH = "chunk long, block long, cells binary, counts binary"


def _sketch(s: Sizes):
    def of_chunk(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = {"chunk": [], "block": [], "cells": [], "counts": []}
        for row, cells, counts in _own_cells(_chunk(table, s), s):
            inside = cells & np.uint64((1 << s.log_block) - 1)
            for block, a, b in _blocks(row, cells, s):
                gaps = np.diff(inside[a:b], prepend=np.uint64(0))
                out["chunk"].append(key[0].as_py())
                out["block"].append(block)
                out["cells"].append(gaps.astype(np.uint16 if gaps.max() < 1 << 16 else np.uint32).tobytes())
                out["counts"].append(np.minimum(counts[a:b], 255).astype(np.uint8).tobytes())
        return pa.table(out, schema=_arrow(SKETCH))

    return of_chunk


FLAGS = "chunk long, kind int, part long, flags binary"


def _merge(s: Sizes):
    def of_block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        merged = np.zeros(1 << s.log_block, np.uint32)
        own = []
        for cells, counts in zip(table.column("cells"), table.column("counts")):
            n = np.frombuffer(counts.as_buffer(), np.uint8)
            raw = cells.as_buffer()
            at = np.cumsum(np.frombuffer(raw, np.uint16 if raw.size == 2 * len(n) else np.uint32), dtype=np.int64)
            merged[at] += n
            own.append(at)
        flags = [np.packbits(merged[at] >= 2).tobytes() for at in own]
        n = len(flags)
        return pa.table(
            [table.column("chunk"), pa.array([0] * n, pa.int32()), pa.array([key[0].as_py()] * n, pa.int64()), pa.array(flags, pa.binary())],
            schema=_arrow(FLAGS),
        )

    return of_block


def _flag_map(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {p: f for k, p, f in zip(*(table.column(x).to_pylist() for x in ("kind", "part", "flags"))) if k == kind}


def _unpack(flags: bytes | None, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(flags, np.uint8), count=n).astype(bool) if flags else np.zeros(n, bool)


@dataclass
class Candidates:
    """Windows of a chunk that may repeat: places, and each distinct window once."""

    at: np.ndarray  # first words
    which: np.ndarray  # the distinct window at each place
    first_id: np.ndarray  # smallest id in this chunk, by distinct window
    h1: np.ndarray
    h2: np.ndarray
    shard: np.ndarray


def _candidates(c: Chunk, s: Sizes, flags: pa.Table) -> Candidates:
    bits = _flag_map(flags, 0)
    repeated = np.ones(len(c.at), bool)
    for row, cells, _ in _own_cells(c, s):
        flagged = np.zeros(len(cells), bool)
        for block, a, b in _blocks(row, cells, s):
            flagged[a:b] = _unpack(bits.get(block), b - a)
        repeated &= flagged[np.searchsorted(cells, _cells(c.anchor, row, s))] if len(cells) else False
    at = c.at[repeated]
    h1 = W.window_hashes(c.words, s.window, 0)[at]
    h2 = W.window_hashes(c.words, s.window, 1)[at]
    ids = c.ids[c.owner[at]]
    order = np.lexsort((ids, h2, h1))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    pick = order[new]
    return Candidates(at, which, ids[pick], h1[pick], h2[pick], (h1[pick] % np.uint64(s.shards)).astype(np.int64))


def _by_shard(c: Candidates):
    """Shards and the distinct windows of each, always in the same order."""
    order = np.lexsort((c.h2, c.h1, c.first_id, c.shard))
    shard = c.shard[order]
    edges = np.flatnonzero(np.diff(shard)) + 1 if len(shard) else []
    for part in np.split(order, edges):
        if len(part):
            yield int(c.shard[part[0]]), part


WINDOWS = "shard long, chunk long, h1 binary, h2 binary, ids binary, runs binary"


def _send(s: Sizes):
    def of_chunk(key: tuple[pa.Scalar, ...], table: pa.Table, flags: pa.Table) -> pa.Table:
        out = {"shard": [], "chunk": [], "h1": [], "h2": [], "ids": [], "runs": []}
        if table.num_rows and flags.num_rows:
            found = _candidates(_chunk(table, s), s, flags)
            for shard, part in _by_shard(found):
                ids, runs = np.unique(found.first_id[part], return_counts=True)
                out["shard"].append(shard)
                out["chunk"].append(key[0].as_py())
                out["h1"].append(found.h1[part].tobytes())
                out["h2"].append(found.h2[part].tobytes())
                out["ids"].append(ids.tobytes())
                out["runs"].append(runs.astype(np.int32).tobytes())
        return pa.table(out, schema=_arrow(WINDOWS))

    return of_chunk


def _group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Exact grouping: which windows have a smaller document in another chunk."""

    def joined(name, dtype):
        return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype)

    h1, h2 = joined("h1", np.uint64), joined("h2", np.uint64)
    ids = np.repeat(joined("ids", np.int64), joined("runs", np.int32))
    order = np.lexsort((ids, h2, h1))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)
    least = ids[order[new]][np.cumsum(new) - 1]
    later = np.empty(len(order), bool)
    later[order] = ids[order] > least
    ends = np.cumsum([len(x) // 8 for x in table.column("h1").to_pylist()])[:-1]
    flags = [np.packbits(x).tobytes() for x in np.split(later, ends)]
    n = table.num_rows
    return pa.table(
        [table.column("chunk"), pa.array([1] * n, pa.int32()), table.column("shard"), pa.array(flags, pa.binary())],
        schema=_arrow(FLAGS),
    )


def _cut(s: Sizes, schema):
    out_schema = _arrow(schema)

    def of_chunk(key: tuple[pa.Scalar, ...], table: pa.Table, flags: pa.Table) -> pa.Table:
        c = _chunk(table, s)
        gone = np.zeros(len(c.words.starts), bool)
        if flags.num_rows:
            found = _candidates(c, s, flags)
            bits, elsewhere = _flag_map(flags, 1), np.zeros(len(found.h1), bool)
            for shard, part in _by_shard(found):
                elsewhere[part] = _unpack(bits.get(shard), len(part))
            ids = c.ids[c.owner[found.at]]
            at = found.at[elsewhere[found.which] | (ids > found.first_id[found.which])]
            edge = np.zeros(len(gone) + 1, np.int32)
            edge[at] += 1
            edge[at + s.window] -= 1
            gone = np.cumsum(edge[:-1]) > 0
        n_words = c.words.counts
        sums = np.concatenate(([0], np.cumsum(gone)))
        n_removed = sums[c.words.first[1:]] - sums[c.words.first[:-1]]
        texts, spans = _without(_one_array(table.column("text")), c.words, gone, n_removed)
        return pa.table(
            [table.column("doc"), texts.cast(pa.string()), pa.array(n_words), pa.array(n_removed), pa.array(spans, out_schema.field("removed").type)],
            schema=out_schema,
        )

    return of_chunk


def _without(texts: pa.Array, words: W.Words, gone: np.ndarray, n_removed: np.ndarray):
    """Texts without the words marked, and the spans of words cut from each; texts left whole are not decoded."""
    spans, cut = [None] * len(texts), n_removed > 0
    kept = []
    for i in np.flatnonzero(cut):
        a, b = words.first[i], words.first[i + 1]
        mark = np.concatenate(([0], gone[a:b].view(np.int8), [0]))
        begins, ends = np.flatnonzero(np.diff(mark) == 1), np.flatnonzero(np.diff(mark) == -1)
        raw = texts[i].as_buffer().to_pybytes()
        zero = words.starts[a] - _lead(raw)
        out, at = [], 0
        for x, y in zip(begins, ends):
            out.append(raw[at : words.starts[a + x] - zero])
            at = words.starts[a + y] - zero if a + y < b else len(raw)
        out.append(raw[at:])
        kept.append(b"".join(out))
        spans[i] = [{"first": int(x), "words": int(y - x)} for x, y in zip(begins, ends)]
    if kept:
        texts = pc.replace_with_mask(texts, pa.array(cut), pa.array(kept, pa.binary()).cast(texts.type))
    return texts, [x or [] for x in spans]


def _one_array(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _lead(raw: bytes) -> int:
    return len(raw) - len(raw.lstrip(b" \t\n\r\x0b\x0c"))


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    if isinstance(schema, str):
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
        return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])
    return to_arrow_schema(schema)


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    depth: int = 2,
    chunk_bytes: int = 4 << 20,
) -> DataFrame:
    """Cut every word covered by a window that also starts in a document with a smaller id.

    Words are runs of anything but white space, unchanged.  Returns a row per
    input row: ``doc`` (a struct of the input's other columns, whatever their
    names), ``text`` (the input's text where nothing is cut, else what is left
    with the white space before the cuts), ``n_words``, ``n_removed`` and
    ``removed`` (spans of words cut).

    A NULL text has no words and stays NULL; texts with fewer words than a
    window are left alone.  Very long texts are judged whole; a chunk holds one
    text at least.  Rows with the same id, or without one, do not cut each
    other; a missing id counts as larger than all others.  Equal rows give
    equal rows, and those of a stored table are dealt over the chunks like any
    others.  An empty table gives an empty table.
    """
    if window < 2 or not 1 <= depth <= len(ROW_SEEDS):
        raise ValueError("window must be 2 or more, depth 1 to 4")
    n_bytes, _ = text_size(docs, text_col)
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = Sizes.of(n_bytes, window, depth, chunk_bytes, parallel)
    ids, text = column(docs, id_col).cast("long"), column(docs, text_col)
    others = [column(docs, x) for x in docs.columns if x != text_col]
    rows = docs.select(
        # Rows that are equal in both are told apart by their places, so that they share no chunk.
        F.pmod(F.xxhash64(ids, text, *row_places(docs)), F.lit(s.chunks)).alias("chunk"),
        ids.alias("id"),
        text.alias("text"),
        F.struct(*others).alias("doc"),
    )
    out = (
        rows.select("doc", "text")
        .withColumn("n_words", F.lit(0).cast("long"))
        .withColumn("n_removed", F.lit(0).cast("long"))
        .withColumn("removed", F.expr("cast(null as array<struct<first: bigint, words: bigint>>)"))
        .schema
    )
    chunks = rows.groupBy("chunk")
    sketches = chunks.applyInArrow(_sketch(s), SKETCH)
    repeated = sketches.groupBy("block").applyInArrow(_merge(s), FLAGS)
    windows = chunks.cogroup(repeated.groupBy("chunk")).applyInArrow(_send(s), WINDOWS)
    later = windows.groupBy("shard").applyInArrow(_group, FLAGS)
    answers = repeated.unionByName(later)
    return chunks.cogroup(answers.groupBy("chunk")).applyInArrow(_cut(s, out), out)
