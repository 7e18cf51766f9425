"""Near-duplicates by SimHash fingerprints, with distances to pivots to rule pairs out.

1. One pass gives every document a 64-bit fingerprint of its word shingles.
   Documents with the same fingerprint are one node from here on.
2. Every node has a row of the pivot table: its Hamming distances to some
   reference fingerprints.  By the triangle inequality two nodes are at least
   as far apart as their distances to any one pivot differ, so pairs with a
   larger difference than ``distance`` at some pivot are discarded unseen; what
   survives all pivots is verified on the fingerprints.
3. Pairs meet where their fingerprints agree on enough parts: with the 64 bits
   cut into more than ``distance`` parts, two nodes that differ in ``distance``
   bits agree on all parts but ``distance``.  Every choice of that many parts
   is a key, so no link is lost.  A key with many nodes is split into blocks,
   and pairs of blocks go to tasks of their own.
4. A block pair sends its links on as stars, a row for each node at most, so
   even a key whose nodes are all alike emits no pairs.  Connected components
   of all stars are the classes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.llm import words as W
from cardamom.llm.common import attach, column, written
from cardamom.llm.components import components
from cardamom.llm.near_dedup import whole_runs
from cardamom.session import scratch_space

SEED = 42
BITS = 64
BLOCK = 2048  # nodes of a key that are compared with each other in one go
TILE = 512  # of them, the rows of the difference matrices held at a time
PIECE = 1 << 20  # bytes of a text hashed at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, width: int, piece: int = PIECE) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words, lower-cased and one space apart, some at a time.

    Fewer words are one run; no words, none.
    """
    at, kept, seen = 0, [], False
    while at < len(text):
        end = at + piece
        if end < len(text):
            gap = _SPACE.search(text, end)
            end = gap.start() if gap else len(text)
        # Both work on ASCII alone, which is what words and their case are defined by.
        words = kept + text[at:end].lower().split()
        at, last = end, end >= len(text)
        if len(words) >= width or (last and words and not seen):
            seen = True
            line = b" ".join(words)
            ends = np.cumsum([len(x) + 1 for x in words]) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            size = min(width, len(words))
            runs = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
            yield np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in runs], np.uint64)
            kept = words[len(words) - width + 1 :] if width > 1 else []
        else:
            kept = words


def bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set, for the runs that begin at ``first`` (none is empty).

    Eight bits are counted at once, a byte each; a byte holds the count of 255 hashes.
    """
    sizes = np.diff(np.append(first, len(hashes)))
    blocks = -(-sizes // 255)
    run = np.repeat(np.arange(len(first)), blocks)
    begin = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    starts = first[run] + 255 * (np.arange(len(run)) - begin[run])
    lanes = np.stack([np.add.reduceat((hashes >> np.uint64(b)) & _LANES, starts) for b in range(8)], axis=1)
    counts = np.ascontiguousarray(lanes).view(np.uint8).reshape(len(run), 8, 8).swapaxes(1, 2).reshape(len(run), BITS)
    return np.add.reduceat(counts.astype(np.int64), begin, axis=0)


def fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """Bit by bit the majority of the shingles' hashes; no words give zero."""
    out = np.zeros(len(texts), np.uint64)
    counts, total = {}, {}
    pending, owner, held = [], [], 0

    def settle():
        nonlocal pending, owner, held
        if pending:
            first = np.concatenate(([0], np.cumsum([len(x) for x in pending])[:-1]))
            for i, got, x in zip(owner, bit_counts(np.concatenate(pending), first), pending):
                counts[i] = counts.get(i, 0) + got
                total[i] = total.get(i, 0) + len(x)
        pending, owner, held = [], [], 0

    for i, text in enumerate(texts):
        for hashes in shingle_hashes(text, width):
            pending.append(hashes)
            owner.append(i)
            held += len(hashes)
            if held >= 1 << 18:
                settle()
    settle()
    for i, got in counts.items():
        out[i] = np.packbits(2 * got > total[i], bitorder="little").view(np.uint64)[0]
    return out


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                texts = [x or b"" for x in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.record_batch([part.column("id"), pa.array(fingerprints(texts, width).view(np.int64))], names=["id", "fp"])

    return run


def parts_for(nodes: int, distance: int) -> int:
    """Parts to cut the bits into, so that chance puts few nodes under one key.

    More parts give longer keys but more of them; any number above ``distance``
    finds the same links.
    """
    parts = distance + 1
    while parts < min(distance + 6, BITS) and nodes >> (BITS * (parts - distance) // parts) > 64:
        parts += 1
    return parts


def key_masks(parts: int, distance: int) -> list[int]:
    """Bits of every choice of ``parts - distance`` parts, as signed 64-bit numbers."""
    edges = [BITS * k // parts for k in range(parts + 1)]
    pieces = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:])]
    masks = (sum(x) for x in combinations(pieces, parts - distance))
    return [x - (1 << BITS) if x >> (BITS - 1) else x for x in masks]


def pivot_table(fp: Column, pivots: list[int]) -> Column:
    """Hamming distances to the pivots."""
    return F.array(*(F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("byte") for p in pivots))


def near_pairs(fp: np.ndarray, table: np.ndarray, distance: int, across: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places (i, j) whose fingerprints differ in at most ``distance`` bits.

    Nodes are sorted by their distance to the pivot that spreads them most, so
    a node is looked at beside those of a window of that distance only; pivots
    are then asked one after the other.  ``across`` marks two sides, and only
    pairs between them are found.
    """
    asked = np.argsort(-table.std(axis=0), kind="stable")
    order = np.argsort(table[:, asked[0]], kind="stable")
    fp, table = fp[order], table[order].astype(np.int16)
    lead = table[:, asked[0]]
    past = np.searchsorted(lead, lead + distance, "right")
    found = []
    for a in range(0, len(fp), TILE):
        b = min(len(fp), a + TILE)
        window = lead[a : past[b - 1]]
        i, j = np.nonzero(np.triu(window[None, :] - lead[a:b, None] <= distance, 1))
        i, j = i + a, j + a
        if across is not None:
            keep = across[order[i]] != across[order[j]]
            i, j = i[keep], j[keep]
        for k in asked[1:]:
            keep = np.abs(table[i, k] - table[j, k]) <= distance
            i, j = i[keep], j[keep]
        keep = np.bitwise_count(fp[i] ^ fp[j]) <= distance
        found.append((order[i[keep]], order[j[keep]]))
    i, j = (np.concatenate(x) for x in zip(*found))
    return i, j


def stars(fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node of a pair to the smallest fingerprint of its connected component."""
    label = fp.copy()
    while True:
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        if (label == before).all():
            break
    other = np.flatnonzero(label != fp)
    return fp[other], label[other]


def _compare(distance: int):
    """Stars of the links inside each block pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first in whole_runs(batches, ["which", "part", "low", "high"]):
            signed, block, low, high = (batch.column(x).to_numpy() for x in ("fp", "block", "low", "high"))
            table = batch.column("table").flatten().to_numpy().reshape(batch.num_rows, -1)
            out = []
            for x, y in zip(first, np.append(first[first < batch.num_rows][1:], batch.num_rows)):
                if y - x > 1:
                    side = block[x:y] == low[x] if low[x] != high[x] else None
                    i, j = near_pairs(signed[x:y].view(np.uint64), table[x:y], distance, side)
                    if len(i):
                        out.append(stars(signed[x:y], i, j))
            a, b = (np.concatenate(z) for z in zip(*out)) if out else (np.zeros(0, np.int64),) * 2
            yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    distance: int = 4,
    pivots: int = 24,
    parts: int | None = None,
) -> DataFrame:
    """Components of documents whose fingerprints differ in at most ``distance`` bits.

    Words are runs of anything but white space with A-Z lower-cased; a
    fingerprint bit is set if more than half of the hashes of all runs of
    ``width`` words, repeats included, have it.  Returns (id_col,
    ``fingerprint`` as 16 hexadecimal digits, ``component_id``, the smallest id
    reachable) for every input row.  ``parts`` (any number above ``distance``
    and up to 64) follows the number of fingerprints unless given, and like
    ``pivots`` does not change the result.

    A text of fewer words than ``width`` is one run; without words (NULL too)
    the fingerprint is zero and links like any other.  Very long texts are
    hashed piece by piece, whole.  Rows that repeat an id are linked by their
    own fingerprints each.  A row without an id links what is near it, and its
    component is named by the smallest id there, NULL where none has one.  An
    empty table gives an empty table.
    """
    if not 0 <= distance < BITS - 1 or pivots < 1 or (parts is not None and not distance < parts <= BITS):
        raise ValueError("distance must be 0 to 62, parts above it and up to 64, pivots at least 1")
    rows = docs.select(column(docs, id_col).cast("long").alias("id"), column(docs, text_col).alias("text"))
    signed = written(rows.mapInArrow(_sign(width), "id long, fp long"), "fingerprints")
    nodes = written(signed.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "nodes")
    total, n_nodes = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # A bounded number of fingerprints, the same ones at every run.
    chosen = [r.fp for r in nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(pivots).collect()]

    masks = key_masks(parts or parts_for(n_nodes, distance), distance)
    keyed = nodes.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(x)) for x in masks))).alias("which", "part"))
    with scratch_space(docs.sparkSession) as keep:
        shared = keep(keyed.groupBy("which", "part").agg(F.count("*").alias("n")).where("n > 1"), "keys")
        blocks = F.ceil(F.col("n") / BLOCK)
        other = F.col("other")
        dealt = (
            keyed.join(shared, ["which", "part"])
            .withColumn("block", F.pmod(F.xxhash64("fp"), blocks))
            .select("fp", "which", "part", "block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
            .select("fp", "which", "part", "block", F.least("block", other).alias("low"), F.greatest("block", other).alias("high"))
        )
        links = (
            dealt.repartition("which", "part", "low", "high")
            .sortWithinPartitions("which", "part", "low", "high")
            .withColumn("table", pivot_table(F.col("fp"), chosen or [0]))
            .mapInArrow(_compare(distance), "a long, b long")
        )
        comps = components(links, "a", "b").select(F.col("node").alias("fp"), F.col("component").alias("root"))
        linked = keep(nodes.join(comps, "fp").select("fp", "root", "least"), "linked")
        named = linked.join(linked.groupBy("root").agg(F.min("least").alias("name")), "root").select("fp", "name")
        answers = written(nodes.join(named, "fp", "left").select("fp", "n", F.coalesce("name", "least").alias("name")), "answers")
    found = attach(signed, answers, "fp", "n", int(total))
    return found.select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("name").alias("component_id"),
    )
