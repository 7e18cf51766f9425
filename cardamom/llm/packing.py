"""Pack documents into sequences of several permitted lengths: variable-capacity best-fit.

Documents longer than the longest sequence are cut into pieces; pieces are
packed longest first, each into the fullest open bin that still takes it.
When none does, a bin is opened.  Which size to open is the joint question: a
small bin is cheap to waste, a large one can take more of what follows.  A
plan fixes, for each length that may have to open a bin, the size opened; the
plans tried open the least-cost size for what the remaining pieces can be
expected to fill, and each permitted size as a floor.  After packing, every
bin is downsized to the smallest permitted length that holds its contents, and
the plan that is cheapest after downsizing is kept.

Pieces are dealt into shards of bounded size by a hash and every shard is
packed by itself, which costs at most a few part-filled bins for each shard.
A shard is packed on counts by length: all pieces of one length move at once.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.llm.common import column, written

PLACED = "shard long, id long, row long, piece long, start long, length long, bin long, capacity long, offset long"


def word_count(text: Column) -> Column:
    """Words between white space; 0 for NULL and blank texts."""
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, " "))).cast("long")


def sequence_cost(capacity: int, fixed: float) -> float:
    """What a sequence costs: its slots, and a fixed amount for each sequence."""
    return capacity + fixed


def _pack(lengths: np.ndarray, counts: np.ndarray, opening: dict[int, int]):
    """Best-fit decreasing on counts by length.

    Returns groups of equal bins as [number, contents], contents a list of
    (length, times).  ``opening`` says which size a length opens.
    """
    free: dict[int, list[list]] = {}  # room left -> groups of bins
    rooms: list[int] = []

    def put(room: int, group: list) -> None:
        if room not in free:
            free[room] = []
            insort(rooms, room)
        free[room].append(group)

    for length, left in zip(lengths.tolist()[::-1], counts.tolist()[::-1]):
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                group = free[room].pop()
                if not free[room]:
                    del free[room]
                    rooms.pop(i)
            else:
                room = opening[length]
                group = [-(-left // (room // length)), []]
            times = min(room // length, left)
            bins = min(group[0], left // times)
            if bins < group[0]:
                put(room, [group[0] - bins, group[1]]) if group[1] else None
            put(room - times * length, [bins, [*group[1], (length, times)]])
            left -= bins * times
    return [group for groups in free.values() for group in groups]


def _plans(lengths: np.ndarray, counts: np.ndarray, sizes: Sequence[int], fixed: float):
    """For each plan, the size of bin that each length opens."""
    smallest = {int(x): sizes[bisect_left(sizes, int(x))] for x in lengths}
    for floor in sizes:
        yield {x: max(smallest[x], floor) for x in smallest}
    # Least cost for each slot filled: what is left in a bin can be filled as far as shorter pieces last.
    shorter = np.concatenate(([0], np.cumsum(lengths * counts)))
    plan = {}
    for i, x in enumerate(lengths.tolist()):
        share = shorter[i] / max(1, counts[i])
        plan[x] = min(
            (s for s in sizes if s >= x),
            key=lambda s: (sequence_cost(s, fixed) / (x * (s // x) + min(s % x, share)), s),
        )
    yield plan


def best_plan(lengths: np.ndarray, counts: np.ndarray, sizes: Sequence[int], fixed: float):
    """Bins of the cheapest plan, downsized: [(number, capacity, contents)], and their cost."""
    best, least = [], float("inf")
    tried = set()
    for plan in _plans(lengths, counts, sizes, fixed):
        key = tuple(sorted(plan.items()))
        if key in tried:
            continue
        tried.add(key)
        bins = []
        for number, contents in _pack(lengths, counts, plan):
            used = sum(x * n for x, n in contents)
            bins.append((number, sizes[bisect_left(sizes, used)], contents))
        cost = sum(number * sequence_cost(size, fixed) for number, size, _ in bins)
        if cost < least:
            best, least = bins, cost
    return best, least


def _pack_shard(sizes: tuple[int, ...], fixed: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, rows, pieces, start, length = (table.column(x).fill_null(0).to_numpy() for x in ("id", "row", "piece", "start", "length"))
        lengths, counts = np.unique(length, return_counts=True)
        bins, _ = best_plan(lengths, counts, sizes, fixed)
        order = np.lexsort((pieces, rows, ids, length))
        first = dict(zip(lengths.tolist(), np.searchsorted(length[order], lengths).tolist()))
        n = len(ids)
        number, capacity, offset = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
        opened = 0
        for bins_here, size, contents in bins:
            at = 0
            for x, times in contents:
                who = order[first[x] : first[x] + bins_here * times]
                first[x] += len(who)
                number[who] = opened + np.repeat(np.arange(bins_here), times)
                offset[who] = at + np.tile(np.arange(times) * x, bins_here)
                capacity[who] = size
                at += x * times
            opened += bins_here
        shard = key[0].as_py()
        return pa.table(
            [
                pa.array(np.full(n, shard)),
                table.column("id"),
                *(pa.array(x) for x in (rows, pieces, start, length, number, capacity, offset)),
            ],
            names=[x.split()[0] for x in PLACED.split(", ")],
        )

    return run


def pack(
    docs: DataFrame,
    lengths: Column,
    id_col: str = "doc_id",
    capacities: Sequence[int] = (512, 1024, 2048, 4096),
    fixed_cost: float = 64.0,
    shard_pieces: int = 8_192,
) -> DataFrame:
    """Place every document in sequences.

    Returns a row per piece: id_col, ``piece`` (0, 1, … within the document),
    ``start`` and ``length`` in the document, ``bin_id``, ``capacity`` of the
    bin and ``offset`` in it.  A document longer than the largest capacity is
    cut into pieces of that capacity and a rest.  ``lengths`` gives each row's
    length.

    Rows of no length (NULL, 0 or less) get no place and no row.  Rows that
    repeat an id, or have none, are each packed; ``row`` in the result tells
    them apart.  An empty table gives an empty table.
    """
    sizes = tuple(sorted({int(x) for x in capacities}))
    if not sizes or sizes[0] < 1:
        raise ValueError("capacities must be positive")
    top = sizes[-1]
    rows = docs.select(
        column(docs, id_col).cast("long").alias("id"),
        F.xxhash64(*(column(docs, x) for x in docs.columns)).alias("row"),
        lengths.cast("long").alias("total"),
    ).where("total > 0")
    # A few bytes a row; measuring a text is most of the work and is done once.
    # The number deals equal rows over the shards, and is written with them.
    rows = written(rows.withColumn("number", F.monotonically_increasing_id()), "lengths")
    total = rows.agg(F.coalesce(F.sum(F.ceil(F.col("total") / top)), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // shard_pieces))
    pieces = rows.select("id", "row", "number", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("total") / top) - 1)).alias("piece"))
    pieces = pieces.select(
        F.pmod(F.xxhash64("id", "row", "number", "piece"), F.lit(shards)).alias("shard"),
        "id",
        "row",
        "piece",
        (F.col("piece") * top).alias("start"),
        F.least(F.col("total") - F.col("piece") * top, F.lit(top).cast("long")).alias("length"),
    )
    placed = pieces.groupBy("shard").applyInArrow(_pack_shard(sizes, float(fixed_cost)), PLACED)
    return placed.select(
        F.col("id").alias(id_col),
        "row",
        "piece",
        "start",
        "length",
        F.concat_ws("-", F.col("shard").cast("string"), F.col("bin").cast("string")).alias("bin_id"),
        "capacity",
        "offset",
    )


def packed_texts(placed: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The sequences themselves: bin_id, capacity, ``used`` and ``text``, words joined by spaces in offset order.

    ``docs`` is the table that was packed, with lengths from ``word_count``.
    """
    words = F.split(F.trim(F.regexp_replace(column(docs, text_col), r"[\x20\x09-\x0D]+", " ")), " ")
    texts = docs.select(
        F.xxhash64(*(column(docs, x) for x in docs.columns)).alias("row"),
        words.alias("words"),
    ).dropDuplicates(["row"])
    joined = placed.join(texts, "row")
    cut = F.array_join(F.slice("words", (F.col("start") + 1).cast("int"), F.col("length").cast("int")), " ")
    # A bin holds at most its capacity, so the list is bounded.
    return (
        joined.select("bin_id", "capacity", "length", F.struct("offset", cut.alias("text")).alias("part"))
        .groupBy("bin_id", "capacity")
        .agg(F.sum("length").alias("used"), F.array_sort(F.collect_list("part")).alias("parts"))
        .select("bin_id", "capacity", "used", F.array_join("parts.text", " ").alias("text"))
    )
