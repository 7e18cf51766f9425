"""Near-duplicate classes of documents by ProbMinHash, banding and exact verification.

1. One pass computes ProbMinHash signatures of each document's word shingles,
   weighted and with unit weights, their band keys, and a 128-bit hash of its
   word sequence.  Documents with the same words are one representative from
   here on.
2. Representatives that share a band key are a bucket.  Each is compared with
   its bucket's smallest member, exactly, on the texts.  Verified links give
   first components.
3. A pair that shares a bucket but met neither as member and pivot nor in one
   component could still be a link.  Buckets with members of several
   components are therefore gone through in blocks, on a finer signature;
   pairs whose estimate could belong to a similarity at the threshold are
   verified exactly too.  This is done twice.  The first time members meet those
   of their own block, and each that is not in the block's main component names
   only the one it seems nearest to, which joins the components of a large group
   of near copies.  The second time all blocks meet, and all pairs are named
   that are still in different components; these are few.  Pairs inside a
   component need no test, so a large group of copies is not compared with itself.
4. Components of all verified links are the classes.

Which pairs share a bucket is the only thing left to chance: registers of unit
weight agree with the similarity that is verified, however often a document
repeats a passage.  With 24 bands of 4 of them a pair at similarity 0.8 has
none in common in 3 of a million cases, and the finer signature turns away a
like share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.llm import probminhash as P
from cardamom.llm import words as W
from cardamom.llm.common import column, written
from cardamom.llm.components import components
from cardamom.session import scratch_space

FINE = 1024  # registers of the finer signature, one byte of each is kept
BLOCK = 512  # bucket members compared with each other in one go
NEAREST = 1  # others that a member names the first time

SIGNATURE = "id long, k1 long, k2 long, bands array<long>"


def _bands(n: int, text: np.ndarray, shingle: np.ndarray, times: np.ndarray, bands: int, rows: int) -> pa.ListArray:
    """Band keys of each text: of its weighted signature, and those that differ of the one with unit weights.

    Both kinds are keys of the same buckets.  Where no shingle occurs twice
    the signatures are the same one.
    """
    keys = P.band_keys(P.signatures(n, text, shingle, 1 + np.log(times), bands * rows), bands)
    owner, values = np.repeat(np.arange(n), bands), keys.ravel()
    repeats = np.bincount(text[times > 1], minlength=n) > 0
    if repeats.any():
        of = np.flatnonzero(repeats)
        mine = repeats[text]
        unit = P.signatures(len(of), np.searchsorted(of, text[mine]), shingle[mine], np.ones(mine.sum()), bands * rows)
        unit = P.band_keys(unit, bands)
        other = unit != keys[of]
        owner = np.concatenate((owner, np.repeat(of, other.sum(axis=1))))
        order = np.argsort(owner, kind="stable")
        owner, values = owner[order], np.concatenate((values, unit[other]))[order]
    at = np.searchsorted(owner, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.view(np.int64)), mask=pa.array(np.bincount(text, minlength=n) == 0))


def _sign(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                words = W.find_words(part.column("text"), W.FOLDED)
                text, shingle, times = P.shingle_sets(words, width)
                none = words.counts == 0
                lists = _bands(part.num_rows, text, shingle, times, bands, rows)
                h1, h2 = (pa.array(P.sequence_hash(words, x).view(np.int64), mask=none) for x in (0, 1))
                yield pa.record_batch([part.column("id"), h1, h2, lists], names=["id", "k1", "k2", "bands"])

    return run


def _verify(width: int, threshold: float):
    """Pairs whose sets of distinct shingles have at least this Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text_a", 2 << 20):
                n = part.num_rows
                (ta, sa, _), (tb, sb, _) = (P.shingle_sets(W.find_words(part.column(x), W.FOLDED), width) for x in ("text_a", "text_b"))
                # Shingles are told apart by 64 bits, mixed with the number of the pair.
                ka, kb = (W.mix(s + t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for t, s in ((ta, sa), (tb, sb)))
                _, at, _ = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
                shared = np.bincount(ta[at], minlength=n)
                union = np.bincount(ta, minlength=n) + np.bincount(tb, minlength=n) - shared
                good = np.flatnonzero((union > 0) & (shared >= threshold * union - 1e-9))
                yield pa.record_batch([part.column(x).take(pa.array(good)) for x in ("a", "b")], names=["a", "b"])

    return run


def _links(pairs: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """Pairs (a, b) that are similar enough."""
    joined = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    found = joined.select("a", "b", "text_a", "text_b").mapInArrow(_verify(width, threshold), "a long, b long")
    return found.distinct()


def _fine(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 20):
                words = W.find_words(part.column("text"), W.FOLDED)
                text, shingle, _ = P.shingle_sets(words, width)
                got = P.signatures(part.num_rows, text, shingle, np.ones(len(text)), FINE).astype(np.uint8)
                yield pa.record_batch([part.column("id"), pa.array([x.tobytes() for x in got], pa.binary())], names=["id", "fine"])

    return run


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that hold all rows of their keys, and where each key's rows begin; rows come sorted."""
    rest = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        first = _begins(batch, keys)
        rest = batch.slice(first[-1])
        if first[-1]:
            yield batch.slice(0, first[-1]), first
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _begins(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for key in keys:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _compare(floor: float, most: int | None):
    """Pairs of a block pair that are in different components and could reach the threshold.

    With ``most`` each member names at most so many others, those of the highest
    estimates, and members of the component that most of them are in name none.
    Otherwise a pair that shares several buckets is named in the smallest only,
    where it meets too: a bucket with members of two components is mixed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first in whole_runs(batches, ["band", "low", "high"]):
            ids, comp, block, low, high = (batch.column(x).to_numpy() for x in ("id", "comp", "block", "low", "high"))
            fine = np.frombuffer(b"".join(batch.column("fine").to_pylist()), np.uint8).reshape(-1, FINE)
            shared, band = batch.column("shared").to_pylist(), batch.column("band").to_numpy()
            out_a, out_b = [], []
            ends = np.append(first[first < batch.num_rows][1:], batch.num_rows)
            for x, y in zip(first, ends):
                order = x + np.lexsort((ids[x:y], comp[x:y]))
                c = comp[order]
                one = low[x] == high[x]
                past = np.searchsorted(c, c, "right")
                labels, sizes = np.unique(c, return_counts=True)
                main = labels[sizes.argmax()]
                for i in range(len(order)):
                    if most and c[i] == main:
                        continue
                    others = order[c != c[i]] if most else order[past[i] :]
                    if not one:
                        others = others[block[others] != block[order[i]]]
                    if len(others):
                        same = (fine[others] == fine[order[i]]).mean(axis=1)
                        near = np.flatnonzero((same - 1 / 256) / (1 - 1 / 256) >= floor)
                        if most and len(near) > most:
                            near = near[np.argsort(-same[near], kind="stable")[:most]]
                        others = others[near]
                        if not most and len(others):
                            # A pair that meets in several buckets is named in the first of them.
                            earlier = {x for x in shared[order[i]] if x < band[order[i]]}
                            others = np.array([j for j in others if earlier.isdisjoint(shared[j])], np.int64)
                        out_a.append(np.minimum(ids[others], ids[order[i]]))
                        out_b.append(np.maximum(ids[others], ids[order[i]]))
            a, b = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (out_a, out_b))
            yield pa.record_batch([pa.array(b), pa.array(a)], names=["a", "b"])

    return run


def _mixed(crowded: DataFrame, comps: DataFrame) -> DataFrame:
    """Members, with their components, of the buckets that hold several components."""
    members = crowded.select("band", "id").join(comps.withColumnRenamed("node", "id"), "id", "left")
    members = members.select("band", "id", F.coalesce("component", "id").alias("comp"))
    buckets = members.groupBy("band").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count("*").alias("n"))
    return members.join(buckets.where("least < most and n > 2").select("band", "n"), "band")


def _block_pairs(rows: DataFrame, own: bool) -> DataFrame:
    """Each member once for every pair of blocks that it is in, or for its own block alone."""
    n_blocks = F.ceil(F.col("n") / BLOCK)
    other = F.col("other")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), n_blocks))
    if own:
        return dealt.select("band", "id", "comp", "block", F.col("block").alias("low"), F.col("block").alias("high"))
    return (
        dealt.select("band", "id", "comp", "block", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)).alias("other"))
        .select("band", "id", "comp", "block", F.least("block", other).alias("low"), F.greatest("block", other).alias("high"))
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    width: int = 5,
    bands: int = 24,
    rows: int = 4,
) -> DataFrame:
    """Classes of documents that are linked by a similarity of ``threshold`` or more.

    Words are lower-cased runs of letters, digits and non-ASCII characters;
    similarity is the Jaccard similarity of the sets of distinct shingles of
    ``width`` words.  Candidates share a band of signatures with unit weights,
    or of signatures in which a shingle weighs 1 + ln(times).

    Returns (id_col, class_id, copy_of) for every input row: the smallest id of
    the class, and the smallest id with exactly the same words.  A text of
    fewer words than a shingle is one shingle.  Documents without words (NULL
    text too) are in no class but their own; a row without an id has no class.
    Rows that repeat an id are one document.  An empty table gives an empty
    one.  Very long texts are signed and compared whole.
    """
    rows_in = docs.select(column(docs, id_col).cast("long").alias("id"), column(docs, text_col).alias("text"))
    signed = written(rows_in.mapInArrow(_sign(width, bands, rows), SIGNATURE), "signatures")
    usable = signed.where("id is not null and k1 is not null")
    # Written, so that the joins below read plain shuffles, whose hot keys Spark can split.
    firsts = written(usable.groupBy("k1", "k2").agg(F.min("id").alias("rep")), "firsts")
    with scratch_space(docs.sparkSession) as keep:
        reps = usable.join(firsts, ["k1", "k2"]).where("id = rep").select("id", F.explode("bands").alias("band"))
        buckets = reps.groupBy("band").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last")
        buckets = keep(buckets, "pivots")
        crowded = keep(reps.join(buckets.select("band", "pivot"), "band").select("band", "id", "pivot").distinct(), "buckets")
        texts = keep(rows_in.join(crowded.select("id").distinct(), "id", "left_semi"), "texts")

        tested = crowded.where("id > pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
        comps = components(keep(_links(tested, texts, width, threshold), "links"), "a", "b")
        floor = threshold - 4.5 * float(np.sqrt(threshold * (1 - threshold) / FINE))
        fine = None
        for most in (NEAREST, None):
            mixed = keep(_mixed(crowded, comps), "mixed")
            if mixed.isEmpty():
                break
            if fine is None:  # components only grow, so later members are among these
                # The buckets of a member are at most as many as its bands.
                shared = mixed.groupBy("id").agg(F.collect_set("band").alias("shared"))
                fine = texts.join(shared.select("id"), "id", "left_semi").mapInArrow(_fine(width), "id long, fine binary")
                fine = keep(fine.join(shared, "id"), "fine")
            pairs = (
                _block_pairs(mixed, own=most is not None)
                .join(fine, "id")
                .repartition("band", "low", "high")
                .sortWithinPartitions("band", "low", "high")
                .mapInArrow(_compare(floor, most), "a long, b long")
                .distinct()
                .join(tested, ["a", "b"], "left_anti")
            )
            pairs = keep(pairs, "pairs")
            more = keep(_links(pairs, texts, width, threshold), "links")
            edges = comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
            comps, tested = components(edges, "a", "b"), tested.unionByName(pairs)

    return (
        signed.select("id", "k1", "k2")
        .join(firsts, ["k1", "k2"], "left")
        .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("id").alias(id_col),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")).alias("class_id"),
            F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("copy_of"),
        )
    )
