"""Stages of corpus cleaning: each decides with one operator and gives back documents.

A stage takes (spark, docs, sf_dir).  All but the last return rows with the
columns of ``docs``, whatever columns there are besides doc_id and text;
labels and benchmark items come from ``sf_dir``.  Rows whose text is NULL or
empty pass every filter and get no place in a sequence; an empty table passes
as one.  Ids may repeat or be missing: stages decide about rows, and equal rows
are decided about alike but by ``keep_one_of_each_class``, which keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.llm.common import column, table, written
from cardamom.llm.decontaminate import decontaminate
from cardamom.llm.near_dedup import near_duplicates
from cardamom.llm.packing import pack, word_count
from cardamom.llm.substring_dedup import dedup_substrings
from cardamom.llm.toxicity import fit_toxicity, score_toxicity

NODE = "_node"


def _as_documents(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from a result's ``doc`` struct and text."""
    return found.select(*(F.col("text") if x == "text" else F.col("doc")[x].alias(x) for x in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labelled ones among them, does not reject."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return _as_documents(score_toxicity(docs, model).where("predicted = 0"), docs)


def with_own_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``_node`` that tells its rows apart: the id, where no other row has it.

    Of rows that repeat an id one keeps it; the others, and rows without an id,
    get numbers that are no id.  Those rows alone are written, so that a task
    that runs again cannot number them anew.
    """
    doc_id = column(docs, "doc_id").cast("long")
    rows = docs.select("*", doc_id.alias(NODE))
    counts = rows.groupBy(NODE).agg(F.count("*").alias("n"))
    again = written(counts.where(f"n > 1 or {NODE} is null").select(F.col(NODE).alias("again")), "repeated_ids")
    if again.isEmpty():
        return rows
    low, high = rows.agg(F.min(NODE), F.max(NODE)).first()
    same = F.col(NODE).eqNullSafe(F.col("again"))
    odd = written(rows.join(again, same, "left_semi").withColumn("_n", F.monotonically_increasing_id()), "repeated_rows")
    firsts = odd.where(f"{NODE} is not null").groupBy(NODE).agg(F.min("_n").alias("_n")).withColumn("_first", F.lit(True))
    # Numbers above all ids, or below them where there is no room above.
    fresh = F.lit(high or 0) + F.col("_n") + 1 if (high or 0) < 1 << 62 else F.lit(low) - F.col("_n") - 1
    told = odd.join(firsts, [NODE, "_n"], "left").withColumn(NODE, F.when(F.col("_first"), F.col(NODE)).otherwise(fresh))
    alone = rows.join(again, same, "left_anti")
    return alone.unionByName(told.select(alone.columns))


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: that of the smallest id, as a rule.

    Where ids repeat or are missing, rows are told apart by their texts: a row
    goes only if its own text is near that of a row that stays.
    """
    rows = with_own_ids(docs)
    classes = near_duplicates(rows, id_col=NODE)
    losers = classes.where(f"{NODE} <> class_id").select(NODE)
    return rows.join(losers, NODE, "left_anti").select(*(column(rows, x) for x in docs.columns))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of an earlier document; what has no word left goes."""
    found = dedup_substrings(docs).where("n_removed = 0 or n_removed < n_words")
    picked = {x: F.col("doc")[x] for x in docs.columns if x != "text"} | {"text": F.col("text")}
    if "n_chars" in picked:
        picked["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(picked["n_chars"])
    return found.select(*(picked[x].alias(x) for x in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark passages to 5 % or more of their words."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _as_documents(found.where("not contaminated"), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in a training sequence for every piece of every document."""
    return pack(docs, word_count(F.col("text")))
