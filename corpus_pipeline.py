"""Corpus cleaning in stages, each of which reads what the one before it wrote.

The stages are those of ``cardamom.llm.pipeline``; this is their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardamom.llm.common import table, written
from cardamom.llm.pipeline import cut_repeated_passages, drop_contaminated, drop_toxic, keep_one_of_each_class, pack_sequences

STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", keep_one_of_each_class),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Scores and signatures are not expressible in SQL; tests/llm holds the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
