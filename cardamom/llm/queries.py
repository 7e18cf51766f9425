"""The numbered operators on the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.llm.common import held_out, table
from cardamom.llm.decontaminate import decontaminate
from cardamom.llm.fill_middle import fill_in_middle, restored
from cardamom.llm.filter_audit import audit_filters
from cardamom.llm.language_id import fit_languages, identify_language
from cardamom.llm.mtree import quantized, top_k
from cardamom.llm.near_dedup import near_duplicates
from cardamom.llm.packing import pack, word_count
from cardamom.llm.quality import fit_quality, score_quality
from cardamom.llm.simhash import simhash_components
from cardamom.llm.substring_dedup import dedup_substrings
from cardamom.llm.token_counts import count_tokens, load_vocabulary
from cardamom.llm.toxicity import fit_toxicity, score_toxicity
from cardamom.llm.warc import page_records, read_archives, resolve, write_archives
from cardamom.session import shared_dir

# A public unigram-style vocabulary; every vocabulary file is a parameter of its operator.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents"))
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_removed",
        F.sha2(words.cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score", "predicted")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_language(docs, fit_languages(docs))
    return found.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = count_tokens(table(spark, sf_dir, "documents"), load_vocabulary(VOCABULARY))
    return found.select("doc.doc_id", "n_tokens")


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(docs, word_count(F.col("text")))


@query
def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_archives(page_records(table(spark, sf_dir, "pages")), path)
    found = resolve(read_archives(spark, path))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantized(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("id") % 20 == 0), k=20)


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs))
    return scored.select("doc.doc_id", "score", "predicted", "posterior")


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents"))
    return found.select(
        "doc.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
