"""The registered queries of this subpackage: thin digests of its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import sql
from termloom.llm.alignment import align_tokens
from termloom.llm.audit import filter_audit
from termloom.llm.common import remainder
from termloom.llm.language import identify_language, train_language
from termloom.llm.lines import drop_repeated_lines
from termloom.llm.minhash import near_copies
from termloom.llm.mixing import five_two_one, plan_mix, taken_words
from termloom.llm.neighbours import near_vectors
from termloom.llm.packing import pack_documents
from termloom.llm.pii import BASE, count_of, find_pii, score_text, span_text
from termloom.llm.quality import quality_scores, train_quality
from termloom.llm.rules import quality_rules
from termloom.llm.token_counts import token_counts
from termloom.llm.toxicity import toxicity_scores, train_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    return taken_words(documents, plan_mix(documents, five_two_one, factor=1.5, most=2.0))


def op2_language(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    held_out = remainder("doc_id", 5) == 0
    net = train_language(documents.filter(~held_out).select("doc_id", "text", "lang"))
    return identify_language(documents.select("doc_id", "text"), net).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op3_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors(_table(spark, sf, "embeddings")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id")
    )


def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_counts(_table(spark, sf, "documents"))


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 3) == 1
    model = train_quality(documents.filter(~held_out), _table(spark, sf, "labels"))
    return quality_scores(documents, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 4) == 2
    model = train_toxicity(documents.filter(~held_out), _table(spark, sf, "labels"))
    return toxicity_scores(documents, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules(_table(spark, sf, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.array_join("failed", ",").alias("failed"),
    )


def op8_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    copies = near_copies(_table(spark, sf, "documents"), words=2)
    return copies.select(
        "doc_id",
        "n_shingles",
        "component_id",
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = pack_documents(_table(spark, sf, "documents"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = find_pii(_table(spark, sf, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[count_of(spans, kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(span_text(spans, BASE).cast("binary"), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
        score_text(spans).alias("scores"),
    )


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return align_tokens(_table(spark, sf, "documents"))


def op12_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return drop_repeated_lines(_table(spark, sf, "documents")).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def queries() -> dict[str, Query]:
    return {
        query.__name__: query
        for query in (
            op1_mixing,
            op2_language,
            op3_near_vectors,
            op4_token_counts,
            op5_quality,
            op6_toxicity,
            op7_quality_rules,
            op8_near_copies,
            op9_packing,
            op10_pii,
            op11_alignment,
            op12_line_dedup,
            op13_filter_audit,
        )
    }


def oracle_sql() -> dict[str, str]:
    return sql.statements()
