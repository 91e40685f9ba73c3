"""Term frequency, document frequency and document length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.operators.rows import explode_computed


def explode_tokens(tokens: DataFrame) -> DataFrame:
    """(doc_id, position, term), positions counted from 0."""
    return explode_computed(tokens, ["doc_id"], "tokens", "term", position="position")


def term_frequency(tokens: DataFrame) -> DataFrame:
    """(term, doc_id, tf); rows that share an id are merged.

    The counts are summed within each map task first, and the pair is the
    shuffle key, so neither a common term nor a repeated id is one task's work.
    """
    return (
        explode_computed(tokens, ["doc_id"], "tokens", "term")
        .groupBy("term", "doc_id")
        .agg(F.count("*").alias("tf"))
    )


def document_frequency(tf: DataFrame) -> DataFrame:
    """(term, df), given one row per term and document."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def document_frequency_distinct(tokens: DataFrame) -> DataFrame:
    """(term, df) straight from tokens, by distinct documents.

    Rows without an id count as one document, as they do in `term_frequency`.
    """
    return (
        explode_computed(tokens, ["doc_id"], "tokens", "term")
        .distinct()
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def document_frequency_by_row(tokens: DataFrame) -> DataFrame:
    """(term, df) where every row is a document of its own, as unique ids make it.

    Each row's terms are made distinct in place, so one shuffle by term is all.
    """
    return (
        explode_computed(tokens, [], F.array_distinct("tokens"), "term")
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def document_length(tokens: DataFrame) -> DataFrame:
    """(doc_id, length): tokens of each document that has any; rows of one id add up.

    Documents without tokens go after the sum, for a filter on the tokens would
    have every text tokenised twice.
    """
    sizes = tokens.select("doc_id", F.size("tokens").alias("size"))
    return sizes.groupBy("doc_id").agg(F.sum("size").alias("length")).filter("length > 0")


def has_unique_ids(documents: DataFrame) -> bool:
    """Whether no two rows share an id, told by one scan of the ids."""
    return documents.groupBy("doc_id").count().filter("count > 1").isEmpty()
