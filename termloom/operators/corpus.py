"""From documents to tokens and bags of words."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.stop_words import ENGLISH
from termloom.functions.text import clean, document_tokens
from termloom.profiles import Profile


def corpus(table: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) without the rows that have no text."""
    return table.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(
        F.col("text").isNotNull()
    )


def corpus_size(documents: DataFrame) -> DataFrame:
    """N: rows with text, not distinct ids, empty texts included."""
    return documents.filter(F.col("text").isNotNull()).agg(F.count("*").alias("n_docs"))


def tokenize_corpus(
    documents: DataFrame, profile: Profile, stop_words: Iterable[str] = ENGLISH
) -> DataFrame:
    """(doc_id, tokens); null texts are dropped.

    Cleaning is a column of its own, so it is worked out once however often
    the expression for the tokens refers to it.
    """
    cleaned = documents.filter(F.col("text").isNotNull()).select(
        "doc_id", clean(F.col("text"), profile).alias("cleaned")
    )
    return cleaned.select(
        "doc_id", document_tokens(F.col("cleaned"), profile, stop_words).alias("tokens")
    )


def bag_of_words(tokens: DataFrame) -> DataFrame:
    """(doc_id, length, n_terms, bag of (term, tf)) for each row, no shuffle.

    Each row's words are sorted, the positions where a new word starts are
    kept, and the distance between starts is the count.
    """
    words = tokens.select("doc_id", F.sort_array("tokens").alias("words"))
    runs = words.select(
        "doc_id",
        "words",
        F.array_compact(
            F.transform(
                "words",
                lambda word, i: F.when((i == 0) | (word != F.get("words", i - 1)), i),
            )
        ).alias("starts"),
    )
    return runs.select(
        "doc_id",
        F.size("words").cast("bigint").alias("length"),
        F.size("starts").cast("bigint").alias("n_terms"),
        F.transform(
            "starts",
            lambda start, i: F.struct(
                F.get("words", start).alias("term"),
                (F.coalesce(F.get("starts", i + 1), F.size("words")) - start)
                .cast("bigint")
                .alias("tf"),
            ),
        ).alias("bag"),
    )
