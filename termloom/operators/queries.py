"""Query tables: tokens, modes and weighted vectors for all queries at once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.exact import SQUARES, exact_sum
from termloom.functions.stop_words import ENGLISH
from termloom.functions.text import clean, query_tokens
from termloom.functions.weights import idf
from termloom.operators.rows import explode_computed
from termloom.profiles import Profile

SINGLE = "single"
COSINE = "cosine"
NO_TERMS = "none"


def tokenize_queries(
    queries: DataFrame, profile: Profile, stop_words: Iterable[str] = ENGLISH
) -> DataFrame:
    """(query_id, tokens, n_tokens, mode).

    The mode goes by the number of tokens after stop words, repeats included.
    """
    cleaned = queries.select("query_id", clean(F.col("query_raw"), profile).alias("cleaned"))
    tokens = cleaned.select(
        "query_id", query_tokens(F.col("cleaned"), profile, stop_words).alias("tokens")
    )
    n_tokens = F.size("tokens")
    return tokens.select(
        "query_id",
        "tokens",
        n_tokens.alias("n_tokens"),
        F.when(n_tokens == 1, SINGLE)
        .when(n_tokens > 1, COSINE)
        .otherwise(NO_TERMS)
        .alias("mode"),
    )


def query_terms(tokenized: DataFrame) -> DataFrame:
    """(query_id, mode, term, qtf): empty tokens are no query terms."""
    return (
        explode_computed(tokenized, ["query_id", "mode"], "tokens", "term")
        .filter(F.col("term") != "")
        .groupBy("query_id", "mode", "term")
        .agg(F.count("*").alias("qtf"))
    )


def weigh_query_terms(
    terms: DataFrame, known: DataFrame, profile: Profile, n_docs: int
) -> DataFrame:
    """(query_id, mode, term, qtf, df, idf, qweight, qnorm).

    ``known`` holds (term, df) for the query terms the corpus has. A term it
    lacks is dropped, or kept with df = 0, as the profile says.
    """
    if profile.keep_unknown_terms:
        found = terms.join(known.select("term", "df"), "term", "left")
    else:
        found = terms.join(known.select("term", "df"), "term")
    df = F.coalesce("df", F.lit(0))
    weighted = found.select(
        "query_id",
        "mode",
        "term",
        "qtf",
        df.alias("df"),
        idf(profile, F.lit(n_docs), df).alias("idf"),
    ).withColumn("qweight", F.col("qtf") * F.col("idf"))
    squares = exact_sum(weighted, ["query_id"], F.col("qweight") * F.col("qweight"), "squares", SQUARES)
    norms = squares.select("query_id", F.sqrt("squares").alias("qnorm"))
    return weighted.join(norms, "query_id").select(
        "query_id", "mode", "term", "qtf", "df", "idf", "qweight", "qnorm"
    )
