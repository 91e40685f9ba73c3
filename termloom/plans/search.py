"""Search: a whole table of queries in one job, or one term."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.weights import document_tf
from termloom.operators.joins import Size, broadcast_if_small, join_salted, measure
from termloom.operators.queries import (
    COSINE,
    NO_TERMS,
    SINGLE,
    query_terms,
    tokenize_queries,
    weigh_query_terms,
)
from termloom.operators.scoring import (
    cosine_parts,
    cosine_scores,
    group_limit,
    scores_of,
    single_term_scores,
    sums_by_document,
    top_k,
)
from termloom.operators.titles import with_titles
from termloom.plans.index import TextIndex
from termloom.plans.pruning import pruned_cosine_scores
from termloom.plans.workspace import Workspace

# Postings of a batch's cosine terms that are scored in one pass, without pruning. One
# pass shuffles a posting once for all queries, passes in turn shuffle sums of each.
ONE_PASS = 5_000_000_000
# Query terms that become part of a filter.
LITERAL_ROWS = 200
LITERAL_BYTES = 64 * 1024
TERM_KEYS = ["bucket", "term"]
TIER_KEYS = [*TERM_KEYS, "tier"]


@dataclass(frozen=True)
class SearchResult:
    # (query_id, mode, rank, doc_id, score[, title])
    hits: DataFrame
    # (query_id, mode, status, n_hits): one row per query
    status: DataFrame


def query_vectors(
    index: TextIndex,
    queries: DataFrame,
    workspace: Workspace | None = None,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """Weighted terms of all queries, written so that their size is known.

    Without ``stop_words`` of its own a search uses the list the index was
    built with.
    """
    workspace = workspace or Workspace(index.spark)
    stop_words = index.stats.stop_words if stop_words is None else stop_words
    tokenized = tokenize_queries(queries, index.profile, stop_words)
    terms = workspace.save(
        query_terms(tokenized).withColumn("bucket", index.bucket_of(F.col("term"))),
        "query-terms",
    )
    size = measure(terms, "term", "query_id")
    literals = literal_terms(terms, size)
    if literals is not None:
        known = only_terms(index.terms, literals)
    else:
        # The filter is what lets Spark prune the buckets of the term table.
        wanted = terms.filter(F.col("qtf") > 0).select("bucket", "term").distinct()
        wanted = F.broadcast(wanted) if size.broadcastable else wanted
        known = index.terms.join(wanted, ["bucket", "term"], "left_semi")
    vectors = weigh_query_terms(terms, known, index.profile, index.stats.n_docs)
    return workspace.save(
        vectors.withColumn("bucket", index.bucket_of(F.col("term"))), "query-vectors"
    )


def search_vectors(
    index: TextIndex,
    vectors: DataFrame,
    k: int = 10,
    workspace: Workspace | None = None,
    prune: bool | None = None,
) -> DataFrame:
    """The best k hits of every query: (query_id, mode, rank, doc_id, score).

    Queries with the same vector are scored once. Single-term queries, and others
    with one term that weighs anything, need the postings of their terms and nothing
    else, the latter only those of the term's best tiers; the rest add up shared terms
    by document. Where those have more than
    ``ONE_PASS`` postings in all, or with ``prune``, documents that can't be among
    the k are left out (`termloom.plans.pruning`); the hits are the same.
    """
    workspace = workspace or Workspace(index.spark)
    vectors, twins = distinct_queries(vectors, workspace)
    size = measure(vectors, "term", "query_id")
    literals = literal_terms(vectors, size)
    single = _matches(index, vectors.filter(F.col("mode") == SINGLE), size, literals)
    # A term that every document has weighs nothing, and its postings are not read.
    weighty = vectors.filter((F.col("mode") == COSINE) & (F.col("qweight") > 0) & (F.col("df") > 0))
    of_query = Window.partitionBy("query_id")
    counted = workspace.save(weighty.withColumn("_terms", F.count("*").over(of_query)), "weighty")
    alone = counted.filter("_terms = 1").drop("_terms")
    several = counted.filter("_terms > 1").drop("_terms")
    load = several.agg(F.sum("df")).first()[0] or 0
    if prune is None:
        prune = load > ONE_PASS and k <= group_limit(index.spark)
    if prune:
        cosines = pruned_cosine_scores(index, several, k, workspace)
    elif size.broadcastable:
        postings = index.postings if literals is None else only_terms(index.postings, literals)
        cosines = scores_of(
            sums_by_document(postings, several, ["bucket", "term"], load, index.profile, workspace)
        )
    else:
        cosines = cosine_scores(_matches(index, several, size, literals), index.profile)
    # A document has one posting of a term, so here there is nothing to add up.
    best = workspace.save(best_tiers(index, alone, k, size), "best-tiers")
    single_parts = scores_of(
        cosine_parts(_matches(index, best, measure(best, "term", "query_id"), literals, TIER_KEYS), index.profile)
    )
    scores = single_term_scores(single, index.profile).unionByName(cosines).unionByName(single_parts)
    hits = top_k(scores, k, index.profile, workspace)
    return hits if twins is None else _to_twins(hits, twins)


def best_tiers(index: TextIndex, alone: DataFrame, k: int, size: Size) -> DataFrame:
    """The queries' rows for each tier of their one term that the k best can lie in.

    A cosine of one term rises with the share. A posting two tiers further down has less
    than half the share of any above, so it is not even rounded to the same score: where
    those tiers hold k postings, it is not among the k.
    """
    asked = F.broadcast(alone) if size.broadcastable else alone
    met = index.blocks.select("bucket", "term", "tier", "n").join(asked, ["bucket", "term"])
    above = Window.partitionBy("query_id").orderBy("tier").rangeBetween(Window.unboundedPreceding, -2)
    better = F.coalesce(F.sum("n").over(above), F.lit(0))
    # The load of a row is that of its tier from here on.
    return met.withColumn("_better", better).filter(F.col("_better") < k).drop("_better", "df").withColumnRenamed("n", "df")


def distinct_queries(
    vectors: DataFrame, workspace: Workspace
) -> tuple[DataFrame, DataFrame | None]:
    """The vectors of one query of all that are alike, and (query_id, _first) of all queries.

    The second is None where no two queries are alike, and the vectors are as given then.
    """
    entry = F.struct(*[name for name in vectors.columns if name != "query_id"])
    signed = vectors.groupBy("query_id").agg(F.sort_array(F.collect_list(entry)).alias("_vector"))
    firsts = signed.groupBy("_vector").agg(F.min("query_id").alias("_first"))
    twins = workspace.save(
        signed.join(firsts, "_vector").select("query_id", "_first"), "twins"
    )
    is_first = F.col("query_id").eqNullSafe(F.col("_first"))
    if twins.filter(~is_first).isEmpty():
        return vectors, None
    firsts = broadcast_if_small(
        twins.filter(is_first).select(F.col("query_id").alias("_first")), "_first"
    )
    return workspace.save(vectors.join(firsts, is_first, "left_semi"), "distinct-vectors"), twins


def _to_twins(hits: DataFrame, twins: DataFrame) -> DataFrame:
    """The hits of each first query, for every query like it."""
    found = hits.withColumnRenamed("query_id", "_scored")
    twins = broadcast_if_small(twins, "query_id", "_first")
    return found.join(twins, F.col("_scored").eqNullSafe(F.col("_first"))).select(*hits.columns)


def search(
    index: TextIndex,
    queries: DataFrame,
    k: int = 10,
    titles: DataFrame | None = None,
    default_title: str | None = None,
    keep_title: str = "least",
    workspace: Workspace | None = None,
    stop_words: Iterable[str] | None = None,
) -> SearchResult:
    """Answer (query_id, query_raw): one token ranks by TF-IDF, more by cosine."""
    workspace = workspace or Workspace(index.spark)
    vectors = query_vectors(index, queries, workspace, stop_words)
    hits = workspace.save(search_vectors(index, vectors, k, workspace), "hits")
    status = query_status(index, queries, vectors, hits, stop_words)
    if titles is not None:
        hits = with_titles(hits, titles, default_title or index.profile.default_title, keep_title)
    return SearchResult(hits, status)


def query_status(
    index: TextIndex,
    queries: DataFrame,
    vectors: DataFrame,
    hits: DataFrame,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """What became of each query, and how many hits it has."""
    stop_words = index.stats.stop_words if stop_words is None else stop_words
    tokenized = tokenize_queries(queries, index.profile, stop_words)
    known = vectors.groupBy("query_id").agg(F.count("*").alias("n_known"))
    found = hits.groupBy("query_id").agg(F.count("*").alias("n_hits"))
    n_known = F.coalesce("n_known", F.lit(0))
    n_hits = F.coalesce("n_hits", F.lit(0))
    if index.profile.keep_unknown_terms:
        status = (
            F.when(F.col("mode") == NO_TERMS, "no searchable terms")
            .when(n_hits == 0, "no hits")
            .otherwise("ok")
        )
    else:
        only_empty = (F.col("mode") == SINGLE) & (F.element_at("tokens", 1) == "")
        status = (
            F.when(F.col("mode") == NO_TERMS, "ignored")
            .when(only_empty, "skipped")
            .when((F.col("mode") == SINGLE) & (n_hits == 0), "no documents")
            .when((F.col("mode") == COSINE) & (n_known == 0), "terms not found in corpus")
            .when(n_hits == 0, "no similar documents")
            .otherwise("ok")
        )
    return (
        tokenized.join(known, "query_id", "left")
        .join(found, "query_id", "left")
        .select("query_id", "mode", status.alias("status"), n_hits.alias("n_hits"))
    )


def search_term(index: TextIndex, term: str, k: int = 10) -> DataFrame:
    """(rank, doc_id, score) for one token as it stands in the index.

    The term is a literal here, so the bucket is pruned when the query is
    planned and the term filter reaches the row groups.
    """
    here = (F.col("bucket") == index.bucket_of(F.lit(term))) & (F.col("term") == term)
    # At most one row: terms are unique.
    of_term = F.broadcast(index.terms.filter(here).select("term", "idf"))
    weight = document_tf(index.profile, F.col("tf"), F.col("length")) * F.col("idf")
    scores = (
        index.postings.filter(here)
        .join(of_term, "term")
        .select(
            F.lit(0).alias("query_id"),
            F.lit(SINGLE).alias("mode"),
            "doc_id",
            weight.alias("score"),
        )
    )
    return top_k(scores, k, index.profile).select("rank", "doc_id", "score")


def literal_terms(asked: DataFrame, size: Size) -> list[tuple[int, str]] | None:
    """The (bucket, term) pairs asked for if they are few enough to be written into a filter."""
    if size.rows > LITERAL_ROWS or size.key_bytes > LITERAL_BYTES:
        return None
    return sorted({(row.bucket, row.term) for row in asked.select("bucket", "term").collect()})


def only_terms(table: DataFrame, literals: list[tuple[int, str]]) -> DataFrame:
    """Rows of these terms, by filters that prune folders, files and pages when planned.

    Spark hands lists to Parquet whole up to ten values, and as a range beyond.
    """
    buckets = sorted({bucket for bucket, _ in literals})
    terms = [term for _, term in literals]
    here = F.lit(False)
    for start in range(0, len(terms), 10):
        here = here | F.col("term").isin(terms[start : start + 10])
    return table.filter(F.col("bucket").isin(buckets) & here)


def _matches(
    index: TextIndex,
    vectors: DataFrame,
    size: Size,
    literals: list[tuple[int, str]] | None = None,
    keys: list[str] = TERM_KEYS,
) -> DataFrame:
    """Postings of the query terms, or of tiers, once per query that asks for the term.

    Query sets too large to broadcast often ask for few distinct terms; then
    only the postings of those are read and shuffled.
    """
    postings = index.postings if literals is None else only_terms(index.postings, literals)
    if size.broadcastable:
        return postings.join(F.broadcast(vectors), keys)
    wanted = vectors.filter(F.col("qtf") > 0).select(*keys).distinct()
    if measure(wanted, "term").broadcastable:
        postings = postings.join(F.broadcast(wanted), keys, "left_semi")
    return join_salted(postings, vectors, keys, "doc_id", "df", index.stats.n_postings)
