"""Scores of documents for queries, and the best k of them.

Sums are made in fixed point (`termloom.functions.exact`), so a score depends on
nothing but the document and the query: copies of a document tie, however rows are
dealt, and scores that differ are never rounded together before they are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.functions.exact import SHARES
from termloom.functions.weights import document_tf, share_of
from termloom.operators.joins import broadcast_if_small
from termloom.operators.queries import COSINE, SINGLE
from termloom.plans.workspace import Workspace
from termloom.profiles import Profile

# Significant digits of a score that is shown.
SCORE_DIGITS = 9
# Beyond Spark's own group limit: bins of scores in each factor of two, and rows a
# task may be given for each of the k it keeps.
BINS_PER_OCTAVE = 256
ROWS_PER_K = 4
# Matches of documents and query terms that a task adds up; sums of so many fit its memory.
MATCHES_PER_TASK = 2_000_000
SMALLEST_TASK = 50_000


def single_term_scores(matches: DataFrame, profile: Profile) -> DataFrame:
    """(query_id, mode, doc_id, score): the TF-IDF weight of the one term.

    A weight of 0, of a term every document has, is still a hit.
    """
    return matches.select(
        "query_id",
        F.lit(SINGLE).alias("mode"),
        "doc_id",
        _weight(profile).alias("score"),
    )


def cosine_scores(matches: DataFrame, profile: Profile) -> DataFrame:
    """(query_id, mode, doc_id, score) for documents that share a weighted term."""
    return scores_of(add_up(cosine_parts(matches, profile)))


def cosine_part(share: Column, profile: Profile) -> Column:
    """What a posting with this share adds to its document's cosine; it rises with the share."""
    part = share * share_of(F.col("qweight"), F.col("qnorm"))
    return part * F.col("qtf") if profile.repeat_weight else part


def cosine_parts(matches: DataFrame, profile: Profile) -> DataFrame:
    """(query_id, doc_id, digits): the parts of all matches."""
    part = cosine_part(F.col("share"), profile)
    parts = matches.select("query_id", "doc_id", part.alias("part"))
    return parts.select("query_id", "doc_id", *SHARES.digits(F.col("part")))


def add_up(parts: DataFrame) -> DataFrame:
    """Parts, or sums of them, summed for each query and document."""
    return parts.groupBy("query_id", "doc_id").agg(*SHARES.sums())


def sums_by_document(
    postings: DataFrame,
    asked: DataFrame,
    keys: list[str],
    load: int,
    profile: Profile,
    workspace: Workspace,
) -> DataFrame:
    """(query_id, doc_id, digits): sums of cosine parts, each document's made where it lies.

    ``asked`` are terms, or blocks, of queries by ``keys``, few enough to be broadcast,
    and ``load`` is how many postings its rows have in all. A posting is shuffled once,
    to the task of its document, and not once for each query that asks for it; there it
    meets the queries, so their sums are not shuffled at all.
    """
    numbered = workspace.save(
        asked.select(*keys).distinct().withColumn("_number", F.monotonically_increasing_id()), "asked"
    )
    tasks = tasks_for(load, postings.sparkSession)
    dealt = (
        postings.join(F.broadcast(numbered), keys)
        .select("doc_id", "share", "_number")
        .repartition(tasks, "doc_id")
    )
    queries = asked.join(F.broadcast(numbered), keys).select("query_id", "qtf", "qweight", "qnorm", "_number")
    return add_up(cosine_parts(dealt.join(F.broadcast(queries), "_number"), profile))


def tasks_for(load: int, spark: SparkSession) -> int:
    """Tasks that add up so many matches."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-load // MATCHES_PER_TASK), min(cores, load // SMALLEST_TASK))


def dealt_by_document(sums: DataFrame, load: int) -> DataFrame:
    """Sums of at most so many matches, dealt so that a task adds up no more than its part.

    How many tasks follows from the load, and not from the partitions of a shuffle.
    """
    return sums.repartition(tasks_for(load, sums.sparkSession), "query_id", "doc_id")


def scores_of(sums: DataFrame) -> DataFrame:
    """(query_id, mode, doc_id, score) of documents with a cosine above 0."""
    return sums.select(
        "query_id", F.lit(COSINE).alias("mode"), "doc_id", SHARES.value().alias("score")
    ).filter(F.col("score") > 0)


def significant(score: Column, digits: int = SCORE_DIGITS) -> Column:
    """Rounded to so many significant digits; 0 stays 0."""
    shift = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(score)))
    return F.when(score > 0, F.floor(score * shift + 0.5) / shift).otherwise(score)


def top_k(
    scores: DataFrame, k: int, profile: Profile, workspace: Workspace | None = None
) -> DataFrame:
    """(query_id, mode, rank, doc_id, score), ranks from 1, every tie decided.

    Spark keeps k rows per query in each task before it shuffles, as long as k
    is within its group limit. Beyond that rows that can't be among the k are
    dropped first (`select_largest`).
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if k > group_limit(scores.sparkSession):
        scores = select_largest(scores, k, profile, workspace or Workspace(scores.sparkSession))
    in_query = Window.partitionBy("query_id").orderBy(*_order(profile))
    return (
        scores.withColumn("rank", F.row_number().over(in_query))
        .filter(F.col("rank") <= k)
        .select("query_id", "mode", "rank", "doc_id", significant(F.col("score")).alias("score"))
    )


def group_limit(spark: SparkSession) -> int:
    """The largest k for which Spark keeps no more than k rows of a group in each task."""
    return int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def select_largest(
    scores: DataFrame, k: int, profile: Profile, workspace: Workspace
) -> DataFrame:
    """At most ``ROWS_PER_K * k`` rows per query, the best k among them.

    A histogram of each query's scores, with bins that grow with the score, says
    below which bin no row is among the k. Only the bin of the k-th row can hold
    many more, most often ties. As long as a query has too many rows left, they are
    dealt by hash into as many pieces as keep each piece within half that bound,
    and the best k of each piece stay. So a round leaves a query about half its
    rows at most, and no task sorts more than a small multiple of k for one query.
    """
    bins = F.when(
        F.col("score") > 0, F.floor(F.log2("score") * BINS_PER_OCTAVE)
    )
    scores = workspace.save(scores.withColumn("_bin", bins), "scores")
    counted = scores.groupBy("query_id", "_bin").agg(F.count("*").alias("n"))
    above = Window.partitionBy("query_id").orderBy(F.col("_bin").desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Bins before which fewer than k rows stand; scores of 0 come last.
    wanted = (
        counted.withColumn("_before", F.coalesce(F.sum("n").over(above), F.lit(0)))
        .filter(F.col("_before") < k)
        .groupBy("query_id")
        .agg(F.min("_bin").alias("_least"), F.max(F.col("_bin").isNull()).alias("_zeros"))
    )
    kept = (
        scores.join(broadcast_if_small(workspace.save(wanted, "bins"), "query_id"), "query_id")
        .filter(F.when(F.col("_bin").isNull(), F.col("_zeros")).otherwise(F.col("_bin") >= F.col("_least")))
        .drop("_bin", "_least", "_zeros")
    )
    most = ROWS_PER_K * k
    while True:
        kept = workspace.save(kept, "kept")
        sizes = kept.groupBy("query_id").agg(F.count("*").alias("_n"))
        large = sizes.filter(F.col("_n") > most)
        if large.isEmpty():
            return kept
        pieces = large.select(
            "query_id", F.ceil(F.col("_n") / (most // 2)).cast("int").alias("_pieces")
        )
        pieces = broadcast_if_small(pieces, "query_id")
        dealt = kept.join(pieces, "query_id", "left").withColumn(
            "_piece", F.pmod(F.xxhash64("doc_id"), F.coalesce("_pieces", F.lit(1)))
        )
        in_piece = Window.partitionBy("query_id", "_piece").orderBy(*_order(profile))
        kept = (
            dealt.withColumn("_rank", F.row_number().over(in_piece))
            .filter((F.col("_rank") <= k) | F.col("_pieces").isNull())
            .drop("_pieces", "_piece", "_rank")
        )


def _weight(profile: Profile) -> Column:
    return document_tf(profile, F.col("tf"), F.col("length")) * F.col("idf")


def _order(profile: Profile) -> list[Column]:
    order = [F.col("score").desc()]
    if profile.single_ties_by_text_desc:
        text_id = F.when(F.col("mode") == SINGLE, F.col("doc_id").cast("string"))
        order.append(text_id.desc())
    return [*order, F.col("doc_id").asc()]
