"""The best k cosines of every query, without scoring every document.

A block is a tier of a term's postings (`termloom.plans.index`); the most that one
posting of it can add to a query's cosine is known beforehand.

1. Of each query the blocks that can add most are scored, some ``FIRST_PER_K``
   postings for each of the k. The k-th best sum so far is a score that k documents
   reach.
2. The other blocks are put in order from the weakest on. As long as the weakest ones,
   the strongest of each term taken, add up to less than that score, no document that
   is in none but these can be among the k: they are weak. All others are scored.
3. With the k-th best sum of now, documents that could not reach it with all the weak
   blocks could add are dropped. For the rest, and no others, the weak blocks are
   scored.

Sums are in fixed point, so adding them up in parts gives what one sum gives, and
the answers are those of scoring everything. Tables between the steps are written:
each step rests on totals of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.exact import SHARES
from termloom.operators.joins import broadcast_if_small, join_salted, measure
from termloom.operators.scoring import (
    add_up,
    cosine_part,
    cosine_parts,
    dealt_by_document,
    scores_of,
    sums_by_document,
)
from termloom.plans.index import TextIndex
from termloom.plans.workspace import Workspace

FIRST_PER_K = 200
# Bounds are sums of doubles, the scores they are held against are not.
MARGIN = 1 + 1e-9
FIRST, STRONG, WEAK = 0, 1, 2
KEYS = ["bucket", "term", "tier"]


def pruned_cosine_scores(
    index: TextIndex, vectors: DataFrame, k: int, workspace: Workspace
) -> DataFrame:
    """(query_id, mode, doc_id, score): the best k of every query among them, scores whole.

    ``vectors`` are the weighty terms of queries ranked by cosine.
    """
    units = workspace.save(_units(index, vectors, k), "units")
    first = workspace.save(_sums(index, units.filter(F.col("first")), workspace), "first")
    roles = workspace.save(_roles(units, reached(first, k)), "roles")
    strong = _sums(index, roles.filter(F.col("role") == STRONG), workspace)
    load = units.agg(F.sum("n")).first()[0] or 0
    partial = workspace.save(add_up(dealt_by_document(first.unionByName(strong), load)), "partial")
    if roles.filter(F.col("role") == WEAK).isEmpty():
        return scores_of(partial)
    left = workspace.save(candidates(partial, roles, k), "candidates")
    weak = roles.filter(F.col("role") == WEAK)
    unfinished = left.join(weak.select("query_id").distinct(), "query_id", "left_semi")
    if not measure(unfinished, "doc_id").broadcastable:
        # Sums of the weak blocks, made by document, are fewer rows to shuffle than their matches.
        return scores_of(_add_to(left, _sums(index, weak, workspace), load))
    pairs = F.broadcast(unfinished.select(F.col("query_id").alias("_query"), F.col("doc_id").alias("_doc")))
    same = (F.col("query_id") == F.col("_query")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    more = cosine_parts(_matches(index, weak).join(pairs, same, "left_semi"), index.profile)
    return scores_of(add_up(left.unionByName(more)))


def _add_to(sums: DataFrame, more: DataFrame, load: int = 0) -> DataFrame:
    """The sums with what others have for the same query and document."""
    flagged = sums.withColumn("_kept", F.lit(True)).unionByName(more.withColumn("_kept", F.lit(False)))
    return (
        dealt_by_document(flagged, load)
        .groupBy("query_id", "doc_id")
        .agg(*SHARES.sums(), F.max("_kept").alias("_kept"))
        .filter("_kept")
        .drop("_kept")
    )


def reached(sums: DataFrame, k: int) -> DataFrame:
    """(query_id, threshold): the k-th best sum of every query that has so many."""
    scored = sums.select("query_id", SHARES.value().alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc())
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .groupBy("query_id")
        .agg(F.count("*").alias("n"), F.min("score").alias("threshold"))
        .filter(F.col("n") == k)
        .select("query_id", "threshold")
    )


def candidates(partial: DataFrame, roles: DataFrame, k: int) -> DataFrame:
    """Sums of documents that may still be among the k of their query."""
    rest = (
        roles.filter(F.col("role") == WEAK)
        .groupBy("query_id")
        .agg(F.max("below").alias("rest"))
    )
    bounds = rest.join(reached(partial, k), "query_id", "left")
    return (
        partial.join(broadcast_if_small(bounds, "query_id"), "query_id", "left")
        .filter(
            F.col("threshold").isNull()
            | (SHARES.value() + F.col("rest") * MARGIN >= F.col("threshold"))
        )
        .select(*partial.columns)
    )


def _units(index: TextIndex, vectors: DataFrame, k: int) -> DataFrame:
    """Each query's blocks with what they can add, and whether they are among the first."""
    met = index.blocks.join(broadcast_if_small(vectors, "term", "query_id"), ["bucket", "term"])
    most = met.withColumn("most", cosine_part(F.col("top_share"), index.profile))
    best_first = Window.partitionBy("query_id").orderBy(F.col("most").desc(), "term", "tier")
    before = F.coalesce(F.sum("n").over(best_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return most.filter(F.col("most") > 0).withColumn("first", before < FIRST_PER_K * k)


def _roles(units: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The units with their role, and below, which bounds what the blocks up to it add.

    A document has one posting of a term, so of a term only the strongest block counts.
    """
    in_term = Window.partitionBy("query_id", "term").orderBy("most", "tier")
    weakest_first = (
        Window.partitionBy("query_id")
        .orderBy("most", "term", "tier")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    others = units.filter(~F.col("first"))
    rises = others.withColumn("rise", F.col("most") - F.coalesce(F.lag("most").over(in_term), F.lit(0.0)))
    bounded = rises.withColumn("below", F.sum("rise").over(weakest_first)).drop("rise")
    weak = F.col("below") * MARGIN < F.coalesce("threshold", F.lit(0.0))
    return (
        bounded.join(thresholds, "query_id", "left")
        .withColumn("role", F.when(weak, WEAK).otherwise(STRONG))
        .drop("threshold", "first")
    )


def _sums(index: TextIndex, units: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    if not measure(units, "term", "query_id").broadcastable:
        return add_up(cosine_parts(_matches(index, units), index.profile))
    postings = index.postings.select("doc_id", "share", *KEYS)
    load = units.agg(F.sum("n")).first()[0] or 0
    return sums_by_document(postings, units, KEYS, load, index.profile, workspace or Workspace(index.spark))


def _matches(index: TextIndex, units: DataFrame) -> DataFrame:
    """Postings of the blocks, once per query that asks for them."""
    asked = units.select("query_id", *KEYS, "n", "qtf", "qweight", "qnorm")
    postings = index.postings.select("doc_id", "share", *KEYS)
    if measure(asked, "term", "query_id").broadcastable:
        return postings.join(F.broadcast(asked.drop("n")), KEYS)
    wanted = asked.select(*KEYS).distinct()
    if measure(wanted, "term").broadcastable:
        postings = postings.join(F.broadcast(wanted), KEYS, "left_semi")
    return join_salted(postings, asked, KEYS, "doc_id", "n", index.stats.n_postings).drop("n")
