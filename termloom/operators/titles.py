"""Titles for hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_title_per_id(titles: DataFrame, keep: str = "least") -> DataFrame:
    """(doc_id, title): one title of each id, so a join adds no rows.

    ``least`` keeps the smallest. ``last`` keeps the one that stands last in
    its file, of several files the last by name; it needs the columns path,
    block and seq, which `read_titles_lines` gives with ``places=True``.
    """
    if keep == "least":
        return titles.groupBy("doc_id").agg(F.min("title").alias("title"))
    if keep != "last":
        raise ValueError("keep must be 'least' or 'last'")
    # Within the struct a null title is a value, so a last null stays.
    at = F.struct("path", "block", "seq")
    last = F.max_by(F.struct("title"), at)
    return titles.groupBy("doc_id").agg(last.alias("_last")).select("doc_id", "_last.title")


def with_titles(
    hits: DataFrame, titles: DataFrame, default_title: str, keep: str = "least"
) -> DataFrame:
    """Hits with a title column.

    A hit whose id is not among the titles gets the default; an id that is
    there with a null title keeps the null. Titles no hit asks for are dropped
    before anything is grouped. ``hits`` should be a written table: it is read
    twice.
    """
    wanted = titles.join(hits.select("doc_id"), "doc_id", "left_semi")
    found = one_title_per_id(wanted, keep).withColumn("found", F.lit(True))
    return (
        hits.join(found, "doc_id", "left")
        .withColumn("title", F.when(F.col("found"), F.col("title")).otherwise(default_title))
        .drop("found")
    )
