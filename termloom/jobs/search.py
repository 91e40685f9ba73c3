"""Search a corpus for a file of queries.

    spark-submit search.py CORPUS TITLES QUERIES OUTPUT [--profile smoothed] [--k 10] [--index PATH]

CORPUS and TITLES are tab-separated, QUERIES has one query a line. OUTPUT gets
the folders hits and status, as Parquet, and lines, as text. With --index the
index is kept there, or used if it is there already.
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from termloom.plans.index import build_index, load_index
from termloom.plans.search import search
from termloom.plans.workspace import Workspace
from termloom.profiles import NORMALIZED, SMOOTHED
from termloom.sources.listings import hit_lines
from termloom.sources.readers import read_corpus_tsv, read_queries, read_titles_lines


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("corpus")
    parser.add_argument("titles")
    parser.add_argument("queries")
    parser.add_argument("output")
    parser.add_argument("--profile", choices=["normalized", "smoothed"], default="normalized")
    parser.add_argument("--k", type=int, default=10)
    parser.add_argument("--index")
    asked = parser.parse_args(arguments)
    profile = {"normalized": NORMALIZED, "smoothed": SMOOTHED}[asked.profile]
    with Workspace(spark) as workspace:
        index = _index(spark, asked.index, asked.corpus, profile, workspace)
        titles = read_titles_lines(spark, asked.titles, missing_ok=True, places=True)
        queries = read_queries(spark, asked.queries)
        result = search(
            index, queries, asked.k, titles=titles, keep_title="last", workspace=workspace
        )
        result.hits.write.parquet(f"{asked.output}/hits")
        result.status.write.parquet(f"{asked.output}/status")
        hits = spark.read.parquet(f"{asked.output}/hits")
        lines = hit_lines(hits).orderBy("query_id", "rank").select("line")
        lines.write.text(f"{asked.output}/lines")


def _index(spark: SparkSession, path: str | None, corpus: str, profile, workspace: Workspace):
    if path is not None:
        try:
            return load_index(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return build_index(read_corpus_tsv(spark, corpus), profile, path or workspace.path("index"))


if __name__ == "__main__":
    run(SparkSession.builder.appName("termloom search").getOrCreate())
