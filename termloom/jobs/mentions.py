"""Most frequent names of several words in text files.

    spark-submit mentions.py BOOKS OUTPUT [--k 10]

BOOKS is a path or pattern of text files. OUTPUT gets the folders mentions, as
Parquet, and lines, as text.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from termloom.operators.chunks import CHUNK_SIZE, OVERLAP
from termloom.operators.mentions import count_mentions, extract_mentions, top_mentions
from termloom.sources.listings import mention_lines
from termloom.sources.readers import read_book


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("books")
    parser.add_argument("output")
    parser.add_argument("--k", type=int, default=10)
    asked = parser.parse_args(arguments)
    chunks = read_book(spark, asked.books, CHUNK_SIZE, OVERLAP)
    top_mentions(count_mentions(extract_mentions(chunks)), asked.k).write.parquet(
        f"{asked.output}/mentions"
    )
    top = spark.read.parquet(f"{asked.output}/mentions").orderBy(F.desc("n"), "mention")
    mention_lines(top).write.text(f"{asked.output}/lines")


if __name__ == "__main__":
    run(SparkSession.builder.appName("termloom mentions").getOrCreate())
