"""Results as lines of text, ready for ``write.text``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.operators.queries import SINGLE

# Decimals of a listed score, width of a listed name.
SCORE_DECIMALS = 4
MENTION_WIDTH = 30


def hit_lines(hits: DataFrame) -> DataFrame:
    """(query_id, rank, line): rank, title and score.

    The score is rounded before it is printed, since printers differ at halves.
    """
    unit = 10.0**SCORE_DECIMALS
    score = F.floor(F.col("score") * unit + 0.5) / unit
    line = F.format_string(f"%d. %s (%.{SCORE_DECIMALS}f)", "rank", "title", score)
    return hits.select("query_id", "rank", line.alias("line"))


def query_headings(tokenized: DataFrame) -> DataFrame:
    """(query_id, heading): a single term in capitals, more terms in a row."""
    heading = F.when(F.col("mode") == SINGLE, F.upper(F.element_at("tokens", 1))).otherwise(
        F.array_join("tokens", " ")
    )
    return tokenized.select("query_id", heading.alias("heading"))


def mention_lines(counts: DataFrame) -> DataFrame:
    """(line): the name, padded, and its count; long names stay whole."""
    padded = F.when(
        F.length("mention") < MENTION_WIDTH, F.rpad("mention", MENTION_WIDTH, " ")
    ).otherwise(F.col("mention"))
    return counts.select(F.concat(padded, F.lit(" | "), F.col("n").cast("string")).alias("line"))
