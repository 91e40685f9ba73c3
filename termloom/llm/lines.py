"""Lines that many documents share, dropped from all of them but one.

A line's key is the line without the white space around it, A to Z in lower
case. Keys of at least ``min_chars`` characters are hashed to 128 bits; the
documents of each hash are counted, with sums made before the shuffle, so a line
that is in every document is one row of each task. A hash of at least
``min_docs`` documents is dropped from all but the one with the largest id.

The decisions meet the lines by hash: hot hashes are broadcast, at most half a
million, the others shuffled (`join_by_load`). What a text loses are positions,
collected per text, and no more than that text has; it is then put together from
the positions that are left. Lines travel as hashes. Texts are shuffled at most
once, and not at all while all positions to drop come to less than a broadcast
may hold. Everything on the way is built-in functions.

A null text is an empty one: one empty line. An empty table gives no row. Rows
with one id are one document, and rows without an id are one document as well,
smaller than any other; so a line can stay in several rows of the largest id, and
never stays in a row without one unless under ``min_docs`` documents have it.
Every row gives one row. Two different lines with one hash would be taken for
one; among 10^12 lines the chance of that is 10^-15.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.frequency import has_unique_ids
from termloom.operators.joins import BROADCAST_KEY_BYTES, BROADCAST_ROWS, Size, join_by_load
from termloom.operators.rows import explode_computed
from termloom.plans.workspace import Workspace

# The shortest key, and the fewest documents, that are looked at.
MIN_CHARS = 20
MIN_DOCS = 3
SPACES = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Bytes of a row of (doc_id, text hashes, positions) beside the positions.
ROW_BYTES = 64


def drop_repeated_lines(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): texts without the lines they lose.

    ``n_lines`` counts the lines before any is dropped.
    """
    workspace = workspace or Workspace(documents.sparkSession)
    texts = _texts(documents)
    lines = workspace.save(hashed_lines(texts, min_chars), "lines")
    repeated = workspace.save(
        document_counts(lines, has_unique_ids(documents)).filter(F.col("n_docs") >= min_docs), "repeated"
    )
    return _without(texts, lost_positions(lines, repeated, workspace))


def hashed_lines(texts: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_hash, position, line_hash, first): the lines that are long enough.

    ``first`` is 1 for the first line of a text with its hash. Equal lines of a
    text are found by sorting its hashes.
    """
    keys = texts.select(
        "doc_id", "text_hash", F.transform(F.split("text", "\n"), _key).alias("keys")
    )
    hashes = F.transform("keys", lambda key: F.when(F.length(key) >= min_chars, _hash(key)))
    placed = keys.select(
        "doc_id",
        "text_hash",
        F.sort_array(
            F.filter(
                F.transform(hashes, lambda hash_, i: F.struct(hash_.alias("hash"), i.alias("at"))),
                lambda line: line["hash"].isNotNull(),
            )
        ).alias("lines"),
    )
    marked = F.transform(
        "lines",
        lambda line, i: F.struct(
            line["at"].alias("position"),
            line["hash"].alias("line_hash"),
            F.when((i > 0) & (F.get("lines", i - 1)["hash"] == line["hash"]), 0).otherwise(1).alias("first"),
        ),
    )
    return explode_computed(placed, ["doc_id", "text_hash"], marked, "line").select(
        "doc_id", "text_hash", "line.*"
    )


def document_counts(lines: DataFrame, unique_ids: bool) -> DataFrame:
    """(line_hash, n_docs, n_lines, keeper): documents, lines and the largest id of each hash."""
    hash_ = [F.col("line_hash.a").alias("a"), F.col("line_hash.b").alias("b")]
    if unique_ids:
        counted = lines.select("doc_id", "first", *hash_, F.lit(1).alias("lines"))
    else:
        # Rows of one id are merged first; the pair is the key, so neither is hot.
        counted = (
            lines.groupBy("doc_id", *hash_)
            .agg(F.count("*").alias("lines"))
            .withColumn("first", F.lit(1))
        )
    return (
        counted.groupBy("a", "b")
        .agg(
            F.sum("first").alias("n_docs"),
            F.sum("lines").alias("n_lines"),
            F.max("doc_id").alias("keeper"),
        )
        .select(F.struct("a", "b").alias("line_hash"), "n_docs", "n_lines", "keeper")
    )


def lost_positions(lines: DataFrame, repeated: DataFrame, workspace: Workspace) -> DataFrame:
    """(doc_id, text_hash, lost): the positions each text loses, if any.

    Broadcast if measured to be small enough.
    """
    total = repeated.agg(F.count("*").alias("rows"), F.sum("n_lines").alias("lines")).first()
    met = join_by_load(
        lines.select("doc_id", "text_hash", "position", "line_hash"),
        repeated.select("line_hash", "n_lines", "keeper"),
        "line_hash",
        "n_lines",
        total["lines"] or 0,
        Size(total["rows"], total["rows"] * ROW_BYTES),
    )
    lost = workspace.save(
        met.filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("position").alias("lost")),
        "lost",
    )
    size = lost.agg(F.count("*").alias("rows"), F.sum(F.size("lost")).alias("positions")).first()
    held = size["rows"] * ROW_BYTES + 4 * (size["positions"] or 0)
    small = size["rows"] <= BROADCAST_ROWS and held <= BROADCAST_KEY_BYTES
    return F.broadcast(lost) if small else lost


def _without(texts: DataFrame, lost: DataFrame) -> DataFrame:
    lost = lost.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "lost")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    lines = texts.join(lost, same, "left").select(
        "doc_id", "text", "lost", F.split("text", "\n").alias("lines")
    )
    n_lines = F.size("lines")
    left = F.array_except(F.sequence(F.lit(0), n_lines - 1), "lost")
    kept = F.array_join(F.transform(left, lambda position: F.get("lines", position)), "\n")
    return lines.select(
        "doc_id",
        F.when(F.col("lost").isNull(), F.col("text")).otherwise(kept).alias("text"),
        n_lines.cast("bigint").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def _texts(documents: DataFrame) -> DataFrame:
    """(doc_id, text, text_hash): rows are told apart by id and text, as ids may repeat."""
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.select("doc_id", "text", _hash(F.col("text")).alias("text_hash"))


def _key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(SPACES))
    # Lower case is the same thing, and faster, where there are no other letters.
    plain = F.octet_length(bare) == F.length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _hash(text: Column) -> Column:
    """128 bits; the seed comes first, since it would otherwise mix two equal halves."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
