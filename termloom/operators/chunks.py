"""Cutting texts into pieces of a fixed number of characters.

With an overlap a chunk comes with so many characters of the text on either side
of it, in columns of their own: before, chunk, after. Chunks themselves never
overlap, so what belongs to a chunk is told from what it is only seen with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.text import text_chunks
from termloom.operators.rows import explode_computed

# Fixed value: characters per chunk.
CHUNK_SIZE = 10_000
# Characters around a chunk that are enough for names.
OVERLAP = 1_000
# Lines of a read block that are added up in one task.
RUN_BITS = 17
RUN_LINES = 1 << RUN_BITS
# What a part of a line is to a chunk.
BEFORE, OWN, AFTER = 0, 1, 2


def chunk_texts(
    documents: DataFrame, size: int | None = CHUNK_SIZE, overlap: int = 0
) -> DataFrame:
    """(doc_id, chunk_id, chunk) for texts held in a column, line ends as spaces.

    Without a size a text is one chunk. With an overlap also before and after.

    A line end at the very end of a text goes, as it does when a file is read
    by lines.
    """
    lines = F.regexp_replace(F.regexp_replace("text", r"(\r\n|\n|\r)\z", ""), r"\r\n|\n|\r", " ")
    joined = documents.filter(F.col("text").isNotNull()).select("doc_id", lines.alias("text"))
    _check_overlap(overlap, size)
    if size is None:
        return joined.select("doc_id", F.lit(0).alias("chunk_id"), F.col("text").alias("chunk"))
    pieces = text_chunks(F.col("text"), size)
    if not overlap:
        return explode_computed(joined, ["doc_id"], pieces, "chunk", position="chunk_id")
    cut = joined.select("doc_id", pieces.alias("pieces"))

    def surrounded(piece, i):
        return F.struct(
            F.coalesce(F.right(F.get("pieces", i - 1), F.lit(overlap)), F.lit("")).alias("before"),
            piece.alias("chunk"),
            F.coalesce(F.left(F.get("pieces", i + 1), F.lit(overlap)), F.lit("")).alias("after"),
        )

    windows = F.transform("pieces", surrounded)
    return explode_computed(cut, ["doc_id"], windows, "window", position="chunk_id").select(
        "doc_id", "chunk_id", "window.chunk", "window.before", "window.after"
    )


def _check_overlap(overlap: int, size: int | None) -> None:
    if overlap < 0 or (size is not None and overlap > size):
        raise ValueError("overlap must be from 0 to size")


def chunk_lines(lines: DataFrame, size: int = CHUNK_SIZE, overlap: int = 0) -> DataFrame:
    """(path, chunk_id, chunk) for files of any size, lines joined by a space.

    With an overlap also before and after.

    Takes (path, block, seq, value) of `termloom.sources.readers.file_lines`, and
    ``book`` as well if several files, in the order of their paths, are one text;
    then that takes the place of the path.
    Every line learns its position in the joined text from running totals, is
    cut where chunks end, and the pieces of a chunk meet by its number. Only the
    read itself takes a file that can't be split in one task.
    """
    _check_overlap(overlap, size)
    placed = running_total(lines, F.length("value") + 1, "start", by_file=True)
    text_end = F.col("total") - 1
    piece = F.when(F.col("start") + F.length("value") >= text_end, F.col("value")).otherwise(
        F.concat("value", F.lit(" "))
    )
    book = "book" if "book" in lines.columns else "path"
    pieces = placed.select(
        F.col(book).alias("path"), "start", piece.alias("piece")
    ).filter(F.length("piece") > 0)
    # What still fits the chunk a line begins in, and the rest, each cut once.
    room = (size - F.col("start") % size).cast("int")
    cut = F.concat(
        F.array(F.left("piece", room)), text_chunks(F.substr("piece", room + 1), size)
    )
    parts = explode_computed(pieces, ["path", "start"], cut, "part", position="k").select(
        "path",
        (F.floor(F.col("start") / size) + F.col("k")).cast("int").alias("chunk_id"),
        F.col("start").alias("at"),
        "part",
    )
    if overlap:
        parts = _with_neighbours(parts, size, overlap)
    else:
        parts = parts.withColumn("role", F.lit(OWN))

    def text_of(role: int) -> Column:
        held = F.collect_list(F.when(F.col("role") == role, F.struct("at", "part")))
        return F.array_join(F.sort_array(held)["part"], "")

    roles = {"chunk": OWN, "before": BEFORE, "after": AFTER}
    names = list(roles) if overlap else ["chunk"]
    # Nothing comes after the last chunk, though its end is offered to one.
    return (
        parts.groupBy("path", "chunk_id")
        .agg(*[text_of(roles[name]).alias(name) for name in names])
        .filter(F.col("chunk") != "")
    )


def _with_neighbours(parts: DataFrame, size: int, overlap: int) -> DataFrame:
    """Parts once as what they are, and what lies near a chunk's end once more for the next chunk."""
    # Where in its chunk a part begins; a line that began in an earlier chunk begins at 0.
    offset = F.greatest(F.col("at") - F.col("chunk_id").cast("bigint") * size, F.lit(0)).cast("int")
    placed = parts.withColumn("_offset", offset)
    offset, length = F.col("_offset"), F.length("part")

    def entry(role: int, chunk: Column, part: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), chunk.alias("chunk_id"), part.alias("part"))

    chunk = F.col("chunk_id")
    end = size - overlap
    entries = F.array_compact(
        F.array(
            entry(OWN, chunk, F.col("part")),
            F.when(
                (offset < overlap) & (chunk > 0),
                entry(AFTER, chunk - 1, F.left("part", F.lit(overlap) - offset)),
            ),
            F.when(
                offset + length > end,
                entry(
                    BEFORE, chunk + 1, F.right("part", offset + length - F.greatest(offset, F.lit(end)))
                ),
            ),
        )
    )
    return placed.select("path", "at", F.explode(entries).alias("entry")).select(
        "path", "at", "entry.role", "entry.chunk_id", "entry.part"
    )


def running_total(lines: DataFrame, amount, name: str, by_file: bool) -> DataFrame:
    """Lines with the sum of ``amount`` over all lines before them.

    Lines were numbered while they were read, so a read block, which may be a
    whole compressed file, falls into runs of at most ``RUN_LINES`` lines. Totals
    of runs are added up first; there is one row per run, so that step is small.
    Within a run lines are added up in order. With ``by_file`` the sum starts over
    in each file, or book, and ``total`` is the book's.
    """
    book = ["book"] if "book" in lines.columns else ["path"]
    run = list(dict.fromkeys([*book, "path", "block", "_run"]))
    lines = lines.withColumn("_amount", amount.cast("bigint")).withColumn(
        "_run", F.shiftright("seq", RUN_BITS)
    )
    runs = lines.groupBy(*run).agg(F.sum("_amount").alias("_run_total"))
    files = Window.partitionBy(*book) if by_file else Window.partitionBy()
    before = files.orderBy(*run).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *run,
        F.coalesce(F.sum("_run_total").over(before), F.lit(0)).alias("_base"),
        F.sum("_run_total").over(files).alias("total"),
    )
    in_run = Window.partitionBy(*run).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        lines.withColumn("_inner", F.coalesce(F.sum("_amount").over(in_run), F.lit(0)))
        .join(runs, run)
        .withColumn(name, F.col("_base") + F.col("_inner"))
        .drop("_amount", "_inner", "_base", "_run")
    )
