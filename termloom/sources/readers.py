"""Readers; every text read has an explicit schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators.chunks import chunk_lines, running_total
from termloom.operators.corpus import corpus
from termloom.operators.rows import explode_computed

TITLES_SCHEMA = "doc_id string, title string"
PLACES_SCHEMA = ", path string, block bigint, seq bigint"
QUERIES_SCHEMA = "query_id bigint, query_raw string"
# Fixed value: the number of columns of a title file.
TITLE_COLUMNS = 9


def read_corpus_tsv(spark: SparkSession, path: str, quote: str = "") -> DataFrame:
    """(doc_id, text) from a headerless tab-separated file; rows without text go.

    Quote characters are text unless ``quote`` names one. Columns beyond the
    second are ignored.
    """
    return corpus(_read_tsv(spark, path, "doc_id string, text string", quote))


def read_corpus_table(
    spark: SparkSession,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """(doc_id, text) from Parquet, ids in the type they have.

    With ``partitions`` the rows are dealt out over so many: a file splits no
    further than its row groups, and a few large ones keep cores idle while
    text is tokenised. That shuffles the texts, so it is for small inputs; a table
    of as many files is read as it lies.
    """
    read = spark.read.parquet(path)
    table = corpus(read, doc_id, text)
    if partitions is None or len(read.inputFiles()) >= partitions:
        return table
    return table.repartition(partitions)


def read_titles_tsv(
    spark: SparkSession, path: str, quote: str = "", missing_ok: bool = False
) -> DataFrame:
    """(doc_id, title) from columns 1 and 3; a short row has a null title."""
    names = ", ".join(f"c{i} string" for i in range(TITLE_COLUMNS))
    return _or_empty(
        spark,
        lambda: _read_tsv(spark, path, names, quote).select(
            F.col("c0").alias("doc_id"), F.col("c2").alias("title")
        ),
        TITLES_SCHEMA,
        missing_ok,
    )


def read_titles_lines(
    spark: SparkSession, path: str, missing_ok: bool = False, places: bool = False
) -> DataFrame:
    """(doc_id, title) from lines cut at tabs; lines of under 3 fields go.

    With ``places`` also where each line stands: path, block, seq.
    """
    schema = TITLES_SCHEMA + (PLACES_SCHEMA if places else "")
    read = file_lines if places else lambda spark, path: spark.read.text(path)
    return _or_empty(spark, lambda: title_fields(read(spark, path)), schema, missing_ok)


def title_fields(lines: DataFrame) -> DataFrame:
    fields = F.split("value", "\t")
    return lines.filter(F.size(fields) > 2).select(
        F.get(fields, 0).alias("doc_id"),
        F.get(fields, 2).alias("title"),
        *[name for name in lines.columns if name != "value"],
    )


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, seq, value): lines and where they stand in their file.

    ``block`` is the offset of the read block, ``seq`` rises within it.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def is_query_line(line):
    """Neither blank nor a comment."""
    text = _strip(line)
    return (text != "") & ~text.startswith("#")


def read_queries(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """(query_id, query_raw), numbered from 1 over the kept lines in file order."""

    def read() -> DataFrame:
        kept = file_lines(spark, path).filter(is_query_line(F.col("value")))
        return running_total(kept, F.lit(1), "before", by_file=False).select(
            (F.col("before") + 1).alias("query_id"), _strip(F.col("value")).alias("query_raw")
        )

    return _or_empty(spark, read, QUERIES_SCHEMA, missing_ok)


def query_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, query_id, query_raw): the lines of each text read as a query file."""
    lines = F.split("text", r"\r\n|\n|\r")
    kept = F.filter(F.transform(lines, _strip), lambda line: (line != "") & ~line.startswith("#"))
    return explode_computed(documents, ["doc_id"], kept, "query_raw", position="position").select(
        "doc_id", (F.col("position") + 1).cast("bigint").alias("query_id"), "query_raw"
    )


def read_book(
    spark: SparkSession, path: str, size: int, overlap: int = 0, by_folder: bool = False
) -> DataFrame:
    """(path, chunk_id, chunk) of text files, each read as one joined text.

    With ``by_folder`` the files of a folder, in the order of their names, are one
    text, and ``path`` is the folder; so one text can be written by many tasks.
    With an overlap also before and after, the text around the chunk.
    """
    lines = file_lines(spark, path)
    if by_folder:
        lines = lines.withColumn("book", F.regexp_replace("path", "/[^/]*$", ""))
    return chunk_lines(lines, size, overlap)


def _strip(line):
    return F.trim(line, F.lit(" \t\n\x0b\f\r"))


def _read_tsv(spark: SparkSession, path: str, schema: str, quote: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("quote", quote)
        .csv(path)
    )


def _or_empty(spark: SparkSession, read, schema: str, missing_ok: bool) -> DataFrame:
    """With ``missing_ok``, a path that does not exist gives no rows."""
    try:
        return read()
    except AnalysisException as error:
        if not missing_ok or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
