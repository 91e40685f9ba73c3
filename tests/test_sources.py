import gzip
import time
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from termloom.operators.chunks import chunk_texts
from termloom.operators.titles import one_title_per_id
from termloom.sources.listings import hit_lines, mention_lines
from termloom.sources.readers import (
    query_lines,
    read_book,
    read_corpus_table,
    read_corpus_tsv,
    read_queries,
    read_titles_lines,
    read_titles_tsv,
)

TERMS = """# --- single ---
Action
Funny

# --- several ---
   A young hero's journey to save the world\t
Funny movie with high-stakes action scenes
"""


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def test_corpus_tsv(spark, tmp_path):
    path = write(
        tmp_path,
        "corpus.tsv",
        '1\tplain\n2\tplain "in" middle\n3\t"whole"\n4\n5\ta\tb\n6\t"open only starts\n8\t\n10\t  spaces \n',
    )
    got = {row.doc_id: row.text for row in read_corpus_tsv(spark, path).collect()}
    assert got == {
        "1": "plain",
        "2": 'plain "in" middle',
        "3": '"whole"',
        "5": "a",
        "6": '"open only starts',
        "10": "  spaces ",
    }
    quoted = {r.doc_id: r.text for r in read_corpus_tsv(spark, path, quote='"').collect()}
    assert quoted["3"] == "whole"
    assert quoted["2"] == 'plain "in" middle'
    assert quoted["6"] == "open only starts"


def test_titles(spark, tmp_path):
    path = write(
        tmp_path,
        "titles.tsv",
        '1\t/m/1\tFirst\t2001\t\t90\tx\ty\tz\n2\t/m/2\t"Quoted"\n3\t/m/3\n4\t/m/4\t\t1999\n',
    )
    lines = {row.doc_id: row.title for row in read_titles_lines(spark, path).collect()}
    assert lines == {"1": "First", "2": '"Quoted"', "4": ""}
    table = {row.doc_id: row.title for row in read_titles_tsv(spark, path).collect()}
    assert table == {"1": "First", "2": '"Quoted"', "3": None, "4": None}
    quoted = {r.doc_id: r.title for r in read_titles_tsv(spark, path, quote='"').collect()}
    assert quoted["2"] == "Quoted"


def test_queries(spark, tmp_path):
    rows = read_queries(spark, write(tmp_path, "terms.txt", TERMS)).orderBy("query_id").collect()
    assert [(row.query_id, row.query_raw) for row in rows] == [
        (1, "Action"),
        (2, "Funny"),
        (3, "A young hero's journey to save the world"),
        (4, "Funny movie with high-stakes action scenes"),
    ]


def test_queries_over_many_read_blocks(spark, tmp_path):
    lines = [f"query {i}" if i % 7 else "# no" for i in range(2000)]
    path = write(tmp_path, "many.txt", "\n".join(lines))
    with_blocks(spark, 512)
    try:
        rows = read_queries(spark, path).orderBy("query_id").collect()
        assert read_queries(spark, path).select("query_id").distinct().count() == len(rows)
    finally:
        without_blocks(spark)
    kept = [line for line in lines if line != "# no"]
    assert [(row.query_id, row.query_raw) for row in rows] == list(enumerate(kept, 1))


def test_missing_files(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere")
    for read in (read_queries, read_titles_lines, read_titles_tsv):
        assert read(spark, nowhere, missing_ok=True).count() == 0
        with pytest.raises(AnalysisException):
            read(spark, nowhere)
    with pytest.raises(AnalysisException):
        read_corpus_tsv(spark, nowhere)
    empty = write(tmp_path, "empty.txt", "# nothing\n\n")
    assert read_queries(spark, empty).count() == 0


def test_query_lines_of_texts(spark):
    texts = spark.createDataFrame(
        [(1, "# no\nAlien\n\n  Two words \r\nlast"), (2, "#"), (3, None)], "doc_id int, text string"
    )
    got = sorted(tuple(row) for row in query_lines(texts).collect())
    assert got == [(1, 1, "Alien"), (1, 2, "Two words"), (1, 3, "last")]


def with_blocks(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")


def without_blocks(spark):
    for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{key}")


@pytest.mark.parametrize("ending", ["", "\n", "\n\n"])
@pytest.mark.parametrize("size", [7, 100])
def test_book_in_many_read_blocks(spark, tmp_path, ending, size):
    lines = [("é word " * (i % 5)).strip() + str(i) for i in range(150)] + ["", "end"]
    text = "\n".join(lines) + ending
    path = write(tmp_path, "book.txt", text)
    joined = " ".join(lines + ([""] if ending == "\n\n" else []))
    expected = [joined[i : i + size] for i in range(0, len(joined), size)]
    with_blocks(spark, 200)
    try:
        rows = read_book(spark, path, size).orderBy("chunk_id").collect()
    finally:
        without_blocks(spark)
    assert [row.chunk_id for row in rows] == list(range(len(expected)))
    assert [row.chunk for row in rows] == expected
    # A text column gives the same chunks as a file.
    table = spark.createDataFrame([(1, text)], "doc_id int, text string")
    rows = chunk_texts(table, size).orderBy("chunk_id").collect()
    assert [row.chunk for row in rows] == expected


def test_books_are_chunked_one_by_one(spark, tmp_path):
    write(tmp_path, "a.txt", "one\ntwo")
    write(tmp_path, "b.txt", "three")
    rows = read_book(spark, str(tmp_path), 4).orderBy("path", "chunk_id").collect()
    assert [(row.path[-5:], row.chunk_id, row.chunk) for row in rows] == [
        ("a.txt", 0, "one "),
        ("a.txt", 1, "two"),
        ("b.txt", 0, "thre"),
        ("b.txt", 1, "e"),
    ]


def test_tables_are_dealt_out_when_asked(spark, sf):
    path = f"{sf}/documents.parquet"
    documents = read_corpus_table(spark, path, partitions=5)
    assert documents.groupBy(F.spark_partition_id()).count().count() == 5
    assert documents.count() == spark.read.parquet(path).count()
    plan = read_corpus_table(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_last_title_wins(spark, tmp_path):
    for name, lines in (("1.txt", "a\t\tOne\nb\t\tTwo\na\t\tThree"), ("2.txt", "b\t\tFour\nc\t\tFive")):
        (tmp_path / name).write_text(lines)
    titles = read_titles_lines(spark, str(tmp_path), places=True)
    kept = {r.doc_id: r.title for r in one_title_per_id(titles, keep="last").collect()}
    assert kept == {"a": "Three", "b": "Four", "c": "Five"}
    least = {r.doc_id: r.title for r in one_title_per_id(titles).collect()}
    assert least == {"a": "One", "b": "Four", "c": "Five"}
    with pytest.raises(ValueError):
        one_title_per_id(titles, keep="first")


def test_one_long_line_is_as_fast_as_many(spark, tmp_path):
    text = "".join(f"word{i % 977} " for i in range(700_000))
    (tmp_path / "long.txt").write_text(text)
    (tmp_path / "short.txt").write_text("\n".join(text[i : i + 79] for i in range(0, len(text), 79)))
    seconds = {}
    for name in ("long", "short", "long"):
        start = time.perf_counter()
        chunks = read_book(spark, str(tmp_path / f"{name}.txt"), 10_000).orderBy("chunk_id").collect()
        seconds[name] = time.perf_counter() - start
    assert "".join(c.chunk for c in read_book(spark, str(tmp_path / "long.txt"), 10_000).orderBy("chunk_id").collect()) == text
    assert {len(c.chunk) for c in chunks[:-1]} == {10_000}
    assert seconds["long"] < 3 * seconds["short"] + 2


def test_listings(spark):
    hits = spark.createDataFrame(
        [(1, 1, "x", 0.123456), (1, 2, None, 2.0)],
        "query_id int, rank int, title string, score double",
    )
    assert [row.line for row in hit_lines(hits).orderBy("rank").collect()] == [
        "1. x (0.1235)",
        "2. null (2.0000)",
    ]
    counts = spark.createDataFrame([("Moby Dick", 3), ("N " * 20, 1)], "mention string, n bigint")
    assert [row.line for row in mention_lines(counts).orderBy("line").collect()] == [
        "Moby Dick".ljust(30) + " | 3",
        "N " * 20 + " | 1",
    ]


def book(rows):
    return " ".join(rows)


def windows(text, size, overlap):
    return {
        at // size: (text[max(0, at - overlap) : at], text[at : at + size], text[at + size : at + size + overlap])
        for at in range(0, len(text), size)
    }


@pytest.mark.parametrize("size, overlap", [(10, 10), (10, 3), (64, 20), (1000, 1000)])
def test_chunks_of_files_with_the_text_around_them(spark, tmp_path, monkeypatch, size, overlap):
    monkeypatch.setattr("termloom.operators.chunks.RUN_BITS", 2)
    lines = [f"line {i} " + "é" * (i % 23) for i in range(50)] + ["", "x" * 95, "end"]
    folder = tmp_path / "books"
    folder.mkdir()
    path = write(folder, "a.txt", "\n".join(lines) + "\n")
    write(folder, "b.txt", "")
    with gzip.open(f"{folder}/c.txt.gz", "wt") as out:
        out.write("\n".join(lines * 3))
    write(folder, "d.txt", "y" * size)
    got = {}
    for row in read_book(spark, str(folder), size, overlap).collect():
        name = row.path.rsplit("/", 1)[1]
        got.setdefault(name, {})[row.chunk_id] = (row.before, row.chunk, row.after)
    assert got == {
        "a.txt": windows(book(lines), size, overlap),
        "c.txt.gz": windows(book(lines * 3), size, overlap),
        "d.txt": windows("y" * size, size, overlap),
    }
    plain = {row.chunk_id: row.chunk for row in read_book(spark, path, size).collect()}
    assert plain == {i: own for i, (_, own, _) in windows(book(lines), size, 0).items()}


def test_the_files_of_a_folder_are_one_book(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("termloom.operators.chunks.RUN_BITS", 3)
    texts = {"one": ["a b", "c"] * 9, "two": ["dd"] * 40}
    for name, lines in texts.items():
        (tmp_path / name).mkdir()
        for part in range(3):
            here = lines[part * len(lines) // 3 : (part + 1) * len(lines) // 3]
            write(tmp_path / name, f"part-{part:05d}.txt", "".join(line + "\n" for line in here))
    got = {}
    for row in read_book(spark, f"{tmp_path}/*", 7, 5, by_folder=True).collect():
        got.setdefault(row.path.rsplit("/", 1)[1], {})[row.chunk_id] = (row.before, row.chunk, row.after)
    assert got == {name: windows(book(lines), 7, 5) for name, lines in texts.items()}


def test_a_large_source_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """A third of the rows is one source; no task writes more than three times the median."""
    import __spark_entry__ as registry

    rows = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"),
        F.concat(F.lit("text "), F.col("id")).alias("text"),
    )
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        path = registry._write_books(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tasks = Counter()
    for row in spark.read.text(f"{path}/*").select(F.input_file_name().alias("file")).collect():
        tasks[row.file.rsplit("/", 1)[1].split("-")[1]] += 1
    sizes = sorted(tasks.values())
    assert len(sizes) >= 10 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    books = read_book(spark, f"{path}/*", 10_000, by_folder=True)
    big = books.filter("path like '%source=big'").orderBy("chunk_id").collect()
    assert "".join(row.chunk for row in big) == book(f"text {i}" for i in range(0, 9000, 3))
