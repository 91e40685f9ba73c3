import re

import pytest
from micro import ROWS
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from termloom import NORMALIZED, RAW, SMOOTHED
from termloom.functions.stop_words import ENGLISH
from termloom.functions.text import clean, clean_delete, clean_space, text_chunks
from termloom.operators.corpus import bag_of_words, corpus, tokenize_corpus
from termloom.operators.queries import tokenize_queries

EDGES = ["", " ", "a  b ", "  x", "A-b_c", "it's", "don't stop", "x\ty\nz\r\n", "\x0b\x0c a", "Ünïcode É", "KK iİ"]
EDGES += [f"a{chr(c)}b {chr(c)}" for c in (0x1C, 0x1F, 0x85, 0xA0, 0x1680, 0x2003, 0x200B, 0x2028, 0x3000, 0xFEFF)]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id int, text string")


def column(frame, name):
    return [row[name] for row in frame.orderBy("doc_id").collect()]


def test_stop_list_is_sparks(spark):
    assert list(ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


def test_clean_space_against_python(spark):
    got = column(texts(spark, EDGES).select("doc_id", clean_space(F.col("text")).alias("c")), "c")
    assert got == [
        re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", text.lower())).strip() for text in EDGES
    ]


def test_clean_delete_against_python(spark):
    got = column(texts(spark, EDGES).select("doc_id", clean_delete(F.col("text")).alias("c")), "c")
    assert got == [re.sub(r"[^a-z0-9\s]", "", text.lower()) for text in EDGES]


def test_null_text_cleans_to_empty(spark):
    frame = texts(spark, [None]).select(
        clean_space(F.col("text")).alias("a"), clean_delete(F.col("text")).alias("b")
    )
    assert frame.first() == ("", "")


@pytest.mark.parametrize("profile", [NORMALIZED, SMOOTHED, RAW], ids=lambda p: p.name)
def test_tokens_equal_ml_transformers(spark, sf, profile):
    micro = texts(spark, [text for _, text in ROWS if text is not None] + EDGES)
    real = corpus(spark.read.parquet(f"{sf}/documents.parquet"))
    for documents in (micro, real):
        cleaned = documents.select("doc_id", clean(F.col("text"), profile).alias("c"))
        if profile is RAW:
            cleaned = documents.select("doc_id", F.col("text").alias("c"))
        split = Tokenizer(inputCol="c", outputCol="w").transform(cleaned)
        expected = StopWordsRemover(inputCol="w", outputCol="tokens").transform(split)
        got = tokenize_corpus(documents, profile)
        assert column(got, "tokens") == column(expected, "tokens")


def test_query_tokens(spark):
    queries = spark.createDataFrame(
        [(1, "A young hero's journey"), (2, "high-stakes"), (3, f"x{chr(0x2003)}y  "), (4, "!!!"), (5, "the")],
        "query_id int, query_raw string",
    )

    def got(profile):
        rows = tokenize_queries(queries, profile).orderBy("query_id").collect()
        return [(row.tokens, row.mode) for row in rows]

    assert got(NORMALIZED) == [
        (["young", "hero", "journey"], "cosine"),
        (["high", "stakes"], "cosine"),
        (["x", "y"], "cosine"),
        ([""], "single"),
        ([], "none"),
    ]
    assert got(SMOOTHED) == [
        (["young", "heros", "journey"], "cosine"),
        (["highstakes"], "single"),
        (["x", "y"], "cosine"),
        ([], "none"),
        ([], "none"),
    ]


def test_own_stop_words(spark):
    documents = texts(spark, ["The Alien the end"])
    got = tokenize_corpus(documents, NORMALIZED, ["ALIEN"])
    assert column(got, "tokens") == [["the", "the", "end"]]
    assert column(tokenize_corpus(documents, NORMALIZED, []), "tokens") == [
        ["the", "alien", "the", "end"]
    ]


def test_bag_of_words(spark):
    tokens = spark.createDataFrame(
        [(1, ["b", "a", "b", "", "b"]), (2, []), (3, ["x"])], "doc_id int, tokens array<string>"
    )
    rows = {row.doc_id: row for row in bag_of_words(tokens).collect()}
    assert {e.term: e.tf for e in rows[1].bag} == {"": 1, "a": 1, "b": 3}
    assert (rows[1].length, rows[1].n_terms) == (5, 3)
    assert (rows[2].length, rows[2].n_terms, rows[2].bag) == (0, 0, [])
    assert [tuple(e) for e in rows[3].bag] == [("x", 1)]


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_text_chunks_are_slices(spark, size):
    values = ["", "abc", "abcdefg", "é\n" * 11, "x\U0001f600y\U0001f600" * 5]
    got = column(
        texts(spark, values).select("doc_id", text_chunks(F.col("text"), size).alias("c")), "c"
    )
    assert got == [[v[i : i + size] for i in range(0, len(v), size)] for v in values]
