"""The plans Spark makes of the library's work."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from termloom import NORMALIZED, SMOOTHED, build_index, mention_report, search_term
from termloom.operators.corpus import bag_of_words, tokenize_corpus
from termloom.operators.frequency import (
    document_frequency,
    document_frequency_by_row,
    document_length,
    has_unique_ids,
    term_frequency,
)
from termloom.operators.joins import measure
from termloom.plans.index import bucket_count, task_count
from termloom.plans.search import _matches, query_vectors, search_vectors
from termloom.plans.workspace import Workspace


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def index(spark, sf, tmp_path_factory):
    workspace = Workspace(spark, str(tmp_path_factory.mktemp("plans")))
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    return build_index(documents, NORMALIZED, workspace.path("index"), buckets=16)


@pytest.fixture(scope="module")
def vectors(spark, sf, index, tmp_path_factory):
    workspace = Workspace(spark, str(tmp_path_factory.mktemp("vectors")))
    asked = spark.read.parquet(f"{sf}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_raw")
    )
    return query_vectors(index, asked, workspace)


def assert_native(plan):
    assert "Python" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("profile", [NORMALIZED, SMOOTHED], ids=lambda p: p.name)
def test_texts_are_tokenised_once_and_never_in_python(spark, sf, profile):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    tokens = tokenize_corpus(documents, profile)
    for frame in (term_frequency(tokens), document_frequency(term_frequency(tokens))):
        plan = plan_of(frame)
        assert_native(plan)
        assert plan.count("regexp_replace") == 1
    scan = re.search("ReadSchema: .*", plan_of(tokens)).group()
    assert "lang" not in scan and "source" not in scan


def test_counting_documents_deals_out_nothing(spark, sf):
    import __spark_entry__ as registry

    plan = plan_of(registry.queries()["corpus_count"](spark, sf))
    assert "RoundRobin" not in plan
    assert "TakeOrderedAndProject" in plan_of(registry.queries()["sample_5"](spark, sf))


@pytest.mark.parametrize("profile", [NORMALIZED, SMOOTHED], ids=lambda p: p.name)
def test_unique_documents_are_counted_by_one_shuffle(spark, sf, profile):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    tokens = tokenize_corpus(documents, profile)
    assert has_unique_ids(documents)
    for frame in (document_frequency_by_row(tokens), document_length(tokens)):
        plan = plan_of(frame)
        assert_native(plan)
        assert plan.count("Exchange hashpartitioning") == 1
    assert not has_unique_ids(documents.unionByName(documents.limit(1)))
    expected = sorted(document_frequency(term_frequency(tokens)).collect())
    assert sorted(document_frequency_by_row(tokens).collect()) == expected


def test_sizes_of_an_index():
    assert (bucket_count(10**6), task_count(10**6, 8)) == (1, 8)
    assert (bucket_count(10**10), task_count(10**10, 8)) == (8192, 20)
    assert (bucket_count(10**13), task_count(10**13, 8)) == (20_000, 20_000)
    assert (bucket_count(0), task_count(0, 8)) == (1, 1)


def test_terms_of_every_document_are_not_read_by_a_cosine_search(spark, workspace):
    rows = [(str(i), f"star w{i}") for i in range(50)]
    index = build_index(spark.createDataFrame(rows, "doc_id string, text string"), NORMALIZED, workspace.path("i"))
    asked = spark.createDataFrame([(1, "star w3")], "query_id bigint, query_raw string")
    vectors = query_vectors(index, asked, workspace)
    matched = _matches(index, vectors.filter("mode = 'cosine' and qweight > 0"), measure(vectors, "term"))
    assert matched.count() == 1
    assert "qweight" in plan_of(search_vectors(index, vectors))
    hits = search_vectors(index, vectors).collect()
    assert [(h.doc_id, h.rank) for h in hits] == [("3", 1)]


def test_bags_need_no_shuffle(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    plan = plan_of(bag_of_words(tokenize_corpus(documents, NORMALIZED)))
    assert_native(plan)
    assert "Exchange" not in plan
    assert plan.count("sort_array") == 1


def test_batch_search_prunes_buckets_and_keeps_k_rows_per_task(index, vectors):
    plan = plan_of(search_vectors(index, vectors))
    assert_native(plan)
    assert "SubqueryAdaptiveBroadcast" in plan
    assert plan.count("WindowGroupLimit") == 2


def test_searches_read_only_the_buckets_they_need(spark, sf, workspace):
    """With every other bucket spoiled, answers stay the same."""
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    index = build_index(documents, NORMALIZED, workspace.path("index"), buckets=8)
    asked = spark.createDataFrame([(1, "tion"), (2, "tion tion")], "query_id int, query_raw string")
    vectors = query_vectors(index, asked, workspace)
    whole = search_vectors(index, vectors).collect()
    of_term = search_term(index, "tion").collect()
    assert len(whole) == 20 and len(of_term) == 10

    needed = vectors.first()["bucket"]
    spoiled = 0
    for table in ("postings", "terms"):
        for path in Path(index.path, table).glob("bucket=*/*.parquet"):
            if path.parent.name != f"bucket={needed}":
                path.write_bytes(b"spoiled")
                spoiled += 1
    assert spoiled > 8
    with pytest.raises(Exception):
        index.postings.agg(F.sum("tf")).collect()
    again = query_vectors(index, asked, workspace)
    assert sorted(again.collect()) == sorted(vectors.collect())
    assert search_vectors(index, vectors).collect() == whole
    assert search_term(index, "tion").collect() == of_term


def test_term_search_prunes_when_planned(index):
    plan = plan_of(search_term(index, "tion"))
    assert_native(plan)
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "doc_id#" in line)
    assert re.search(r"PartitionFilters: \[[^]]*\(bucket#\d+ = \d+\)", scan)
    assert "EqualTo(term,tion)" in scan


def test_searches_do_not_recompute_the_corpus(index, vectors):
    plan = plan_of(search_vectors(index, vectors))
    assert "regexp_replace" not in plan
    assert "documents.parquet" not in plan


def test_mention_report_is_native_and_takes_ordered(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    plan = plan_of(mention_report(documents))
    assert_native(plan)
    assert "TakeOrderedAndProject" in plan
    assert plan.count("regexp_extract_all") == 1
