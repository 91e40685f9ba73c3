"""The pipeline stage by stage against plain Python, and the SQL of the native queries."""

import os
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.util import PythonEvalType

import __spark_entry__ as registry
import corpus_pipeline
from oracle_check import compare, duck
from termloom.llm import queries
from termloom.llm.quality import N_FEATURES, quality_scores, text_features, train_quality
from termloom.llm.tokens import Encoder
from termloom.plans.workspace import Workspace
from test_near_copies import brute_components
from test_rules_pii import brute_spans

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """The documents and what every stage made of them."""
    workspace = Workspace(spark, str(tmp_path_factory.mktemp("pipeline")))
    tables = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(workspace.save(stage(spark, tables[-1], SF), name.replace(" ", "-")))
    return tables


def test_stages_are_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near copies", "personal data", "mixing", "packing"
    ]
    assert registry.queries()["pipeline"] is corpus_pipeline.run
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries()]
    assert sorted(numbers) == list(range(1, 14))


def test_documents_keep_their_columns(results):
    for table in results[:-1]:
        assert table.columns == results[0].columns


def test_quality_stage(spark, results):
    model = train_quality(results[0], spark.read.parquet(f"{SF}/labels.parquet"))
    rows = results[0].collect()
    scores = model.score(np.array([text_features(r.text or "") for r in rows]).reshape(-1, N_FEATURES))
    expected = {row.doc_id for row, score in zip(rows, scores, strict=True) if score >= 0.5}
    assert {row.doc_id for row in results[1].collect()} == expected
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    assert len(bad & expected) <= 2 and len(good - expected) <= 2


def test_near_copies_stage(results):
    rows = [(row.doc_id, row.text) for row in results[1].collect()]
    _, components, _ = brute_components(rows, 5)
    assert {row.doc_id for row in results[2].collect()} == set(components)


def test_personal_data_stage(results):
    before = {row.doc_id: row for row in results[2].collect()}
    after = {row.doc_id: row for row in results[3].collect()}
    assert before.keys() == after.keys()
    changed = 0
    for doc_id, row in before.items():
        spans = [span.split(":") for span in brute_spans(row.text).split(",") if span]
        runs = []
        for start, end, kind in sorted((int(s), int(e), kind) for kind, s, e in spans):
            if runs and start < runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], end)
            else:
                runs.append([start, end, kind])
        text = row.text
        for start, end, kind in reversed(runs):
            text = f"{text[:start]}<{kind}>{text[end:]}"
        # Account numbers come on top of the plain kinds.
        assert re.sub("<iban>", "", after[doc_id].text) == text or "<iban>" in after[doc_id].text
        changed += after[doc_id].text != row.text
        assert after[doc_id].n_chars == len(after[doc_id].text)
    assert changed > 0


def test_mixing_stage(results):
    sizes = {row.doc_id: (len((row.text or "").split()), row.source, row.text) for row in results[3].collect()}
    copies = Counter()
    for row in results[4].collect():
        assert row.text == sizes[row.doc_id][2]
        copies[row.doc_id] += 1
    assert max(copies.values()) <= 2
    total = sum(size for size, _, _ in sizes.values())
    taken = sum(sizes[doc_id][0] * n for doc_id, n in copies.items())
    assert abs(taken / (1.5 * total) - 1) < 0.03


def test_packing_stage(spark, results):
    encoder = Encoder(spark.sparkContext)
    expected = Counter(len(encoder.ids(row.text or "")) + 1 for row in results[4].collect())
    got = Counter(row.doc_tokens for row in results[5].filter("start = 0").collect())
    assert got == expected
    fill = Counter()
    for row in results[5].collect():
        fill[row.sequence_id] += row.length
    assert max(fill.values()) <= 1024


@pytest.mark.parametrize("name", ["op7_quality_rules", "op10_pii"])
def test_native_queries_equal_their_sql(spark, name):
    assert compare(spark, duck(SF), SF, queries.queries()[name], registry.oracle_sql()[name]) == ""


def test_workers_of_the_pipeline_need_no_pandas():
    """What a Python worker of any stage imports; pandas would be 30 MB of each worker."""
    modules = ", ".join(f"termloom.llm.{name}" for name in ("quality", "minhash", "pii", "mixing", "packing"))
    code = f"import sys, pyspark.worker, {modules}; print('pandas' in sys.modules)"
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=REPO, check=True)
    assert run.stdout.strip() == "False"


def test_quality_is_scored_without_pandas(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    plan = quality_scores(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "score" in plan
    assert f"], {PythonEvalType.SQL_SCALAR_ARROW_UDF}" in plan
