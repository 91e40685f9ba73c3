"""Mixing: targets, quotas, and what is taken, against plain Python."""

import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm.common import driver_table
from termloom.llm.mixing import (
    five_two_one,
    mixed_documents,
    plan_mix,
    splitting_tree,
    taken_words,
    water_fill,
)
from termloom.llm.queries import op1_mixing


def brute_targets(sizes, weights, total, most):
    targets = {}
    while True:
        free = [s for s in sizes if s not in targets]
        rest = total - sum(targets.values())
        share = {s: rest * weights[s] / sum(weights[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return targets | share
        targets |= {s: most * sizes[s] for s in over}


def test_targets_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(100):
        sizes = rng.integers(1, 1000, 8)
        weights = np.array([five_two_one(i, None) for i in range(8)])
        got = water_fill(sizes, weights, 1.5 * sizes.sum(), 2)
        expected = brute_targets(dict(enumerate(sizes)), weights, 1.5 * sizes.sum(), 2)
        assert np.allclose(got, [expected[i] for i in range(8)])
        assert np.isclose(got.sum(), 1.5 * sizes.sum()) and (got <= 2 * sizes + 1e-9).all()


def test_tree_is_exact():
    rng = np.random.default_rng(0)
    quotas = np.array([1000, 0, 17, 333, 1])
    for shards in (1, 2, 7, 64):
        tree = splitting_tree(quotas, shards, rng)
        assert tree.shape == (shards, 5) and (tree.sum(0) == quotas).all() and (tree >= 0).all()
        assert tree.sum(1).max() - tree.sum(1).min() <= 2
    means = np.mean([splitting_tree(quotas, 4, rng)[0] for _ in range(400)], 0)
    assert np.allclose(means, quotas / 4, atol=6)


ROWS = (
    [(i, "w " * (i % 17 + 1), None, f"s{i % 5}") for i in range(600)]
    + [(1000 + i, "null source " * 3, None, None) for i in range(40)]
    + [(2000, None, None, "s1"), (2001, "", None, "s2"), (None, "no id here", None, "s3")]
    + [(3000, "twice the same row", None, "s0")] * 2
    + [(4000, "long " * 3000, None, "s4"), (5000, None, None, "empty")]
)


def test_taken_words_come_near_their_targets(documents, clashing):
    table = clashing(documents(ROWS))
    mix = plan_mix(table, five_two_one, 1.5)
    rows = taken_words(table, mix).collect()
    assert len(rows) == len(ROWS)
    sizes, source = Counter(), {row[0]: row[3] for row in ROWS}
    for row in ROWS:
        sizes[row[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
    order = sorted((s for s in sizes if s), key=str) + [None]
    expected = brute_targets(
        sizes, {s: five_two_one(i, s) for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2
    )
    taken = Counter()
    for row in rows:
        name = source[row.doc_id]
        assert row.source_size == sizes[name] and np.isclose(row.target, expected[name])
        assert row.taken in (0, row.size, 2 * row.size)
        taken[name] += row.taken
    for name in order:
        assert abs(taken[name] - expected[name]) <= max(20, 0.02 * expected[name]), name


def test_mix_holds_what_is_taken_and_reruns_agree(documents, clashing):
    table = clashing(documents(ROWS))
    first = mixed_documents(table, plan_mix(table, five_two_one, 1.5, shards=5))
    again = mixed_documents(table.repartition(5), plan_mix(table.repartition(7), five_two_one, 1.5, shards=5))
    assert first.columns == table.columns
    copies = Counter(row.doc_id for row in first.collect())
    assert copies == Counter(row.doc_id for row in again.collect())
    for row in taken_words(table, plan_mix(table, five_two_one, 1.5)).collect():
        if row.size and row.doc_id not in (None, 3000):
            assert copies[row.doc_id] == row.taken / row.size
    assert copies[3000] in (0, 2, 4)


def test_mix_of_nothing(documents):
    table = documents([])
    mix = plan_mix(table, five_two_one, 1.5)
    assert mixed_documents(table, mix).count() == 0 and taken_words(table, mix).count() == 0


def test_shards_are_those_of_the_mixed_rows(documents, clashing):
    """Where copies lie in the mixed table is what the plan says, and shards are about alike."""
    table = clashing(documents(ROWS))
    mix = plan_mix(table, five_two_one, 1.5, shards=4)
    planned = Counter()
    for row in taken_words(table, mix).collect():
        shards = [int(shard) for shard in row.shards.split(",") if shard]
        assert shards == sorted(shards) and len(shards) * row.size == row.taken
        planned.update((row.doc_id, shard) for shard in shards)
    drawn = mix.find(table).select("doc_id", F.explode("__draws").alias("draw")).select("doc_id", "draw.shard")
    assert planned == Counter((row.doc_id, row.shard) for row in drawn.collect())
    sizes = Counter()
    for (_, shard), n in planned.items():
        sizes[shard] += n
    assert set(sizes) == set(range(4)) and max(sizes.values()) < 1.5 * min(sizes.values())


def test_a_plan_of_very_many_sources(documents):
    """Draws are dealt in one pass, however many sources there are."""
    rows = [(i, "one two three", None, f"source {i}") for i in range(3000)]
    start = time.time()
    mix = plan_mix(documents(rows), five_two_one, 1.5)
    assert time.time() - start < 60
    assert len(mix.sources) == 3000


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, sf):
    rows = op1_mixing(spark, sf).collect()
    texts = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    taken, target, longest = Counter(), {}, Counter()
    for row in rows:
        source = texts[row.doc_id].source
        assert row.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[row.doc_id].text or ""))
        assert row.taken <= 2 * row.size
        taken[source] += row.taken
        target[source] = row.target
        longest[source] = max(longest[source], row.size)
    assert abs(sum(taken.values()) / sum(target.values()) - 1) < 0.03
    for source, goal in target.items():
        assert abs(taken[source] - goal) <= max(0.02 * goal, longest[source] / 2), source


def test_plan_needs_no_python_workers(spark, documents):
    """What the driver plans reaches the executors as local rows, not as pickled ones."""
    table = documents([(i, "word " * (i % 9), None, f"s{i % 3}") for i in range(60)] + [(60, "x", None, None)])
    mix = plan_mix(table, five_two_one, 1.5)
    for result in (mixed_documents(table, mix), taken_words(table, mix)):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        # The rows of the test itself are the one table of that kind.
        assert plan.count("LogicalRDD") == 1 and "LocalRelation" in plan


def test_a_table_of_the_driver_keeps_its_rows(spark):
    rows = [("nä", 2**40, 1, 0.5, True), ("s", -1, 2, 1e300, False)]
    schema = "key string, a long, b int, c double, d boolean"
    table = driver_table(spark, rows, schema)
    assert [tuple(row) for row in table.collect()] == rows
    assert table.dtypes == spark.createDataFrame(rows, schema).dtypes
    assert driver_table(spark, [], schema).collect() == []
