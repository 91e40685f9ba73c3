"""Top k without scoring everything, exact ranks, selection beyond Spark's group limit."""

import random
from fractions import Fraction

import pytest
from brute import Index
from pyspark.sql import functions as F

import termloom.operators.joins as joins
import termloom.operators.scoring as scoring
import termloom.plans.index as index_module
import termloom.plans.pruning as pruning
import termloom.plans.search as search_module
from termloom import NORMALIZED, SMOOTHED, build_index, search, search_term
from termloom.functions.exact import SHARES
from termloom.operators.scoring import add_up, cosine_parts, scores_of, select_largest, top_k
from termloom.plans.index import vector_entries
from termloom.plans.search import only_terms, query_vectors, search_vectors

PROFILES = pytest.mark.parametrize("profile", [NORMALIZED, SMOOTHED], ids=lambda p: p.name)


def corpus(n, seed=1):
    """Common words, rare words, copies, and an id that is null."""
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(8)], [f"r{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = rng.choices(common, range(8, 0, -1), k=rng.randint(1, 30)) + rng.choices(rare, k=rng.randint(0, 4))
        rows.append((f"d{i:03d}", " ".join(words)))
    return rows + [(f"e{i:03d}", text) for i, (_, text) in enumerate(rows[:20])] + [(None, rows[3][1])]


QUERIES = [
    (1, "c0 c1 c2 c3 r1 r2"),
    (2, "r5 r6"),
    (3, "c0 c1"),
    (4, "c7 c7 r9 unknown"),
    (5, "r1"),
    (6, "c0 c1 c2 c3 c4 c5 c6 c7 " + " ".join(f"r{i}" for i in range(60))),
    (7, "unknown words"),
    (8, ""),
]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, text string").repartition(3)


def ranked(frame):
    return sorted((r.query_id, r.rank, r.doc_id, r.score) for r in frame.collect())


@pytest.fixture(scope="module")
def tiered(spark, tmp_path_factory):
    """Indexes with tiers for every term of more than five documents."""
    patch = pytest.MonkeyPatch()
    patch.setattr(index_module, "TIERED_FROM", 5)
    root = tmp_path_factory.mktemp("tiered")
    rows = documents(spark, corpus(300))
    built = {p.name: build_index(rows, p, f"{root}/{p.name}", 3) for p in (NORMALIZED, SMOOTHED)}
    patch.undo()
    return built


def asked(spark, index, workspace, rows=QUERIES):
    table = spark.createDataFrame(rows, "query_id bigint, query_raw string")
    return query_vectors(index, table, workspace)


@PROFILES
@pytest.mark.parametrize("k, first", [(10, 200), (10, 1), (3, 2), (1, 1), (400, 1)])
def test_pruned_hits_are_the_hits(spark, tiered, workspace, monkeypatch, profile, k, first):
    monkeypatch.setattr(pruning, "FIRST_PER_K", first)
    index = tiered[profile.name]
    vectors = asked(spark, index, workspace)
    whole = ranked(search_vectors(index, vectors, k, workspace, prune=False))
    assert ranked(search_vectors(index, vectors, k, workspace, prune=True)) == whole
    brute = Index(corpus(300), profile.name)
    for query_id, text in QUERIES:
        if len(text.split()) > 1:
            expected = brute.search(text, k)
            got = [(doc, score) for query, _, doc, score in whole if query == query_id]
            assert [score for _, score in got] == pytest.approx([score for _, score in expected], rel=1e-8)


@PROFILES
def test_pruned_hits_by_shuffle(spark, tiered, workspace, monkeypatch, profile):
    monkeypatch.setattr(pruning, "FIRST_PER_K", 1)
    index = tiered[profile.name]
    vectors = asked(spark, index, workspace)
    whole = ranked(search_vectors(index, vectors, 10, workspace))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(search_module, "LITERAL_ROWS", 0)
    assert ranked(search_vectors(index, vectors, 10, workspace, prune=True)) == whole
    assert ranked(search_vectors(index, vectors, 10, workspace, prune=False)) == whole


def test_pruning_is_chosen_by_the_number_of_postings(spark, tiered, workspace, monkeypatch):
    index = tiered["normalized"]
    vectors = asked(spark, index, workspace)
    calls = []
    plain = pruning.pruned_cosine_scores
    monkeypatch.setattr(
        search_module, "pruned_cosine_scores", lambda *args: calls.append(1) or plain(*args)
    )
    search_vectors(index, vectors, 10, workspace)
    assert not calls
    monkeypatch.setattr(search_module, "ONE_PASS", 100)
    search_vectors(index, vectors, 10, workspace)
    assert calls
    search_vectors(index, vectors, 10_000, workspace)
    assert len(calls) == 1


def test_weak_blocks_meet_candidates_only(spark, workspace, monkeypatch):
    """Common words weigh little: a rare word's documents decide, and little else is scored."""
    monkeypatch.setattr(index_module, "TIERED_FROM", 5)
    monkeypatch.setattr(pruning, "FIRST_PER_K", 2)
    rng = random.Random(3)
    words = ["stone", *"bcdefgh"]
    rows = [(f"d{i:04d}", " ".join(rng.choices(words, k=20)) + (" rare" if i % 40 == 0 else "")) for i in range(1000)]
    index = build_index(documents(spark, rows), NORMALIZED, workspace.path("i"), 2)
    vectors = asked(spark, index, workspace, [(1, "rare stone")])
    units = pruning._units(index, vectors, 10)
    first = pruning._sums(index, units.filter("first"))
    roles = pruning._roles(units, pruning.reached(first, 10))
    by_role = {row.role: row.n for row in roles.groupBy("role").agg(F.sum("n").alias("n")).collect()}
    assert by_role[pruning.WEAK] > 500 and by_role.get(pruning.STRONG, 0) < 100
    left = pruning.candidates(add_up(first), roles, 10)
    assert 10 <= left.count() <= 30
    whole = ranked(search_vectors(index, vectors, 10, workspace, prune=False))
    assert ranked(search_vectors(index, vectors, 10, workspace, prune=True)) == whole


def test_blocks_bound_their_postings(spark, tiered):
    for index in tiered.values():
        counted = index.postings.groupBy("bucket", "term", "tier").agg(
            F.count("*").alias("n"), F.max("share").alias("top_share")
        )
        blocks = index.blocks
        assert sorted(map(tuple, counted.select(sorted(counted.columns)).collect())) == sorted(
            map(tuple, blocks.select(sorted(blocks.columns)).collect())
        )
        spread = index.postings.filter("share > 0").groupBy("term", "tier").agg(
            (F.max("share") / F.min("share")).alias("ratio"), F.max("tier").alias("t")
        )
        tiers = spread.filter(f"t between 1 and {index_module.LAST_TIER - 1}")
        assert tiers.count() > 0 and tiers.filter("ratio > 2").isEmpty()


def test_ranks_are_those_of_exact_arithmetic(spark):
    """Sums that differ in the 12th digit and below, of parts of many sizes, in any order."""
    rng = random.Random(7)
    shared = [rng.random() * 10.0 ** -rng.randint(1, 9) for _ in range(40)]
    rows, exact = [], {}
    for doc in range(60):
        parts = shared + [1e-13 * (doc % 20 + 1), 3e-16 * doc]
        rng.shuffle(parts)
        exact[doc] = sum(Fraction(part) for part in parts)
        rows += [(1, doc, part) for part in parts]
    table = spark.createDataFrame(rows, "query_id bigint, doc_id bigint, share double").withColumns(
        {"qweight": F.lit(1.0), "qnorm": F.lit(1.0), "qtf": F.lit(1)}
    )
    expected = sorted(exact, key=lambda doc: (-exact[doc], doc))
    for partitions in (1, 5, 16):
        dealt = table.orderBy(F.rand(partitions)).repartition(partitions)
        scores = scores_of(add_up(cosine_parts(dealt, NORMALIZED)))
        ranks = top_k(scores, 60, NORMALIZED).orderBy("rank").collect()
        assert [row.doc_id for row in ranks] == expected


def test_copies_tie_however_rows_are_dealt(spark, workspace):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    text = rng.choices(words, k=200)
    rows = []
    for i in range(30):
        rng.shuffle(text)
        rows.append((f"d{i:02d}", " ".join(text)))
    rows += [(f"x{i}", " ".join(rng.choices(words, k=50))) for i in range(30)]
    table = spark.createDataFrame(rows, "doc_id string, text string")
    query = spark.createDataFrame([(1, " ".join(text[:40]))], "query_id bigint, query_raw string")
    for partitions in (1, 7):
        index = build_index(table.repartition(partitions), NORMALIZED, workspace.path(f"i{partitions}"), 3)
        hits = search(index, query, k=30, workspace=workspace).hits.orderBy("rank").collect()
        assert [hit.doc_id for hit in hits] == [f"d{i:02d}" for i in range(30)]
        norms = {row.norm for row in index.docs.filter("doc_id like 'd%'").collect()}
        assert len(norms) == 1


@PROFILES
@pytest.mark.parametrize("limit", [5, 1000])
def test_more_hits_than_the_group_limit(spark, workspace, profile, limit):
    """Scores with long ties, some of them 0, and a query with few rows."""
    rng = random.Random(9)
    rows = [(1, "cosine", f"d{i:04d}", rng.choice([0.5, 0.25, rng.random()])) for i in range(2000)]
    rows += [(2, "single", f"d{i:04d}", 0.0 if i % 3 else 1.0) for i in range(900)]
    rows += [(3, "single", f"d{i:04d}", rng.random() * 1e-9) for i in range(4)]
    rows += [(4, "cosine", f"d{i:04d}", 0.75) for i in range(1500)]
    rows += [(5, "single", None, 0.1)]
    table = spark.createDataFrame(rows, "query_id bigint, mode string, doc_id string, score double").repartition(4)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    expected = ranked(top_k(table, 50, profile))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(limit))
    try:
        assert ranked(top_k(table, 50, profile, workspace)) == expected
        left = select_largest(table, 50, profile, workspace).groupBy("query_id").count().collect()
        assert max(row["count"] for row in left) <= scoring.ROWS_PER_K * 50
        assert {row.query_id for row in left} == {1, 2, 3, 4, 5}
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1000")


def rows_read(frame):
    """Rows that came out of the one scan of a frame, after running it."""
    frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_an_absent_term_reads_no_row(spark, workspace, sf):
    """In a bucket with other terms, before and after it in order."""
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("doc_id"), F.concat_ws(" ", F.concat(F.lit("w"), F.col("id") * 2), F.lit("all")).alias("text")
    )
    index = build_index(rows, NORMALIZED, workspace.path("i"), buckets=1)
    for table in (index.terms, index.postings):
        absent = only_terms(table, [(0, "w10001")])
        assert absent.count() == 0 and rows_read(only_terms(table, [(0, "w10001")])) == 0
        present = only_terms(table, [(0, "w10000")])
        assert present.count() == 1 and 0 < rows_read(only_terms(table, [(0, "w10000")])) < 60_000
    assert search_term(index, "w10001").collect() == []
    assert [hit.doc_id for hit in search_term(index, "w10000").collect()] == ["5000"]
    query = spark.createDataFrame([(1, "w10001"), (2, "w10001 w10000")], "query_id bigint, query_raw string")
    hits = search(index, query, workspace=workspace).hits.collect()
    assert [(hit.query_id, hit.doc_id) for hit in hits] == [(2, "5000")]


@PROFILES
def test_vectors_in_blocks(spark, workspace, profile):
    """A third of the rows is one id with more terms than a block takes."""
    rows = [("long", " ".join(f"t{i * 30 + j:05d}" for j in range(40))) for i in range(60)]
    rows += [(f"d{i}", f"t{i:05d} t{i + 7:05d} own{i}") for i in range(80)] + [(None, "t00001 alone"), (None, "t00002")]
    index = build_index(documents(spark, rows), profile, workspace.path("i"), 2)
    blocks = index.vector_blocks(workspace, size=100)
    found = blocks.orderBy("doc_id", "block").collect()
    vectors = {row.doc_id: row.vector for row in index.vectors().collect()}
    assert max(len(row.terms) for row in found) == 100
    for doc_id, vector in vectors.items():
        own = [row for row in found if row.doc_id == doc_id]
        assert [row.block for row in own] == list(range(len(own)))
        assert all(len(row.terms) == 100 for row in own[:-1])
        assert [t for row in own for t in row.terms] == sorted(vector)
        assert {t: w for row in own for t, w in zip(row.terms, row.weights)} == vector
        assert all((row.first_term, row.last_term) == (row.terms[0], row.terms[-1]) for row in own)
    part = vector_entries(blocks, "long", "t00100", "t00350").collect()
    assert {row.term: row.weight for row in part} == {
        t: w for t, w in vectors["long"].items() if "t00100" <= t <= "t00350"
    }
    assert [row.term for row in vector_entries(blocks, None, "a", "b").collect()] == ["alone"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = vector_entries(blocks, "long", "t00100", "t00350")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(last_term,t00100)" in plan and "LessThanOrEqual(first_term,t00350)" in plan


def test_sums_hold_the_shares_of_a_long_query():
    assert SHARES.top - 32 * SHARES.n <= -80


ONE_TERM = [(i, f"c{i} c{i}") for i in range(8)] + [(20, "r5 r5"), (21, "c0 unknown"), (None, "c1 c1 c1"), (22, "no such")]


@PROFILES
@pytest.mark.parametrize("k", [1, 3, 10, 400])
def test_cosines_of_one_term_need_its_best_tiers(spark, tiered, workspace, profile, k):
    index = tiered[profile.name]
    vectors = asked(spark, index, workspace, ONE_TERM).filter("df > 0 and qweight > 0")
    size = joins.measure(vectors, "term", "query_id")
    every = search_module._matches(index, vectors, size)
    whole = top_k(scores_of(cosine_parts(every, profile)), k, profile)
    got = search_vectors(index, vectors, k, workspace).select(whole.columns)
    key = lambda row: (row[0] is None, *map(str, row[:3]), row[3] or "")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, whole.collect()), key=key)
    met = search_module.best_tiers(index, vectors, k, size)
    kept = search_module._matches(index, met, size, None, search_module.TIER_KEYS).count()
    assert kept == met.agg(F.sum("df")).first()[0]
    if k == 1:
        assert kept < every.count() / 2
    if k == 400:
        assert kept == every.count()
