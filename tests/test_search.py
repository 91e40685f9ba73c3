import math

import pytest
from brute import Index
from micro import QUERIES, ROWS
from pyspark.sql import functions as F

import termloom.operators.joins as joins
from termloom import NORMALIZED, SMOOTHED, build_index, load_index, search, search_term
from termloom.operators.scoring import top_k
from termloom.plans.search import query_vectors, search_vectors
from termloom.sources.readers import read_corpus_tsv, read_queries

PROFILES = pytest.mark.parametrize("profile", [NORMALIZED, SMOOTHED], ids=lambda p: p.name)
UNIQUE_ROWS = [(doc_id + str(i), text) for i, (doc_id, text) in enumerate(ROWS)]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, text string").repartition(3)


def queries(spark, rows=QUERIES):
    return spark.createDataFrame(rows, "query_id bigint, query_raw string")


@pytest.fixture(scope="module")
def micro(spark, tmp_path_factory):
    """Indexes of the micro corpus, several buckets each, built once."""
    root = tmp_path_factory.mktemp("micro")
    return {
        profile.name: build_index(documents(spark, ROWS), profile, f"{root}/{profile.name}", 3)
        for profile in (NORMALIZED, SMOOTHED)
    }


def hits_of(frame):
    found = {}
    for row in frame.orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row.doc_id, row.score))
    return found


def expected_hits(index, rows=QUERIES, k=10):
    found = {query_id: index.search(raw, k) for query_id, raw in rows}
    return {query_id: hits for query_id, hits in found.items() if hits}


def assert_same_hits(got, expected):
    assert {q: [d for d, _ in hits] for q, hits in got.items()} == {
        q: [d for d, _ in hits] for q, hits in expected.items()
    }
    for query_id, hits in expected.items():
        assert [s for _, s in got[query_id]] == pytest.approx([s for _, s in hits], rel=1e-8)


@PROFILES
@pytest.mark.parametrize(
    ("rows", "buckets"), [(ROWS, 5), (UNIQUE_ROWS, None)], ids=["repeated", "unique"]
)
def test_index_tables(spark, workspace, profile, rows, buckets):
    brute = Index(rows, profile.name)
    index = build_index(documents(spark, rows), profile, workspace.path("i"), buckets)
    assert index.stats.n_docs == brute.n
    assert index.stats.unique_ids == (rows is UNIQUE_ROWS)
    assert index.stats.n_postings == sum(len(c) for c in brute.tf.values())
    assert index.stats.n_tokens == sum(c.total() for c in brute.tf.values())
    assert index.stats.n_terms == len(brute.df)

    assert {(r.doc_id, r.term): r.tf for r in index.postings.collect()} == {
        (d, t): c for d, counts in brute.tf.items() for t, c in counts.items()
    }
    assert {r.doc_id: r.length for r in index.docs.collect()} == {
        d: counts.total() for d, counts in brute.tf.items()
    }
    assert {r.term: r.df for r in index.terms.collect()} == dict(brute.df)
    for row in index.terms.collect():
        assert row.idf == pytest.approx(brute.idf(row.term))
    for row in index.docs.collect():
        assert row.norm == pytest.approx(brute.norm(row.doc_id))
    for row in index.weights().collect():
        assert row.weight == pytest.approx(brute.vectors[row.doc_id][row.term])
    for row in index.vectors().collect():
        assert row.vector == pytest.approx(brute.vectors[row.doc_id])


@PROFILES
def test_every_query_against_brute_force(spark, workspace, micro, profile):
    result = search(load_index(spark, micro[profile.name].path), queries(spark), workspace=workspace)
    assert_same_hits(hits_of(result.hits), expected_hits(Index(ROWS, profile.name)))


# The ten sample queries.
SAMPLE_QUERIES = """# --- Single-Term Queries (5) ---
Action
Funny
Romance
Alien
Tragedy

# --- Multiple-Term Queries (5) ---
A young hero's journey to save the world
Historical drama in ancient Rome
The police investigate a complex murder mystery
A heist involving a huge diamond and betrayal
Funny movie with high-stakes action scenes
"""

PLOTS = [
    ("1", "A funny alien lands in Rome; the police don't find it funny."),
    ("2", "Romance and tragedy in ancient Rome, a drama of betrayal."),
    ("3", "A young hero saves the world from an alien. Action follows."),
    ("4", "The police investigate a murder. A mystery, a heist, a diamond!"),
    ("5", "High-stakes action: two thieves, a huge diamond, one betrayal."),
    ("6", "Heroes' journey: young and old journey to the end of the world."),
    ("7", "A historical movie about a complex tragedy, in funny scenes."),
    ("8", "High stakes; more action, more ACTION."),
]


@PROFILES
def test_the_sample_queries(spark, workspace, tmp_path, profile):
    corpus_path, query_path = tmp_path / "plots.tsv", tmp_path / "terms.txt"
    corpus_path.write_text("".join(f"{doc_id}\t{plot}\n" for doc_id, plot in PLOTS))
    query_path.write_text(SAMPLE_QUERIES)
    asked = read_queries(spark, str(query_path))
    index = build_index(read_corpus_tsv(spark, str(corpus_path)), profile, workspace.path("i"))
    result = search(index, asked, workspace=workspace)
    rows = [tuple(row) for row in asked.collect()]
    assert len(rows) == 10
    assert_same_hits(hits_of(result.hits), expected_hits(Index(PLOTS, profile.name), rows))
    assert result.status.filter("status = 'ok'").count() == 10


@PROFILES
def test_real_documents_against_brute_force(spark, workspace, sf, profile):
    table = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text"
    )
    asked = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [tuple(row) for row in table.collect()]
    index = build_index(table, profile, workspace.path("i"))
    got = hits_of(search(index, queries(spark, asked), workspace=workspace).hits)
    assert_same_hits(got, expected_hits(Index(rows, profile.name), asked))


@PROFILES
def test_large_query_sets_take_the_shuffle_way(spark, workspace, micro, profile, monkeypatch):
    index = micro[profile.name]
    by_broadcast = hits_of(search(index, queries(spark), workspace=workspace).hits)
    for rows in (13, 0):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", rows)
        vectors = query_vectors(index, queries(spark), workspace)
        assert 13 < vectors.count()
        hits = search_vectors(index, vectors)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "salt" in plan
        # Distinct terms still fit the first time, so postings are cut down first.
        assert ("LeftSemi" in plan) == (rows > 0)
        assert hits_of(hits) == by_broadcast


@PROFILES
def test_large_vocabularies_take_the_shuffle_way(spark, workspace, profile, monkeypatch):
    brute = Index(ROWS, profile.name)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(joins.join_by_load, "__defaults__", (2,))
    index = build_index(documents(spark, ROWS), profile, workspace.path("i"))
    for row in index.docs.collect():
        assert row.norm == pytest.approx(brute.norm(row.doc_id))
        assert row.length == brute.tf[row.doc_id].total()


@PROFILES
def test_k_beyond_the_group_limit(spark, profile):
    scores = spark.range(500).select(
        F.lit(1).alias("query_id"),
        F.lit("cosine").alias("mode"),
        F.col("id").alias("doc_id"),
        (F.col("id") % 7).cast("double").alias("score"),
    )
    expected = top_k(scores, 40, profile).collect()
    assert len(expected) == 40
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(key, "10")
    try:
        assert sorted(top_k(scores, 40, profile).collect()) == sorted(expected)
    finally:
        spark.conf.unset(key)
    with pytest.raises(ValueError):
        top_k(scores, 0, profile)


def test_status_normalized(spark, workspace, micro):
    index = micro["normalized"]
    status = search(index, queries(spark), workspace=workspace).status
    got = {row.query_id: (row.mode, row.status, row.n_hits) for row in status.collect()}
    assert got[1] == ("single", "ok", 4)
    assert got[2] == ("single", "no documents", 0)
    assert got[5] == ("cosine", "terms not found in corpus", 0)
    assert got[6] == ("none", "ignored", 0)
    assert got[8] == ("single", "skipped", 0)
    assert got[12] == ("single", "skipped", 0)
    assert set(got) == {query_id for query_id, _ in QUERIES}


def test_status_smoothed(spark, workspace, micro):
    index = micro["smoothed"]
    status = search(index, queries(spark), workspace=workspace).status
    got = {row.query_id: (row.mode, row.status) for row in status.collect()}
    assert got[2] == ("single", "no hits")
    assert got[5] == ("cosine", "no hits")
    assert got[6] == ("none", "no searchable terms")
    assert got[8] == ("none", "no searchable terms")
    assert got[11] == ("single", "ok")


def test_term_in_every_document(spark, workspace):
    """Weight 0: still a single-term hit, never a cosine hit."""
    rows = [("a", "star wars"), ("b", "star trek"), ("c", "star")]
    asked = [(1, "star"), (2, "star star"), (3, "star wars")]
    index = build_index(documents(spark, rows), NORMALIZED, workspace.path("i"))
    result = search(index, queries(spark, asked), workspace=workspace)
    assert hits_of(result.hits) == {
        1: [("a", 0.0), ("b", 0.0), ("c", 0.0)],
        3: [("a", 1.0)],
    }
    status = {row.query_id: row.status for row in result.status.collect()}
    assert status == {1: "ok", 2: "no similar documents", 3: "ok"}


def test_repeated_term_counts_again_when_smoothed(spark, workspace, micro):
    index = micro["smoothed"]
    got = hits_of(search(index, queries(spark, [(1, "alien alien")]), workspace=workspace).hits)
    assert max(score for _, score in got[1]) > 1


def test_ties(spark, workspace):
    rows = [(str(i), "alien ship") for i in (9, 10, 2)] + [("x", "world")]
    asked = [(1, "alien"), (2, "alien ship")]
    for profile, single in ((NORMALIZED, ["10", "2", "9"]), (SMOOTHED, ["9", "2", "10"])):
        index = build_index(documents(spark, rows), profile, workspace.path(profile.name))
        got = hits_of(search(index, queries(spark, asked), workspace=workspace).hits)
        assert [d for d, _ in got[1]] == single
        assert [d for d, _ in got[2]] == ["10", "2", "9"]


@PROFILES
def test_search_term(micro, profile):
    index = micro[profile.name]
    got = [(r.doc_id, r.score) for r in search_term(index, "alien", 3).orderBy("rank").collect()]
    expected = Index(ROWS, profile.name).search("alien", 3)
    assert [d for d, _ in got] == [d for d, _ in expected]
    assert [s for _, s in got] == pytest.approx([s for _, s in expected], rel=1e-8)
    assert search_term(index, "unicorn").count() == 0


def test_titles(spark, workspace, micro):
    index = micro["normalized"]
    titles = spark.createDataFrame(
        [("b", "Second"), ("b", "First"), ("f", None), ("z", "Unused")],
        "doc_id string, title string",
    )
    asked = queries(spark, [(1, "alien")])
    hits = search(index, asked, titles=titles, workspace=workspace).hits
    got = {row.doc_id: row.title for row in hits.collect()}
    assert got == {"b": "First", "f": None, "g": "[Title Not Found]", "h": "[Title Not Found]"}
    nothing = spark.createDataFrame([], "doc_id string, title string")
    hits = search(index, asked, titles=nothing, default_title="?", workspace=workspace).hits
    assert {row.title for row in hits.collect()} == {"?"}


def test_a_document_finds_itself(spark, workspace, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    index = build_index(table, NORMALIZED, workspace.path("i"))
    asked = table.select(F.col("doc_id").alias("query_id"), F.col("text").alias("query_raw"))
    result = search(index, asked, workspace=workspace)
    first = result.hits.filter("mode = 'cosine' AND rank = 1").collect()
    assert len(first) > 150
    assert all(math.isclose(row.score, 1, abs_tol=1e-8) for row in first)
    assert result.hits.filter("mode = 'cosine' AND (score <= 0 OR score > 1.00000001)").isEmpty()


def test_no_queries_and_no_documents(spark, workspace, micro):
    index = micro["normalized"]
    result = search(index, queries(spark, []), workspace=workspace)
    assert result.hits.count() == 0
    assert result.status.count() == 0
    with pytest.raises(ValueError):
        build_index(documents(spark, [("e", None)]), NORMALIZED, workspace.path("none"))


def test_documents_without_a_single_token(spark, workspace):
    index = build_index(documents(spark, [("c", "the of and")]), NORMALIZED, workspace.path("i"))
    assert (index.stats.n_docs, index.stats.n_postings) == (1, 0)
    result = search(index, queries(spark), workspace=workspace)
    assert result.hits.count() == 0
    assert result.status.count() == len(QUERIES)


@PROFILES
def test_rows_without_an_id_are_one_document(spark, workspace, profile):
    """Null ids stay whether or not other ids repeat."""
    rows = [(None, "alien ship"), (None, "alien moon"), ("a", "alien world"), ("b", "hero")]
    index = build_index(documents(spark, rows), profile, workspace.path("i"))
    assert not index.stats.unique_ids and index.stats.n_docs == 4
    assert {r.term: r.df for r in index.terms.collect()} == {
        "alien": 2, "ship": 1, "moon": 1, "world": 1, "hero": 1
    }
    hits = search(index, queries(spark, [(1, "ship"), (2, "ship moon")]), workspace=workspace).hits
    assert [(r.query_id, r.doc_id) for r in hits.orderBy("query_id").collect()] == [(1, None), (2, None)]


def test_long_documents_are_ranked_by_their_scores(spark, workspace):
    rows = [("b", "rare " + "word " * 99_999), ("a", "rare " + "word " * 100_000), ("c", "x"), ("d", "y")]
    index = build_index(documents(spark, rows), NORMALIZED, workspace.path("i"))
    hits = search(index, queries(spark, [(1, "rare")]), workspace=workspace).hits.orderBy("rank").collect()
    assert [r.doc_id for r in hits] == ["b", "a"]
    assert hits[0].score > hits[1].score > 0


def test_the_stop_list_belongs_to_the_index(spark, workspace):
    from termloom import load_index

    rows = [("a", "the ship"), ("b", "the moon"), ("c", "a star")]
    build_index(documents(spark, rows), NORMALIZED, workspace.path("i"), stop_words=["ship"])
    index = load_index(spark, workspace.path("i"))
    assert index.stats.stop_words == ["ship"]
    result = search(index, queries(spark, [(1, "the"), (2, "ship")]), workspace=workspace)
    assert {r.query_id: r.status for r in result.status.collect()} == {1: "ok", 2: "ignored"}
    assert sorted(r.doc_id for r in result.hits.collect()) == ["a", "b"]
    assert build_index(documents(spark, rows), NORMALIZED, workspace.path("j"), stop_words=[]).stats.stop_words == []


def test_a_workspace_can_be_closed(spark, tmp_path):
    import os

    from termloom import Workspace

    with Workspace(spark, str(tmp_path)) as space:
        table = space.save(spark.range(3), "three")
        assert table.count() == 3 and os.listdir(tmp_path)
    assert os.listdir(tmp_path) == []


def test_jobs(spark, tmp_path):
    from termloom.jobs import mentions as mentions_job
    from termloom.jobs import search as search_job

    (tmp_path / "corpus.tsv").write_text("1\talien ship\n2\thero world\n3\talien moon\n")
    (tmp_path / "titles.tsv").write_text("1\t-\tOld\n1\t-\tShip\n3\t-\tMoon\n")
    (tmp_path / "queries.txt").write_text("# comment\nalien\n\nhero world\n")
    paths = [str(tmp_path / name) for name in ("corpus.tsv", "titles.tsv", "queries.txt")]
    for output in ("one", "two"):
        search_job.run(spark, [*paths, str(tmp_path / output), "--index", str(tmp_path / "index")])
        hits = spark.read.parquet(str(tmp_path / output / "hits")).orderBy("query_id", "rank").collect()
        assert [(r.query_id, r.doc_id, r.title) for r in hits] == [
            (1, "1", "Ship"), (1, "3", "Moon"), (2, "2", NORMALIZED.default_title)
        ]
        assert spark.read.text(str(tmp_path / output / "lines")).count() == 3
    (tmp_path / "book.txt").write_text("Captain Ahab and Captain\nAhab saw Moby Dick")
    mentions_job.run(spark, [str(tmp_path / "book.txt"), str(tmp_path / "names"), "--k", "1"])
    assert [r.mention for r in spark.read.parquet(str(tmp_path / "names/mentions")).collect()] == ["Captain Ahab"]
