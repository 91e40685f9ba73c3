"""Near copies of texts and vectors, and components, against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm import minhash, neighbours
from termloom.llm.components import connected_components
from termloom.llm.minhash import drop_near_copies, near_copies
from termloom.llm.neighbours import near_vectors
from termloom.llm.queries import op3_near_vectors, op8_near_copies

SF = "/root/testdata/sf0.001"


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def test_components_against_union_find(spark, workspace):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    table = spark.createDataFrame(edges, "a long, b long").repartition(3)
    rows = connected_components(table, workspace).collect()
    nodes = {x for edge in edges if edge[0] != edge[1] for x in edge}
    assert sorted(row.node for row in rows) == sorted(nodes)
    assert all(row.label == union.find(row.node) for row in rows)
    assert connected_components(table.limit(0), workspace).count() == 0


def shingles(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return frozenset()
    if len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def brute_components(rows, words, percent=80):
    sets = [shingles(text, words) for _, text in rows]
    union = Union()
    for i in range(len(rows)):
        union.find(i)
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                union.join(i, j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[union.find(i)].append(doc_id)
    return sets, [min(least[union.find(i)], default=None) for i in range(len(rows))], union


def edited(rng, words, share):
    return " ".join(f"new{rng.randint(0, 10**6)}" if rng.random() < share else word for word in words)


@pytest.fixture(scope="module")
def copied_rows():
    rng = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = [(i, edited(rng, base, rng.choice([0.0, 0.02, 0.05, 0.08]))) for i in range(60)]
    for i in range(60, 120):
        rows.append((i, " ".join(f"u{rng.randint(0, 900)}" for _ in range(rng.randint(1, 120)))))
    rows += [(200 + i, rows[70][1].upper()) for i in range(10)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one"), (304, "ONE"), (305, "é"), (306, "É")]
    rows += [(None, rows[80][1]), (None, "lonely text without an id"), (7, rows[7][1]), (7, rows[7][1])]
    return rows


@pytest.mark.parametrize("words", [2, 5])
def test_text_components_against_brute_force(documents, clashing, copied_rows, workspace, words):
    sets, expected, _ = brute_components(copied_rows, words)
    table = clashing(documents(copied_rows))
    rows = near_copies(table, words=words, workspace=workspace).collect()
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows)
    assert got == sorted(
        (str(doc_id), len(s), str(c if s else doc_id))
        for (doc_id, _), s, c in zip(copied_rows, sets, expected, strict=True)
    )


def test_hot_buckets_in_blocks(documents, workspace, monkeypatch):
    """Many near copies that do not all link with each other."""
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, edited(rng, base, 0.045)) for i in range(80)]
    _, expected, _ = brute_components(rows, 2)
    got = {r.doc_id: r.component_id for r in near_copies(documents(rows), 2, workspace=workspace).collect()}
    assert [got[i] for i in range(80)] == expected


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(30):
        common, own = rng.integers(0, 2**63, 400), rng.integers(0, 2**63, (2, 100))
        a, b = (np.unique(np.concatenate([common, part]).astype(np.uint64) * 2) for part in own)
        agree = (minhash.signature(a) == minhash.signature(b)).mean()
        errors.append(agree - 400 / 600)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_one_document_of_each_group_stays(documents, clashing, copied_rows, workspace):
    _, _, union = brute_components(copied_rows, 5)
    kept = drop_near_copies(clashing(documents(copied_rows)), workspace=workspace)
    rows = kept.collect()
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    empty = sum(not (text or "").split() for _, text in copied_rows)
    groups = len({union.find(i) for i, (_, text) in enumerate(copied_rows) if (text or "").split()})
    assert len(rows) == groups + empty
    assert sum(row.doc_id == 0 for row in rows) == 1 and not any(row.doc_id == 200 for row in rows)


def test_text_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    sets, expected, _ = brute_components(rows, 2)
    got = {r.doc_id: r for r in op8_near_copies(spark, SF).collect()}
    for (doc_id, _), shingle_set, component in zip(rows, sets, expected, strict=True):
        row = got[doc_id]
        assert (row.n_shingles, row.component_id) == (len(shingle_set), component)
        assert row.kept == (doc_id == component)


def test_no_texts(documents, workspace):
    table = documents([])
    assert near_copies(table, workspace=workspace).count() == 0
    assert drop_near_copies(table, workspace=workspace).count() == 0
    assert drop_near_copies(documents([(1, None), (1, None)]), workspace=workspace).count() == 2


def brute_links(rows, threshold=0.9):
    width = 16
    good = []
    for i, (_, vector) in enumerate(rows):
        if vector is not None and len(vector) == width and None not in vector:
            numbers = np.array(vector, float)
            if np.isfinite(numbers).all() and numbers.any():
                numbers /= np.abs(numbers).max()
                good.append((i, numbers / np.linalg.norm(numbers)))
    union, links = Union(), [0] * len(rows)
    for i in range(len(rows)):
        union.find(i)
    for i, a in good:
        for j, b in good:
            if i != j and a @ b >= threshold:
                links[i] += 1
                union.join(i, j)
    ids = defaultdict(list)
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            ids[union.find(i)].append(vec_id)
    return links, [min(ids[union.find(i)], default=None) for i in range(len(rows))]


@pytest.fixture(scope="module")
def vector_rows():
    rng = np.random.default_rng(2)
    rows = []
    for spread, size in ((0.02, 150), (0.05, 40), (0.07, 25)):
        centre = rng.normal(size=16)
        rows += [centre + rng.normal(size=16) * spread * np.linalg.norm(centre) for _ in range(size)]
    rows += list(rng.normal(size=(300, 16)))
    rows += [rows[3]] * 20
    vectors = [[float(x) for x in row] for row in rows]
    found = list(enumerate(vectors))
    found += [(None, vectors[4]), (None, [9.0] * 15 + [1.0]), (5, vectors[5]), (5, vectors[5])]
    nan, inf = float("nan"), float("inf")
    found += [(900, None), (901, [0.0] * 16), (902, [nan] * 16), (903, [inf] + [1.0] * 15)]
    found += [(904, [None] + [1.0] * 15), (905, [1.0, 2.0]), (906, []), (907, [1e-100] * 16), (908, [1e200] * 16)]
    return found


def test_vector_links_against_brute_force(spark, vector_rows, workspace, monkeypatch):
    monkeypatch.setattr(neighbours, "COMPONENT_BLOCK", 32)
    monkeypatch.setattr(neighbours, "BLOCK", 32)
    monkeypatch.setattr(neighbours, "MAX_BLOCK", 64)
    table = spark.createDataFrame(vector_rows, "vec_id bigint, embedding array<double>").repartition(3)
    for name in ("label", "node", "unit", "copies"):
        table = table.withColumn(name, F.lit(1))
    rows = near_vectors(table, neighbours=8, workspace=workspace).collect()
    links, components = brute_links(vector_rows)
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in rows)
    expected = sorted(
        (str(vec_id), n, str(c)) for (vec_id, _), n, c in zip(vector_rows, links, components, strict=True)
    )
    assert got == expected


def test_links_between_saturated_groups(spark, workspace, monkeypatch):
    """One link between two groups whose vectors all have nearer links than they can list."""
    monkeypatch.setattr(neighbours, "AUDITED", 1)
    rng = np.random.default_rng(4)
    degrees = np.concatenate([rng.uniform(-0.3, 0.3, 150), 28 + rng.uniform(-0.3, 0.3, 150), [1.5, 26.5]])
    plane = np.column_stack([np.cos(np.radians(degrees)), np.sin(np.radians(degrees))])
    vectors = np.hstack([plane, rng.normal(0, 0.001, (len(plane), 14))])
    rows = [(i, [float(x) for x in vector]) for i, vector in enumerate(vectors)]
    links, components = brute_links(rows)
    assert set(components) == {0} and max(links) == 151
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = near_vectors(table, neighbours=8, workspace=workspace).orderBy("vec_id").collect()
    assert [(r.n_links, r.component_id) for r in found] == list(zip(links, components, strict=True))


@pytest.fixture
def settled(spark, workspace):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(60)]
    _, classes = neighbours._classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), workspace)
    points = workspace.save(neighbours._points(classes), "points")
    first = neighbours._first_lists(points, 60, 4, workspace).withColumn("old", F.lit(False))
    lists = workspace.save(neighbours._merged(first, 4), "lists")
    return neighbours._settled(lists, points, 60, 4, workspace), points


def test_lists_grow_when_enlarged(settled, workspace):
    lists, points = settled
    assert {len(row.near) for row in lists.collect()} == {4}
    grown = neighbours._settled(lists, points, 60, 8, workspace)
    assert {len(row.near) for row in grown.collect()} == {8}


def test_no_group_grows_with_a_hub(spark, settled, workspace, monkeypatch):
    _, points = settled
    nodes = [row.node for row in points.collect()]
    rows = [(n, [nodes[0]], [0.5], -1.5) for n in nodes[1:]]
    star = spark.createDataFrame(rows, "node long, near array<long>, cosine array<float>, worst float")

    def found():
        entries = neighbours._refined(star, points, 60, workspace)
        return {(r.node, n) for r in entries.collect() for n in r.near}

    assert len(found()) == 60 * 59
    monkeypatch.setattr(neighbours, "HUB_BLOCK", 8)
    assert neighbours._around(star, points, 60, workspace).groupBy("group").count().agg(F.max("count")).first()[0] < 40
    assert len(found()) == 60 * 59


def test_vectors_of_two_lengths(spark, workspace):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.1, 0.0]), (5, [1.0, 0.0, 0.0])]
    table = spark.createDataFrame(rows + [(6, [1.0])], "vec_id bigint, embedding array<double>")
    found = near_vectors(table, workspace=workspace).orderBy("vec_id").collect()
    assert [(r.n_links, r.component_id) for r in found] == [(1, 1), (1, 1), (2, 3), (2, 3), (2, 3), (0, 6)]


def test_no_vectors(spark, workspace):
    for rows in ([], [(1, None)], [(1, [1.0, 0.0])]):
        table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
        found = near_vectors(table, workspace=workspace).collect()
        assert [(r.vec_id, r.n_links, r.component_id) for r in found] == [(row[0], 0, 1) for row in rows]


def test_vector_query_against_brute_force(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    numbers = np.array([v.embedding for v in vectors], float)
    unit = numbers / np.linalg.norm(numbers, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.9) & ~np.eye(len(unit), dtype=bool)
    got = {r.vec_id: r for r in op3_near_vectors(spark, SF).collect()}
    for vector, row in zip(vectors, linked, strict=True):
        assert got[vector.vec_id].n_links == row.sum()
        assert got[vector.vec_id].kept == (got[vector.vec_id].component_id == vector.vec_id)
