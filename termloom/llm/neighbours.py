"""Near copies of vectors by NN-descent.

Every vector keeps a list of its nearest known neighbours. The first lists come
from blocks: the signs of a few random projections put vectors that are close
into one block more often than not, and within a block all are compared. Then
lists are refined: whoever meets in the lists around one vector is compared, as
a neighbour's neighbour is likely a neighbour. That ends when few lists change.

Neighbours with a cosine of at least the threshold, in double precision, are
links, and links make components. A list full of links is saturated, so there
may be more than it can hold. Such vectors get second lists, of what is near
outside their component, searched in the same way; links found there make
components larger, until no more are found. Within a component the members are
compared block by block, and every link in it is counted. No table of pairs is
made for that.

An audit compares a bounded sample of the vectors with all others. If a link
leads out of its component, the lists are too short: they are doubled, and
refined on, and what the audit found is linked too. That is done three times at
most; links still missed then are reported as a warning.

Equal vectors are one class from the beginning; they link with each other and
with the same others. Vectors of different lengths do not link; each length is
searched by itself. Vectors that are null, zero, or hold null or non-finite
components link with nothing. Null ids take
part; a component's id is the smallest that is not null. Repeated rows are equal
vectors. Empty tables give no row.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import prepare_workers, run_bounds, vectors_of, whole_groups
from termloom.llm.components import connected_components
from termloom.operators.joins import measure
from termloom.plans.workspace import Workspace

THRESHOLD = 0.9
NEIGHBOURS = 16
TABLES = 6
# Vectors that a block is meant to hold, and may hold before it is split.
BLOCK = 128
MAX_BLOCK = 256
MAX_ROUNDS = 6
# Lists are refined until fewer than this share of their entries change.
SETTLED = 0.01
# Members of a component that are compared with each other at a time.
COMPONENT_BLOCK = 128
# Vectors around one vector that are compared in one group; more are dealt.
HUB_BLOCK = 512
AUDITED = 512
MAX_ENLARGED = 3
SEED = 3
_CHUNK = 20_000


def _classes(vectors: DataFrame, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """(vec_id, key) of every row, and one row for each valid, distinct vector."""
    # Minus zero and zero are one number with two sets of bits.
    numbers = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.select("vec_id", numbers.alias("vector"))
    not_zero = F.exists("vector", lambda x: x != 0)
    finite = ~F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    valid = F.coalesce(F.col("vector").isNotNull() & finite & not_zero, F.lit(False))
    rows = rows.select("vec_id", F.when(valid, F.col("vector")).alias("vector"))
    grouped = (
        rows.filter(F.col("vector").isNotNull())
        .groupBy("vector")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
    )
    # The ids are fixed by being written.
    classes = workspace.save(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    return rows, classes


def _points(classes: DataFrame) -> DataFrame:
    """(node, unit, label): each unit vector as half-precision bytes, with a label of its own."""

    def units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit = _unit(vectors_of(batch.column("vector"), np.float64)).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), pa.array([row.tobytes() for row in unit], pa.binary())],
                    names=["node", "unit"],
                )

    halves = classes.select("node", "vector").mapInArrow(units, "node long, unit binary")
    return halves.withColumn("label", F.col("node"))


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither vanish nor overflow.
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _halves(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.to_pylist()
    flat = np.frombuffer(b"".join(values), np.float16)
    return flat.reshape(len(values), -1).astype(np.float32)


def _first_lists(
    points: DataFrame, total: int, k: int, workspace: Workspace, seed: int = SEED
) -> DataFrame:
    """(node, near, cosine) with up to k entries of other labels for each node and table."""
    bits = max(1, int(np.ceil(np.log2(max(2, total / BLOCK)))))

    def signs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _halves(batch.column("unit"))
            rng = np.random.default_rng(seed)
            powers = 1 << np.arange(bits, dtype=np.int64)
            for table in range(TABLES):
                planes = rng.normal(size=(unit.shape[1], bits)).astype(np.float32)
                code = ((unit @ planes) > 0) @ powers + (table << 48)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code), *(batch.column(name) for name in ("node", "unit", "label"))],
                    names=["code", "node", "unit", "label"],
                )

    placed = points.select("node", "unit", "label").mapInArrow(
        signs, "code long, node long, unit binary, label long"
    )
    placed = workspace.save(placed, "signs")
    crowded = placed.groupBy("code").count().filter(F.col("count") > MAX_BLOCK)
    crowded = workspace.save(crowded, "crowded")
    side = F.broadcast(crowded) if measure(crowded).broadcastable else crowded.hint("merge")
    parts = F.coalesce(F.ceil(F.col("count") / MAX_BLOCK), F.lit(1))
    blocks = placed.join(side, "code", "left").select(
        F.xxhash64("code", F.pmod(F.xxhash64("node", "code"), parts)).alias("block"),
        "node",
        "unit",
        "label",
    )

    def nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "block", 4 * MAX_BLOCK):
            nodes, unit = rows.column("node").to_numpy(), _halves(rows.column("unit"))
            labels, worst = rows.column("label").to_numpy(), np.full(len(nodes), -1.5, np.float32)
            bounds = run_bounds(rows.column("block").to_numpy())
            found = []
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                part = slice(start, end)
                found.append(_against(nodes, unit, worst, labels, part, part, k))
            yield _entries(found)

    sorted_blocks = blocks.repartition("block").sortWithinPartitions("block")
    return sorted_blocks.mapInArrow(nearest, "node long, near array<long>, cosine array<float>")


def _entries(found: list[list[tuple[int, np.ndarray, np.ndarray]]]) -> pa.RecordBatch:
    rows = [row for part in found for row in part]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row[0] for row in rows], pa.int64()),
            pa.array([row[1] for row in rows], pa.list_(pa.int64())),
            pa.array([row[2] for row in rows], pa.list_(pa.float32())),
        ],
        names=["node", "near", "cosine"],
    )


def _merged(entries: DataFrame, k: int) -> DataFrame:
    """(node, near, cosine, worst, changed): each node's k nearest of all its entries.

    Entries carry ``old``, whether they were in the list before.
    """

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "node", _CHUNK):
            near = rows.column("near").combine_chunks()
            lengths = np.diff(near.offsets.to_numpy())
            node = np.repeat(rows.column("node").to_numpy(), lengths)
            old = np.repeat(rows.column("old").to_numpy(zero_copy_only=False), lengths)
            near = near.flatten().to_numpy()
            cosine = rows.column("cosine").combine_chunks().flatten().to_numpy()
            order = np.lexsort((~old, near, node))
            node, near, cosine, old = node[order], near[order], cosine[order], old[order]
            once = np.ones(len(node), bool)
            once[1:] = (node[1:] != node[:-1]) | (near[1:] != near[:-1])
            node, near, cosine, old = node[once], near[once], cosine[once], old[once]
            order = np.lexsort((near, -cosine, node))
            node, near, cosine, old = node[order], near[order], cosine[order], old[order]
            bounds = run_bounds(node)
            rank = np.arange(len(node)) - np.repeat(bounds[:-1], np.diff(bounds))
            kept = rank < k
            node, near, cosine, old = node[kept], near[kept], cosine[kept], old[kept]
            bounds = run_bounds(node).astype(np.int32)
            starts, ends = bounds[:-1], bounds[1:]
            full = ends - starts >= k
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node[starts]),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(near)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(cosine)),
                    pa.array(np.where(full, cosine[ends - 1], -1.5).astype(np.float32)),
                    pa.array(np.add.reduceat((~old).astype(np.int64), starts)),
                ],
                names=["node", "near", "cosine", "worst", "changed"],
            )

    return (
        entries.repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(merge, "node long, near array<long>, cosine array<float>, worst float, changed long")
    )


def _around(
    lists: DataFrame, points: DataFrame, k: int, workspace: Workspace, inside: DataFrame | None = None
) -> DataFrame:
    """(group, block, node, unit, label, worst): the vectors in the lists around each vector.

    More than HUB_BLOCK around one are dealt into blocks, and each pair of blocks
    is a group, so no group grows with the lists a vector stands in.
    """
    near = lists.select("node", "near")
    near = near if inside is None else near.unionByName(inside.select("node", "near"))
    pairs = near.select("node", F.explode("near").alias("near"))
    members = (
        pairs.select(F.col("node").alias("hub"), F.col("near").alias("node"))
        .unionByName(pairs.select(F.col("near").alias("hub"), F.col("node").alias("node")))
        .unionByName(points.select(F.col("node").alias("hub"), "node"))
    )
    # A list shorter than k takes whatever comes, also if it was full before k grew.
    worst = F.when(F.size("near") >= k, F.col("worst")).otherwise(F.lit(-1.5))
    known = points.join(lists.select("node", worst.alias("worst")).hint("merge"), "node", "left")
    crowded = members.groupBy("hub").count().filter(F.col("count") > HUB_BLOCK)
    crowded = workspace.save(crowded, "crowded")
    side = F.broadcast(crowded) if measure(crowded).broadcastable else crowded.hint("merge")
    blocks = F.coalesce(F.ceil(F.col("count") / HUB_BLOCK), F.lit(1)).cast("int")
    dealt = (
        members.join(side, "hub", "left")
        .withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("node", "hub"), blocks).cast("int")})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("hub", F.least("block", "other"), F.greatest("block", "other")).alias("group"),
            "block",
            "node",
        )
    )
    return dealt.join(known.hint("merge"), "node").select(
        "group",
        "block",
        "node",
        "unit",
        "label",
        F.coalesce("worst", F.lit(-1.5)).cast("float").alias("worst"),
    )


def _refined(
    lists: DataFrame, points: DataFrame, k: int, workspace: Workspace, inside: DataFrame | None = None
) -> DataFrame:
    """Entries of other labels found among the neighbours, either way, of each vector."""
    around = _around(lists, points, k, workspace, inside)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "group", 4096):
            group, node = rows.column("group").to_numpy(), rows.column("node").to_numpy()
            block = rows.column("block").to_numpy()
            # Who is a neighbour in both directions is there twice.
            once = np.ones(len(group), bool)
            once[1:] = (group[1:] != group[:-1]) | (block[1:] != block[:-1]) | (node[1:] != node[:-1])
            unit = _halves(rows.column("unit"))[once]
            worst, label = (rows.column(name).to_numpy()[once] for name in ("worst", "label"))
            group, node, block = group[once], node[once], block[once]
            bounds = run_bounds(group)
            found = []
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                cut = int(np.searchsorted(block[start:end], block[end - 1])) + start
                first, second = slice(start, cut), slice(cut, end)
                # Of two blocks each meets the other, and itself in a group of its own.
                sides = [(first, second), (second, first)] if cut > start else [(second, second)]
                for part, others in sides:
                    found.append(_against(node, unit, worst, label, part, others, k))
            yield _entries(found)

    grouped = around.repartition("group").sortWithinPartitions("group", "block", "node")
    return grouped.mapInArrow(compare, "node long, near array<long>, cosine array<float>")


def _against(node, unit, worst, label, part: slice, group: slice, k: int):
    """What the vectors in ``part`` find in their group, of other labels than theirs."""
    k = min(k, group.stop - group.start)
    cosines = unit[part] @ unit[group].T
    cosines[label[part, None] == label[None, group]] = -2
    top = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    values = np.take_along_axis(cosines, top, 1)
    # Half precision repeats a cosine up to its last digits.
    good = values > worst[part, None] + 1e-6
    names = node[group]
    return [
        (name, names[top[i, good[i]]], values[i, good[i]])
        for i, name in enumerate(node[part].tolist())
        if good[i].any()
    ]


def _settled(
    lists: DataFrame,
    points: DataFrame,
    total: int,
    k: int,
    workspace: Workspace,
    inside: DataFrame | None = None,
) -> DataFrame:
    """The lists, refined until few entries change."""
    for _ in range(MAX_ROUNDS):
        entries = _refined(lists, points, k, workspace, inside).withColumn("old", F.lit(False))
        known = lists.select("node", "near", "cosine", F.lit(True).alias("old"))
        lists = workspace.save(_merged(known.unionByName(entries), k), "lists")
        if (lists.agg(F.sum("changed")).first()[0] or 0) <= SETTLED * total * k:
            break
    return lists


def _leading_out(
    lists: DataFrame,
    points: DataFrame,
    classes: DataFrame,
    labels: DataFrame,
    threshold: float,
    k: int,
    workspace: Workspace,
    seed: int,
) -> DataFrame | None:
    """Links (a, b) between components, of vectors whose lists are full of links.

    They get second lists that hold none of their own component, so what is near
    there fills no place. None if fewer than two components have full lists.
    """
    is_full = (F.size("near") >= k) & (F.element_at("cosine", -1) >= threshold - 0.01)
    full = lists.filter(is_full).select("node").join(labels.hint("merge"), "node", "left")
    full = workspace.save(full.select("node", F.coalesce("label", "node").alias("label")), "full")
    if full.select("label").distinct().limit(2).count() < 2:
        return None
    part = workspace.save(points.drop("label").join(full.hint("merge"), "node"), "full-points")
    total = part.count()
    first = _first_lists(part, total, k, workspace, seed).withColumn("old", F.lit(False))
    outside = workspace.save(_merged(first, k), "outside")
    outside = _settled(outside, part, total, k, workspace, inside=lists)
    return workspace.save(_linked(outside, classes, threshold), "leading-out")


def _linked(lists: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of list entries that are links in double precision."""
    close = lists.select("node", F.explode(F.arrays_zip("near", "cosine")).alias("entry")).filter(
        F.col("entry.cosine") >= threshold - 0.01
    )
    pairs = close.select(
        F.least("node", "entry.near").alias("a"), F.greatest("node", "entry.near").alias("b")
    ).distinct()
    sides = classes.select("node", "vector")
    joined = pairs.join(sides.toDF("a", "v_a").hint("merge"), "a").join(
        sides.toDF("b", "v_b").hint("merge"), "b"
    )

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left = _unit(vectors_of(batch.column("v_a"), np.float64))
                right = _unit(vectors_of(batch.column("v_b"), np.float64))
                linked = np.einsum("ij,ij->i", left, right) >= threshold
                yield batch.select(["a", "b"]).filter(pa.array(linked))

    return joined.select("a", "b", "v_a", "v_b").mapInArrow(check, "a long, b long")


def _counted(classes: DataFrame, labels: DataFrame, threshold: float, workspace: Workspace) -> DataFrame:
    """(node, links): links of each member of a component, copies counted.

    Components are dealt into blocks and each pair of blocks is compared in one
    group, so no group grows with the component.
    """
    sizes = workspace.save(labels.groupBy("label").agg(F.count("*").alias("size")), "sizes")
    side = F.broadcast(sizes) if measure(sizes).broadcastable else sizes.hint("merge")
    blocks = F.ceil(F.col("size") / COMPONENT_BLOCK).cast("int")
    dealt = (
        labels.join(side, "label")
        .withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("node"), blocks).cast("int")})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node",
            "block",
            F.xxhash64("label", F.least("block", "other"), F.greatest("block", "other")).alias("group"),
        )
    )
    members = dealt.join(classes.select("node", "vector", "copies").hint("merge"), "node")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "group", 1024):
            bounds = run_bounds(rows.column("group").to_numpy())
            node, block = rows.column("node").to_numpy(), rows.column("block").to_numpy()
            copies = rows.column("copies").to_numpy().astype(np.float64)
            unit = _unit(vectors_of(rows.column("vector"), np.float64))
            links = np.zeros(len(node))
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                part = slice(start, end)
                linked = unit[part] @ unit[part].T >= threshold
                own = block[part]
                if own.min() != own.max():
                    linked &= own[:, None] != own[None, :]
                np.fill_diagonal(linked, False)
                links[part] = linked @ copies[part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(links.astype(np.int64))], names=["node", "links"]
            )

    grouped = members.repartition("group").sortWithinPartitions("group")
    return (
        grouped.mapInArrow(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    )


def _audit(
    classes: DataFrame, labels: DataFrame, threshold: float, total: int, workspace: Workspace
) -> tuple[float, DataFrame]:
    """Share of links within components, as a mean over the sampled vectors, and the other links.

    A mean over vectors, as the links of one large component would outweigh all others.
    """
    share = min(1.0, AUDITED / max(1, total))
    labelled = classes.join(labels.hint("merge"), "node", "left").select(
        "node", "vector", F.coalesce("label", "node").alias("label")
    )
    labelled = workspace.save(labelled, "audited")
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "node"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    queries = labelled.filter(drawn).orderBy(F.xxhash64(F.lit(SEED), "node")).limit(2 * AUDITED).toPandas()
    unit = _unit(np.array(queries["vector"].tolist(), float)) if len(queries) else np.zeros((0, 1))
    shared = classes.sparkSession.sparkContext.broadcast(
        (queries["node"].to_numpy(), queries["label"].to_numpy(), unit)
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, query_labels, sample = shared.value
        for batch in batches:
            if not batch.num_rows or not len(nodes):
                continue
            node, label = batch.column("node").to_numpy(), batch.column("label").to_numpy()
            vectors = _unit(vectors_of(batch.column("vector"), np.float64))
            for at in range(0, len(node), 2048):
                part = slice(at, at + 2048)
                linked = (sample @ vectors[part].T >= threshold) & (nodes[:, None] != node[None, part])
                missed = linked & (query_labels[:, None] != label[None, part])
                q, p = np.nonzero(missed)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(nodes[q], nodes)),
                        pa.array(np.append(node[part][p], np.full(len(nodes), -1))),
                        pa.array(np.append(np.zeros(len(q), np.int64), linked.sum(1))),
                    ],
                    names=["a", "b", "links"],
                )

    found = workspace.save(labelled.mapInArrow(search, "a long, b long, links long"), "audit")
    of_vector = found.groupBy("a").agg(
        F.sum("links").alias("links"), F.sum((F.col("b") >= 0).cast("long")).alias("missed")
    )
    missed = of_vector.filter("links > 0").agg(F.avg(F.col("missed") / F.col("links"))).first()[0]
    return 1 - (missed or 0.0), found.filter("b >= 0").select("a", "b")


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    neighbours: int = NEIGHBOURS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """(vec_id, n_links, component_id) of every row of (vec_id, embedding)."""
    spark = vectors.sparkSession
    prepare_workers(spark)
    workspace = workspace or Workspace(spark)
    rows, classes = _classes(vectors, workspace)
    widths = sorted(row[0] for row in classes.select(F.size("vector")).distinct().collect())
    of_class = classes.limit(0).select(
        "vector", F.col("copies").alias("n_links"), F.col("least_id").alias("component_id")
    )
    for width in widths:
        alike = classes if len(widths) == 1 else classes.filter(F.size("vector") == width)
        of_class = of_class.unionByName(_of_width(alike, threshold, neighbours, workspace))
    found = rows.join(of_class.hint("merge"), "vector", "left")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )


def _of_width(classes: DataFrame, threshold: float, k: int, workspace: Workspace) -> DataFrame:
    """(vector, n_links, component_id) of classes whose vectors have one length."""
    total = classes.count()
    if total == 1:
        return classes.select(
            "vector", (F.col("copies") - 1).alias("n_links"), F.col("least_id").alias("component_id")
        )
    points = workspace.save(_points(classes), "points")
    first = _first_lists(points, total, k, workspace)
    lists = workspace.save(_merged(first.withColumn("old", F.lit(False)), k), "lists")
    links = workspace.save(_linked(lists, classes, threshold), "links")
    seed = SEED
    for enlarged in range(MAX_ENLARGED + 1):
        lists = _settled(lists, points, total, k, workspace)
        links = workspace.save(
            links.unionByName(_linked(lists, classes, threshold)).distinct(), "links"
        )
        labels = workspace.save(connected_components(links, workspace), "labels")
        while True:
            seed += 1
            out = _leading_out(lists, points, classes, labels, threshold, k, workspace, seed)
            if out is None or out.isEmpty():
                break
            links = workspace.save(links.unionByName(out).distinct(), "links")
            labels = workspace.save(connected_components(links, workspace), "labels")
        recall, missed = _audit(classes, labels, threshold, total, workspace)
        if recall == 1.0:
            break
        links = workspace.save(links.unionByName(missed), "links")
        labels = workspace.save(connected_components(links, workspace), "labels")
        if enlarged == MAX_ENLARGED:
            warnings.warn(f"links of sampled vectors found: {recall:.4f}, not all", stacklevel=2)
            break
        k *= 2
    counted = workspace.save(_counted(classes, labels, threshold, workspace), "counted")
    least = workspace.save(
        labels.join(classes.select("node", "least_id").hint("merge"), "node")
        .groupBy("label")
        .agg(F.min("least_id").alias("component_id")),
        "least",
    )
    return workspace.save(
        classes.select("vector", "node", "copies", "least_id")
        .join(labels.hint("merge"), "node", "left")
        .join(least.hint("merge"), "label", "left")
        .join(counted.hint("merge"), "node", "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "least_id").alias("component_id"),
        ),
        "of-class",
    )
