"""Near copies by circulant MinHash, banding and exact Jaccard similarity.

A document's set is its distinct shingles of ``words`` words. Circulant MinHash
needs two permutations only: the first, a hash, deals shingles to places on a
circle; the second gives each place a rank, and the k-th coordinate of a
signature is the least rank of the set's places after turning the circle by k.
The ranks of a place's next places lie side by side, so all coordinates of a
shingle are one read.

1. Texts become (size, digest of the set, signature). Texts with the same set
   are one class from here on, however many they are.
2. Signatures are cut into bands. Within a bucket every member is paired with
   the smallest one, which is a row for each member, not for each pair.
3. Pairs whose signatures agree enough are confirmed on the full sets, made
   anew from both texts, and components are formed.
4. Buckets that still hold several components are compared within, large ones
   block by block: pairs across components whose signatures agree are confirmed
   on the full sets where they lie, and the links that connect what was apart
   are kept, fewer than there are members. So every pair that shares a bucket is
   linked, connected already, or refuted, and no table of pairs is made.

At 24 bands of 5 a pair with similarity 0.8 shares no bucket with a chance of
0.0001. Agreement is asked for with a margin of five standard deviations.

Texts without words, null ones included, have no shingles and link with
nothing. Null ids take part; a component's id is its smallest id that is not
null. Repeated rows are copies. Empty tables give no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import key_runs, prepare_workers
from termloom.llm.components import connected_components
from termloom.operators.joins import measure
from termloom.plans.workspace import Workspace

WORDS = 5
PERCENT = 80
BANDS = 24
ROWS = 5
COORDINATES = BANDS * ROWS
PLACES_BITS = 21
SEED = 8
# Members of a bucket that are compared with each other at a time.
BLOCK = 512
# Words whose hashes a worker remembers.
CACHED_WORDS = 200_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Hashes(dict):
    """Word to 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value


_hashes = _Hashes()
_ranks: list[np.ndarray] = []


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    A-Z are lower-cased and words end at ASCII white space. A text with fewer
    words is one shingle.
    """
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(_hashes) > CACHED_WORDS:
        _hashes.clear()
    each = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(each))
    n = len(each) - width + 1
    value = np.full(n, width, np.uint64)
    for k in range(width):
        value = _mixed(value * _MULTIPLIER + each[k : k + n])
    return np.unique(value)


def _circle() -> np.ndarray:
    """Row i holds the ranks of place i and the places after it."""
    if not _ranks:
        ranks = np.random.default_rng(SEED).permutation(1 << PLACES_BITS).astype(np.uint32)
        ranks = np.concatenate([ranks, ranks[:COORDINATES]])
        _ranks.append(np.lib.stride_tricks.sliding_window_view(ranks, COORDINATES))
    return _ranks[0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of a set that is not empty."""
    circle = _circle()
    places = (shingles >> np.uint64(64 - PLACES_BITS)).astype(np.int64)
    least = np.full(COORDINATES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(places), 4096):
        np.minimum(least, circle[places[at : at + 4096]].min(0), out=least)
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key for each signature and band."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        keys = _mixed(keys * _MULTIPLIER + parts[:, :, k])
    return keys.view(np.int64)


def least_agreement(percent: int) -> int:
    """Coordinates that agree in all but about one in a million linked pairs."""
    share = percent / 100
    return max(1, int(COORDINATES * (share - 5 * np.sqrt(share * (1 - share) / COORDINATES))))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sketches(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, row, n, node, signature); node is null without shingles."""
    table = documents.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    id_type = table.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, signatures = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py() or "", words)
                sizes.append(len(shingles))
                if len(shingles):
                    nodes.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    signatures.append(signature(shingles).tobytes())
                else:
                    nodes.append(None)
                    signatures.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "row", "n", "node", "signature"],
            )

    return table.mapInArrow(sketch, f"doc_id {id_type}, row long, n long, node binary, signature binary")


def _bands(classes: DataFrame) -> DataFrame:
    """(bucket, node) of every band."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_matrix(batch.column("signature")))
                nodes = batch.column("node").take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), nodes], names=["bucket", "node"]
                )

    return classes.select("node", "signature").mapInArrow(cut, "bucket long, node binary")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _small_or_merge(table: DataFrame, *keys: str) -> DataFrame:
    """The table, broadcast if its measured size allows it, else for a merge join."""
    return F.broadcast(table) if measure(table, *keys).broadcastable else table.hint("merge")


def _agreeing(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow a link."""
    sized = classes.select("node", "n", "signature")
    joined = pairs.join(sized.toDF("a", "n_a", "s_a").hint("merge"), "a").join(
        sized.toDF("b", "n_b", "s_b").hint("merge"), "b"
    )
    fitting = joined.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    needed = least_agreement(percent)

    def agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_matrix(batch.column("s_a")) == _matrix(batch.column("s_b"))).sum(1)
                yield batch.select(["a", "b"]).filter(pa.array(same >= needed))

    return fitting.select("a", "b", "s_a", "s_b").mapInArrow(agree, "a binary, b binary")


def _texts(documents: DataFrame, classes: DataFrame, nodes: DataFrame, workspace: Workspace) -> DataFrame:
    """(node, text) of the classes named, one text each."""
    rows = workspace.save(
        classes.join(nodes.distinct(), "node", "left_semi").select("node", F.col("row").alias("__row")),
        "wanted",
    )
    found = documents.select(F.xxhash64("doc_id", "text").alias("__row"), "text").join(
        _small_or_merge(rows, "node"), "__row"
    )
    # Of repeated rows one text is enough.
    return workspace.save(found.groupBy("node").agg(F.first("text").alias("text")), "texts")


def _confirmed(
    documents: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int, workspace: Workspace
) -> DataFrame:
    """Pairs whose full sets are similar, from the texts of their classes."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    texts = _texts(documents, classes, ends, workspace)
    joined = pairs.join(texts.toDF("b", "t_b").hint("merge"), "b").join(
        texts.toDF("a", "t_a").hint("merge"), "a"
    )

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, np.ndarray] | None = None
        for batch in batches:
            linked = []
            columns = [batch.column(name) for name in ("a", "t_a", "t_b")]
            for a, t_a, t_b in zip(*columns, strict=True):
                key = a.as_py()
                if last is None or last[0] != key:
                    last = key, shingle_set(t_a.as_py(), words)
                linked.append(similar(last[1], shingle_set(t_b.as_py(), words), percent))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return joined.select("a", "b", "t_a", "t_b").mapInArrow(confirm, "a binary, b binary")


def _linked_across(
    documents: DataFrame, classes: DataFrame, members: DataFrame, words: int, percent: int, workspace: Workspace
) -> DataFrame:
    """Links (a, b) that connect different labels of a bucket.

    ``members`` has (bucket, node, label, size). A bucket of more than BLOCK
    members is dealt into blocks, and each pair of blocks is a group.
    """
    texts = _texts(documents, classes, members.select("node"), workspace)
    known = workspace.save(
        classes.select("node", "n", "signature").join(texts.hint("merge"), "node"), "members"
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = members.withColumns(
        {"blocks": blocks, "block": F.pmod(F.xxhash64("node"), blocks).cast("int")}
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = dealt.select(
        F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("group"),
        "node",
        "label",
        "block",
    ).join(known.hint("merge"), "node")
    dealt_out = grouped.repartition("group").sortWithinPartitions("group", "node")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, "group"):
            nodes = rows.column("node").combine_chunks()
            a, b = _connecting(rows, words, percent)
            if a:
                ends = (nodes.take(pa.array(side, pa.int64())) for side in (a, b))
                yield pa.RecordBatch.from_arrays(list(ends), names=["a", "b"])

    return dealt_out.mapInArrow(compare, "a binary, b binary").distinct()


def _connecting(rows: pa.Table, words: int, percent: int) -> tuple[list[int], list[int]]:
    """Rows of a group that link across what is not connected yet."""
    _, part = np.unique(np.array(rows.column("label").to_pylist(), object), return_inverse=True)
    n, block = rows.column("n").to_numpy(), rows.column("block").to_numpy()
    signatures, texts = _matrix(rows.column("signature")), rows.column("text")
    one_block = block.min() == block.max()
    needed = least_agreement(percent)
    sets: dict[int, np.ndarray] = {}

    def full(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_set(texts[i].as_py(), words)
        return sets[i]

    first, second = [], []
    for i in range(len(n) - 1):
        rest = slice(i + 1, None)
        ask = (part[rest] != part[i]) & (
            100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])
        )
        if not one_block:
            ask &= block[rest] != block[i]
        others = np.flatnonzero(ask) + i + 1
        if len(others):
            others = others[(signatures[others] == signatures[i]).sum(1) >= needed]
        for j in others.tolist():
            if part[i] != part[j] and similar(full(i), full(j), percent):
                first.append(i)
                second.append(j)
                part[part == part[j]] = part[i]
    return first, second


def near_copies(
    documents: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    workspace: Workspace | None = None,
) -> DataFrame:
    """(doc_id, row, n_shingles, group, component_id) of every document.

    ``row`` is a hash of id and text, ``group`` the component's name (null for
    a text without words), ``component_id`` the smallest id in it.
    """
    spark = documents.sparkSession
    prepare_workers(spark)
    workspace = workspace or Workspace(spark)
    sketches = workspace.save(_sketches(documents, words), "sketches")
    classes = workspace.save(
        sketches.filter("n > 0")
        .groupBy("node")
        .agg(
            F.min(F.struct("row", "n", "signature")).alias("least"),
            F.min("doc_id").alias("doc_id"),
        )
        .select("node", "least.*", "doc_id"),
        "classes",
    )
    bands = workspace.save(_bands(classes), "bands")
    buckets = (
        bands.groupBy("bucket")
        .agg(
            F.min("node").alias("pivot"),
            F.count("*").alias("size"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
            F.bit_xor(F.xxhash64("node", F.lit(SEED))).alias("y"),
        )
        .filter("size > 1")
    )
    # Of buckets with the same members one is enough.
    buckets = workspace.save(
        buckets.groupBy("pivot", "size", "x", "y").agg(F.min("bucket").alias("bucket")).drop("x", "y"),
        "buckets",
    )
    shared = workspace.save(bands.join(_small_or_merge(buckets, "pivot"), "bucket"), "shared")
    stars = (
        shared.filter(F.col("node") != F.col("pivot"))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    candidates = workspace.save(_agreeing(stars, classes, percent), "star-pairs")
    links = workspace.save(
        _confirmed(documents, classes, candidates, words, percent, workspace), "star-links"
    )
    labels = workspace.save(connected_components(links, workspace), "star-labels")

    labelled = shared.join(_small_or_merge(labels, "node", "label"), "node", "left").select(
        "bucket", "node", "size", F.coalesce("label", "node").alias("label")
    )
    labelled = workspace.save(labelled, "labelled")
    split = workspace.save(
        labelled.groupBy("bucket")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .filter("least != most")
        .select("bucket"),
        "split-buckets",
    )
    open_members = labelled.join(_small_or_merge(split), "bucket", "left_semi")
    open_members = workspace.save(open_members, "open-members")
    cross = _linked_across(documents, classes, open_members, words, percent, workspace)
    links = workspace.save(links.unionByName(cross), "links")
    labels = workspace.save(connected_components(links, workspace), "labels")
    return _with_components(sketches, classes, labels, workspace)


def _with_components(
    sketches: DataFrame, classes: DataFrame, labels: DataFrame, workspace: Workspace
) -> DataFrame:
    grouped = classes.select("node", "doc_id").join(labels.hint("merge"), "node", "left")
    grouped = workspace.save(grouped.withColumn("label", F.coalesce("label", "node")), "grouped")
    least = workspace.save(
        grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("k")),
        "least",
    )
    # Only classes that lie with others need their component looked up.
    several = grouped.join(_small_or_merge(least.filter("k > 1"), "label"), "label").select(
        "node", "label", "component_id"
    )
    several = workspace.save(several, "several")
    own = classes.select("node", F.col("doc_id").alias("own_id"))
    named = sketches.select("doc_id", "row", "n", "node").join(own.hint("merge"), "node", "left")
    found = named.join(_small_or_merge(several, "node", "label"), "node", "left")
    return found.select(
        "doc_id",
        "row",
        F.col("n").alias("n_shingles"),
        F.coalesce("label", "node").alias("group"),
        F.when(F.col("node").isNull(), F.col("doc_id"))
        .when(F.col("label").isNull(), F.col("own_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def drop_near_copies(
    documents: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    workspace: Workspace | None = None,
) -> DataFrame:
    """The documents with one of each component, every column kept.

    The one with the smallest id stays, null ids last; of repeated rows, which
    are alike in id and text, one. Texts without words all stay.
    """
    spark = documents.sparkSession
    workspace = workspace or Workspace(spark)
    copies = workspace.save(near_copies(documents, words, percent, workspace), "copies")
    grouped = copies.filter(F.col("group").isNotNull())
    first = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), "row")
    chosen = workspace.save(
        grouped.groupBy("group").agg(F.min(first).alias("first"), F.count("*").alias("k")).filter("k > 1"),
        "chosen",
    )
    members = grouped.join(_small_or_merge(chosen, "group"), "group")
    here = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), "row")
    dropped = workspace.save(members.filter(here != F.col("first")).select("row").distinct(), "dropped")
    # Chosen rows that are there more than once.
    repeated = workspace.save(
        members.filter(here == F.col("first")).groupBy("row").count().filter("count > 1").select("row"),
        "repeated",
    )
    rows = documents.withColumn("__row", F.xxhash64("doc_id", "text"))
    kept = rows.join(
        _small_or_merge(dropped.withColumnRenamed("row", "__row")), "__row", "left_anti"
    )
    again = _small_or_merge(repeated.withColumnRenamed("row", "__row"))
    columns = documents.columns
    once = kept.join(again, "__row", "left_anti").select(*[f"`{name}`" for name in columns])
    twins = kept.join(again, "__row", "left_semi")
    one = twins.groupBy("__row").agg(
        F.first(F.struct(*[F.col(f"`{name}`") for name in columns])).alias("__one")
    )
    return once.unionByName(one.select("__one.*"))
