"""Mixing sources to target weights by a splitting tree over blocks.

The plan, all of it from bounded statistics:

1. Every source's size and target. Targets share ``factor`` times all sizes by
   weight; none is above ``most`` times its source's size, and what is cut off
   is shared again among the others by weight until none is above.
2. Every source is cut into blocks of about equal size, some ``BLOCKS`` in all,
   by the hash of its documents. A block is a random part of its source.
3. A target is so many whole passes over the blocks, and the first blocks of
   one more pass in an order drawn by chance. Within the block where the target
   is reached the documents up to it, in order of their hash, are taken; one
   document more, or one less, brings the sum as near as one document can.
4. The exact block quotas of the sources are split over the output shards by a
   tree: each node hands its left half a multivariate hypergeometric part of
   its blocks. A leaf draws so many blocks from each source's permuted list;
   lists are cut end to end, so the shards' draws are disjoint.
5. Documents find their draws by (source, block) in a broadcast table, are
   repeated once per draw, and lie in random order within their shard.

Texts are shuffled once, by the last step. All chance comes from the seed and
the documents, so reruns agree; a source that holds a third of all rows is as
many blocks.

A null source is a source of its own, after all others. Null and empty texts
have size 0: they come with their blocks and change no sum. Rows alike in id
and text share a hash and are taken together. An empty table gives no row.
Columns that the documents have besides are kept; __key, __hash, __source_size,
__target, __passes, __gap and __draws are names of the plan's own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TYPE_CHECKING, NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import WORD, driver_table
from termloom.plans.workspace import Workspace

if TYPE_CHECKING:
    import pandas as pd

# Blocks of all sources together, apart from one more per source.
BLOCKS = 8192
# More sources than this are refused: the plan is made on the driver.
MAX_SOURCES = 100_000
SHARD_WORDS = 1 << 22
MAX_SHARDS = 4096
SEED = 20_26
HASH_BITS = 52


def word_count(text: Column | str) -> Column:
    """Words of a text; a null one has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def water_fill(sizes: np.ndarray, weights: np.ndarray, total: float, most: float) -> np.ndarray:
    """Targets that share ``total`` by weight, none above ``most`` times its size."""
    caps = most * sizes.astype(float)
    targets = np.zeros(len(sizes))
    free = weights > 0
    rest = float(total)
    while free.any():
        share = rest * weights / weights[free].sum()
        over = free & (share >= caps)
        if not over.any():
            targets[free] = share[free]
            break
        targets[over] = caps[over]
        rest -= caps[over].sum()
        free &= ~over
    return targets


def splitting_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source (columns) for each shard (rows); columns add up to the quotas.

    Shards have equally many blocks, but for one.
    """
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    n_left = int(round(int(quotas.sum()) * left / shards))
    part = rng.multivariate_hypergeometric(quotas, n_left, method="marginals")
    return np.vstack(
        [splitting_tree(part, left, rng), splitting_tree(quotas - part, shards - left, rng)]
    )


@dataclass(frozen=True)
class Mix:
    """A plan: ``sources`` (source, size, target), and ``find``, which adds to
    documents __hash, __source_size, __target and __draws of (epoch, shard)."""

    sources: pd.DataFrame
    find: Callable[[DataFrame], DataFrame]
    shards: int
    seed: int


def _key() -> Column:
    """Source as text, so that null is a key like any other."""
    return F.when(F.col("source").isNull(), "n").otherwise(
        F.concat(F.lit("s"), F.col("source").cast("string"))
    )


def _hash(seed: int) -> Column:
    mask = F.lit((1 << HASH_BITS) - 1)
    return F.xxhash64(F.lit(seed), "doc_id", "text").bitwiseAND(mask)


def plan_mix(
    documents: DataFrame,
    weight: Callable[[int, str | None], float],
    factor: float,
    most: float = 2.0,
    shards: int | None = None,
    seed: int = SEED,
    size: Callable[[str], Column] = word_count,
    workspace: Workspace | None = None,
) -> Mix:
    """Plan a mix of ``factor`` times all sizes.

    ``weight`` gives the weight of the i-th source by code point, null last.
    ``shards`` are by default as many as hold ``SHARD_WORDS`` each.
    """
    spark = documents.sparkSession
    workspace = workspace or Workspace(spark)
    narrow = workspace.save(
        documents.select(_key().alias("key"), _hash(seed).alias("hash"), size("text").alias("size")),
        "sizes",
    )
    totals = narrow.groupBy("key").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).toPandas()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"a mix of more than {MAX_SOURCES} sources is refused")
    totals["source"] = [None if key == "n" else key[1:] for key in totals["key"]]
    totals["last"] = totals["source"].isna()
    totals = totals.sort_values(["last", "key"], ignore_index=True)
    totals["size"] = totals["size"].astype(np.int64)
    sizes = totals["size"].to_numpy()
    names = totals["source"].where(~totals["last"], None).tolist()
    weights = np.array([weight(i, name) for i, name in enumerate(names)], float)
    targets = water_fill(sizes, weights, factor * float(sizes.sum()), most)

    block_size = max(1.0, sizes.sum() / BLOCKS)
    n_blocks = np.maximum(1, np.round(sizes / block_size)).astype(np.int64)
    passes = np.where(sizes > 0, np.floor(targets / np.maximum(sizes, 1)), 0).astype(np.int64)
    rest = targets - passes * sizes
    per_source = list(zip(totals["key"].tolist(), n_blocks.tolist(), strict=True))
    by_key = F.broadcast(driver_table(spark, per_source, "key string, n_blocks long"))
    block = (F.col("hash") % F.col("n_blocks")).alias("block")
    placed = narrow.join(by_key, "key").select("key", "hash", "size", block)
    blocks = placed.groupBy("key", "block").agg(F.sum("size").alias("size")).toPandas()

    index = {key: i for i, key in enumerate(totals["key"])}
    block_sizes = [np.zeros(n, np.int64) for n in n_blocks]
    for key, number, words in blocks.itertuples(index=False):
        block_sizes[index[key]][number] = words
    rng = np.random.default_rng(seed)
    # (source, block, epoch, partial) of every draw.
    draws: list[tuple[np.ndarray, ...]] = []
    edges: list[tuple[str, int, float]] = []
    for i, key in enumerate(totals["key"]):
        order = rng.permutation(n_blocks[i])
        reached = np.cumsum(block_sizes[i][order])
        n_whole = int(np.searchsorted(reached, rest[i], side="right"))
        drawn = [(order, epoch, False) for epoch in range(passes[i])]
        drawn.append((order[:n_whole], passes[i], False))
        before = float(reached[n_whole - 1]) if n_whole else 0.0
        if n_whole < len(order) and sizes[i] > 0 and targets[i] > 0:
            edges.append((key, int(order[n_whole]), float(rest[i]) - before))
            drawn.append((order[n_whole : n_whole + 1], passes[i], True))
        for which, epoch, partial in drawn:
            n = len(which)
            draws.append((np.full(n, i), which, np.full(n, epoch), np.full(n, partial)))
    source, drawn_blocks, epochs, partials = (
        np.concatenate(column) if column else np.zeros(0, np.int64)
        for column in (list(zip(*draws, strict=True)) or [()] * 4)
    )

    quotas = np.bincount(source, minlength=len(totals)).astype(np.int64)
    n_shards = shards or min(MAX_SHARDS, max(1, int(-(-targets.sum() // SHARD_WORDS))))
    tree = splitting_tree(quotas, n_shards, rng) if len(quotas) else np.zeros((n_shards, 0), np.int64)
    # Each source's draws in an order by chance, cut end to end into the shards' parts.
    permuted = rng.permutation(len(source))
    permuted = permuted[np.argsort(source[permuted], kind="stable")]
    shard = np.tile(np.arange(n_shards), len(totals)).repeat(tree.T.ravel())
    keys = totals["key"].tolist()
    rows = driver_table(
        spark,
        list(
            zip(
                [keys[i] for i in source[permuted].tolist()],
                drawn_blocks[permuted].tolist(),
                epochs[permuted].tolist(),
                shard.tolist(),
                partials[permuted].astype(bool).tolist(),
                strict=True,
            )
        ),
        "key string, block long, epoch int, shard int, partial boolean",
    )
    by_block = rows.groupBy("key", "block").agg(
        F.sort_array(F.collect_list(F.struct("epoch", "shard", "partial"))).alias("draws")
    )

    def finder(limits: dict[str, Limit]) -> Callable[[DataFrame], DataFrame]:
        info = driver_table(
            spark,
            [
                (
                    key,
                    int(sizes[i]),
                    float(targets[i]),
                    int(n_blocks[i]),
                    int(passes[i]),
                    *limits.get(key, Limit()),
                )
                for i, key in enumerate(totals["key"])
            ],
            "key string, source_size long, target double, n_blocks long, passes int, "
            "up_to long, gap double, added long, removed long",
        )
        return lambda keyed: _with_draws(keyed, info, by_block, n_shards)

    limits = _limits(spark, placed, edges)
    limits = _nearer(narrow, finder(limits), limits)
    find = finder(limits)
    return Mix(
        totals[["source", "size"]].assign(target=targets),
        lambda docs: find(docs.withColumns({"__key": _key(), "__hash": _hash(seed)})),
        n_shards,
        seed,
    )


class Limit(NamedTuple):
    """Where the last pass over a source ends.

    The largest hash taken of its last block, the words missing then, and the
    hash of a document to add to the pass, or to take out of it; -1 is none.
    """

    up_to: int = -1
    gap: float = 0.0
    added: int = -1
    removed: int = -1


def _with_draws(keyed: DataFrame, info: DataFrame, by_block: DataFrame, n_shards: int) -> DataFrame:
    """Rows with __key and __hash, and __source_size, __target, __passes, __gap, __draws."""
    names = [f"__{name}" for name in info.columns]
    known = keyed.join(F.broadcast(info.toDF(*names).withColumnRenamed("__key", "__of")), F.col("__key") == F.col("__of"))
    blocks = by_block.toDF("__block_key", "__block", "__all")
    found = known.join(
        F.broadcast(blocks),
        (F.col("__key") == F.col("__block_key"))
        & (F.col("__hash") % F.col("__n_blocks") == F.col("__block")),
        "left",
    )
    last = lambda d: d["epoch"] == F.col("__passes")
    taken = F.filter(
        F.coalesce("__all", F.array().cast("array<struct<epoch:int,shard:int,partial:boolean>>")),
        lambda d: ~(
            last(d)
            & (
                (d["partial"] & (F.col("__hash") > F.col("__up_to")))
                | (F.col("__hash") == F.col("__removed"))
            )
        ),
    )
    added = F.array(
        F.struct(
            F.col("__passes").alias("epoch"),
            (F.col("__hash") % n_shards).cast("int").alias("shard"),
            F.lit(True).alias("partial"),
        )
    )
    draws = F.when(F.col("__hash") == F.col("__added"), F.concat(taken, added)).otherwise(taken)
    return found.withColumn("__draws", draws).drop(
        "__of", "__n_blocks", "__up_to", "__added", "__removed", "__block_key", "__block", "__all"
    )


def _limits(spark, placed: DataFrame, edges: list[tuple[str, int, float]]) -> dict[str, Limit]:
    """Documents of a last block are taken while their middle is before the goal."""
    if not edges:
        return {}
    last = F.broadcast(driver_table(spark, edges, "key string, edge long, goal double"))
    # Alike rows are one, so that no window is longer than a block has texts.
    alike = (
        placed.join(last, "key")
        .filter(F.col("block") == F.col("edge"))
        .groupBy("key", "hash")
        .agg(F.sum("size").alias("size"), F.first("goal").alias("goal"))
    )
    running = F.sum("size").over(Window.partitionBy("key").orderBy("hash"))
    inside = alike.withColumn("inside", running - F.col("size") / 2 <= F.col("goal"))
    found = inside.groupBy("key").agg(
        F.coalesce(F.max(F.when(F.col("inside"), F.col("hash"))), F.lit(-1)).alias("up_to"),
        (F.first("goal") - F.coalesce(F.sum(F.when(F.col("inside"), F.col("size"))), F.lit(0))).alias("gap"),
    )
    return {row["key"]: Limit(row["up_to"], row["gap"]) for row in found.collect()}


def _nearer(
    narrow: DataFrame, find: Callable[[DataFrame], DataFrame], limits: dict[str, Limit]
) -> dict[str, Limit]:
    """Limits with the one document that closes a source's gap best."""
    if not limits:
        return limits
    keyed = narrow.filter("size > 0").select(
        F.col("key").alias("__key"), F.col("hash").alias("__hash"), "size"
    )
    in_last = F.size("__draws") > F.col("__passes")
    left = F.abs(F.col("size") - F.abs("__gap"))
    best = (
        find(keyed)
        .filter((F.when(F.col("__gap") > 0, ~in_last).otherwise(in_last)) & (left < F.abs("__gap")))
        .groupBy("__key")
        .agg(F.min(F.struct(left.alias("left"), F.col("__hash").alias("hash"))).alias("best"))
        .select("__key", F.col("best.hash").alias("hash"))
    )
    # Alike rows come and go together.
    chosen = [(row["__key"], row["hash"]) for row in best.collect()]
    if not chosen:
        return limits
    pick = F.broadcast(driver_table(narrow.sparkSession, chosen, "key string, hash long"))
    words = narrow.join(pick, ["key", "hash"]).groupBy("key", "hash").agg(F.sum("size").alias("size"))
    nearer = dict(limits)
    for row in words.collect():
        old = limits[row["key"]]
        if abs(abs(old.gap) - row["size"]) < abs(old.gap):
            change = {"added" if old.gap > 0 else "removed": row["hash"]}
            nearer[row["key"]] = old._replace(**change)
    return nearer


def mixed_documents(documents: DataFrame, mix: Mix) -> DataFrame:
    """The documents once per draw, shard after shard, in random order within a shard."""
    columns = [F.col(f"`{name}`") for name in documents.columns]
    drawn = mix.find(documents).select(*columns, "__hash", F.explode("__draws").alias("__draw"))
    placed = drawn.withColumns(
        {
            "__shard": F.col("__draw.shard"),
            "__order": F.xxhash64(F.lit(mix.seed), "__draw.epoch", "__hash"),
        }
    ).drop("__draw")
    ranged = placed.repartitionByRange("__shard", "__order").sortWithinPartitions("__shard", "__order")
    return ranged.select(*columns)


def taken_words(documents: DataFrame, mix: Mix, size: Callable[[str], Column] = word_count) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) of every document.

    ``shards`` lists where the tree put the document's copies, one number for each.
    """
    sized = mix.find(documents.select("doc_id", "source", "text"))
    words = sized.select(
        "doc_id",
        size("text").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.transform("__draws", lambda draw: draw["shard"]).alias("shards"),
    )
    return words.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.aggregate("shards", F.lit(0).cast("bigint"), lambda total, _: total + F.col("size")).alias("taken"),
        F.array_join(F.sort_array("shards").cast("array<string>"), ",").alias("shards"),
    )


def five_two_one(position: int, source: str | None) -> float:
    """Weights 5, 2, 1, repeating."""
    return (5.0, 2.0, 1.0)[position % 3]
