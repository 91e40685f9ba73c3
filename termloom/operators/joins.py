"""Joins that stay safe when keys are hot or a side grows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The most a broadcast side may hold.
BROADCAST_ROWS = 500_000
BROADCAST_KEY_BYTES = 32 * 1024 * 1024
# A longer key travels with a broadcast head as two hashes of it, so that a head
# of BROADCAST_ROWS keys stays within about the same number of bytes.
HEAD_KEY_BYTES = 64
# Facts of one key that one task of a salted join is meant to have.
FACTS_PER_SALT = 1_000_000


@dataclass(frozen=True)
class Size:
    """Measured size of a table that might be broadcast."""

    rows: int
    key_bytes: int

    @property
    def broadcastable(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.key_bytes <= BROADCAST_KEY_BYTES


def measure(table: DataFrame, *keys: str) -> Size:
    """Rows, and bytes of the columns whose values have no fixed width."""
    row = table.agg(
        F.count("*").alias("rows"),
        *[
            F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0)).alias(key)
            for key in keys
        ],
    ).first()
    return Size(row["rows"], sum(row[key] for key in keys))


def broadcast_if_small(table: DataFrame, *keys: str) -> DataFrame:
    """The table, with a hint if it is measured to be small enough for it."""
    return F.broadcast(table) if measure(table, *keys).broadcastable else table


def join_by_load(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    load: str,
    total_load: int,
    size: Size,
    head_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join of facts with a one-row-per-key dimension, whatever the skew.

    ``load`` is a dimension column that bounds how many facts each key has,
    ``total_load`` its sum. A dimension of proven size is broadcast. A larger
    one is cut in two: keys with at least ``total_load / head_rows`` facts, of
    which there can be no more than ``head_rows``, are broadcast, so hot keys
    never meet in one task; the facts of the other keys are few per key and are
    joined by a shuffle. A null key is a key like any other.
    """
    named = dimension.withColumnRenamed(key, "_key")
    if size.broadcastable and size.rows <= head_rows:
        one = F.broadcast(named.drop(load))
        return facts.join(one, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    threshold = max(1, -(-total_load // head_rows))
    is_head = F.col(load) >= threshold
    text = facts.schema[key].dataType == T.StringType()
    head = named.filter(is_head).withColumn("_head", _short("_key", text)).drop(load, "_key")
    head = F.broadcast(head)
    tail = named.filter(~is_head).drop(load).hint("merge")
    marked = facts.withColumn("_short", _short(key, text))
    in_head = F.col("_short").eqNullSafe(F.col("_head"))
    others = marked.join(head.select("_head"), in_head, "left_anti")
    return (
        marked.join(head, in_head)
        .drop("_head", "_short")
        .unionByName(
            others.join(tail, F.col(key).eqNullSafe(F.col("_key"))).drop("_key", "_short")
        )
    )


def with_heavy_load(
    facts: DataFrame, dimension: DataFrame, key: str, load: str, threshold: int
) -> DataFrame:
    """Facts with the load of their key where it is above the threshold, else null.

    ``load`` is a column of the dimension that says how many facts its key has. The keys
    above the threshold are broadcast: at most as many as the facts hold it.
    """
    text = facts.schema[key].dataType == T.StringType()
    heavy = dimension.filter(F.col(load) > threshold).select(_short(key, text).alias("_head"), load)
    marked = facts.withColumn("_short", _short(key, text))
    return marked.join(
        F.broadcast(heavy), F.col("_short").eqNullSafe(F.col("_head")), "left"
    ).drop("_short", "_head")


def _short(key: str, text: bool) -> Column:
    """The key, or 128 bits of hashes of one that is long."""
    if not text:
        return F.col(key)
    # A seed after the key would only hash the first hash once more.
    digest = F.concat(F.lit("\x00"), F.hex(F.xxhash64(key)), F.hex(F.xxhash64(F.lit(1), key)))
    return F.when(F.octet_length(key) > HEAD_KEY_BYTES, digest).otherwise(F.col(key))


def join_salted(
    facts: DataFrame, lookup: DataFrame, keys: list[str], spread: str, load: str, total_load: int
) -> DataFrame:
    """Inner join by a shuffle in which a hot key is spread over as many tasks as it needs.

    ``load`` is a column of the lookup that says how many facts its key has,
    ``total_load`` bounds the sum over all keys. A key gets one salt per
    FACTS_PER_SALT facts; which keys have more than one is broadcast, and there
    are no more than BROADCAST_ROWS of them. Facts are spread by the hash of
    ``spread``; lookup rows are repeated once per salt.
    """
    per_salt = max(FACTS_PER_SALT, -(-total_load // max(1, BROADCAST_ROWS)))
    salts = F.greatest(F.lit(1), F.ceil(F.col(load) / per_salt)).cast("int")
    salted_lookup = lookup.withColumn("_salts", salts)
    hot = salted_lookup.filter("_salts > 1").select(*keys, "_salts").distinct()
    spread_over = F.coalesce("_salts", F.lit(1))
    salted = (
        facts.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread), spread_over).cast("int"))
        .drop("_salts")
    )
    repeated = salted_lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    ).drop("_salts")
    return salted.join(repeated.hint("merge"), [*keys, "_salt"]).drop("_salt")
