from pyspark.sql import functions as F

from termloom.operators import joins
from termloom.operators.joins import Size, join_by_load, join_salted, measure


def tables(spark):
    """Key 0 holds a third of all facts."""
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).cast("string").alias("key"),
        F.col("id").alias("fact"),
    )
    dimension = facts.groupBy("key").agg(F.count("*").alias("load"))
    return facts, dimension.withColumn("value", F.length("key") + F.col("load"))


def rows(frame):
    return sorted(tuple(row) for row in frame.select("key", "fact", "value").collect())


def test_join_by_load_is_a_join_at_every_cut(spark):
    facts, dimension = tables(spark)
    expected = rows(facts.join(dimension, "key"))
    small = measure(dimension, "key")
    assert small.broadcastable
    assert small.rows == dimension.count()
    large = Size(rows=10**9, key_bytes=10**12)
    for head_rows in (1, 3, 20, 10_000):
        got = join_by_load(facts, dimension, "key", "load", 3000, large, head_rows)
        assert rows(got) == expected
    assert rows(join_by_load(facts, dimension, "key", "load", 3000, small)) == expected


def test_head_is_bounded_and_holds_the_hot_key(spark):
    facts, dimension = tables(spark)
    for head_rows in (3, 5, 50):
        threshold = -(-3000 // head_rows)
        head = [row.key for row in dimension.filter(F.col("load") >= threshold).collect()]
        assert len(head) <= head_rows
        assert "0" in head


def test_join_salted_is_a_join(spark, monkeypatch):
    facts, dimension = tables(spark)
    expected = rows(facts.join(dimension, "key"))
    for per_salt in (1, 7, 500, 10**6):
        monkeypatch.setattr(joins, "FACTS_PER_SALT", per_salt)
        for total in (3000, 3000 * joins.BROADCAST_ROWS):
            got = join_salted(facts, dimension, ["key"], "fact", "load", total)
            assert rows(got.drop("load")) == expected


def test_long_keys_are_protected_and_null_is_a_key(spark):
    """A third of the facts has one key of 200 bytes, some have none."""
    long = F.concat(F.lit("x" * 200), F.col("key"))
    facts, dimension = (
        t.withColumn("key", F.when(F.col("key") != "1", long)) for t in tables(spark)
    )
    expected = sorted(
        (str(f.key), f.fact, d.value)
        for f in facts.collect()
        for d in dimension.collect()
        if f.key == d.key
    )
    large = Size(rows=10**9, key_bytes=10**12)
    for head_rows in (1, 3, 20, 10_000):
        got = join_by_load(facts, dimension, "key", "load", 3000, large, head_rows)
        assert sorted((str(r.key), r.fact, r.value) for r in got.collect()) == expected
    small = join_by_load(facts, dimension, "key", "load", 3000, measure(dimension, "key"))
    assert small.count() == len(expected)
    # The hot key meets its facts in the broadcast part: no task of the other has more than a few.
    tail = join_by_load(facts, dimension, "key", "load", 3000, large, 20)
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
