"""Sums in fixed point against exact rational arithmetic."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from termloom.functions.exact import SHARES, SQUARES, Fixed, exact_sum


def total(spark, values, fixed, partitions):
    table = spark.createDataFrame([(1, float(v)) for v in values], "k int, x double").repartition(partitions)
    return exact_sum(table, ["k"], F.col("x"), "total", fixed).first()["total"]


def truncated(values, fixed):
    unit = Fraction(2) ** (fixed.top - 32 * fixed.n)
    return sum((Fraction(v) // unit) * unit for v in values)


@pytest.mark.parametrize("fixed", [SHARES, SQUARES, Fixed(8, 2)], ids=str)
def test_sums_equal_exact_ones_in_any_order(spark, fixed):
    rng = random.Random(1)
    for scale in (1.0, 1e-9, 200.0, 0.3):
        values = [rng.random() * scale * 2.0 ** -rng.randint(0, 40) for _ in range(500)]
        exact = float(truncated(values, fixed))
        for partitions in (1, 7):
            rng.shuffle(values)
            got = total(spark, values, fixed, partitions)
            assert got == pytest.approx(exact, rel=4e-16, abs=0)
            assert got == total(spark, sorted(values), fixed, 3)


def test_larger_sums_are_never_smaller_doubles(spark):
    rng = random.Random(2)
    rows = []
    for k in range(300):
        base = [rng.random() for _ in range(5)]
        rows += [(2 * k, v) for v in base] + [(2 * k + 1, v) for v in base] + [(2 * k + 1, 2.0**-80)]
    table = spark.createDataFrame(rows, "k int, x double")
    got = {r.k: r.total for r in exact_sum(table, ["k"], F.col("x"), "total", SHARES).collect()}
    assert all(got[2 * k] <= got[2 * k + 1] for k in range(300))


def test_zero_large_and_negative(spark):
    assert total(spark, [0.0, 0.0], SHARES, 1) == 0.0
    assert total(spark, [3.0] * 1000, SHARES, 2) == 3000.0
    assert total(spark, [5.5, -2.25], SHARES, 1) == 3.25
    # A double of the exact total, which the sum of two doubles at a time would miss.
    assert total(spark, [1e16, 1.0, 1e-3], SQUARES, 1) == 1e16 + 2.0 != 1e16 + 1.0 + 1e-3
