"""Sums of doubles that do not depend on the order of addition.

A double is cut into digits of 32 bits of a fixed-point number, without loss down to
the last digit. Digits are added as whole numbers, which any order and any
partitioning of the rows adds up to the same totals; those become a double again at
the very end, lowest digit first, so larger totals never become smaller doubles. A
sum takes 2^31 rows.

``Fixed(top, n)`` holds numbers below 2^top, to 2^(top - 32 n).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 32
DIGIT = float(1 << DIGIT_BITS)


@dataclass(frozen=True)
class Fixed:
    """A fixed-point format, and the names of its digit columns."""

    top: int
    n: int

    @property
    def columns(self) -> list[str]:
        return [f"digit{i}" for i in range(self.n)]

    def digits(self, x: Column) -> list[Column]:
        """Digits of x, as bigints, highest first; the lowest is cut off downwards."""
        rest = x * F.lit(2.0 ** (DIGIT_BITS - self.top))
        found = []
        for name in self.columns:
            whole = F.floor(rest)
            found.append(whole.alias(name))
            rest = (rest - whole) * F.lit(DIGIT)
        return found

    def sums(self) -> list[Column]:
        """Aggregates of the digit columns."""
        return [F.sum(name).alias(name) for name in self.columns]

    def value(self) -> Column:
        """The double nearest to the number in the digit columns, carries included."""
        digits = [F.col(name) for name in self.columns]
        value, carry = F.lit(0.0), F.lit(0)
        for i in reversed(range(self.n)):
            digit = digits[i] + carry
            if i:
                # The highest digit keeps what it has.
                carry = F.shiftright(digit, DIGIT_BITS)
                digit = digit.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
            unit = 2.0 ** (self.top - DIGIT_BITS * (i + 1))
            value = value + digit.cast("double") * F.lit(unit)
        return value


# Shares of a cosine are at most 1, or as many as a query repeats a term.
SHARES = Fixed(8, 3)
# Squares of weights: from those of a term in 10^8 to raw counts of as many.
SQUARES = Fixed(64, 5)


def exact_sum(table: DataFrame, keys: list[str], x: Column, name: str, fixed: Fixed, *others: Column) -> DataFrame:
    """(keys, sum of x by name, other aggregates): a grouped sum in any order."""
    return (
        table.select("*", *fixed.digits(x))
        .groupBy(*keys)
        .agg(*fixed.sums(), *others)
        .withColumn(name, fixed.value())
        .drop(*fixed.columns)
    )
