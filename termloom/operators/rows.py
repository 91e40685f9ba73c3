"""One row per element of a computed array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_computed(
    table: DataFrame, keep: list[str], array: Column | str, name: str, position: str | None = None
) -> DataFrame:
    """``keep``, then each element of ``array``, which must not hold nulls.

    For a plain explode Spark infers a filter on the array's size and pushes it
    down, where it works out the whole array once more, before the explode
    does. An outer explode infers none; the rows it adds for empty arrays are
    dropped here.
    """
    if position is None:
        rows = table.select(*keep, F.explode_outer(array).alias(name))
    else:
        rows = table.select(*keep, F.posexplode_outer(array).alias(position, name))
    return rows.filter(F.col(name).isNotNull())
