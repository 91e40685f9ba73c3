"""What several of these operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words end at the ASCII white space characters, nowhere else.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of an Arrow batch. The JVM holds up to three times that for each running task, and
# Python as much again, outside the heap.
BATCH_BYTES = 8 * 1024 * 1024
# A limit above this counts as not set.
MOST_BATCH_BYTES = 128 * 1024 * 1024


_shipped: set[str] = set()


def prepare_workers(spark: SparkSession) -> None:
    """Give Python workers this package, and batches that fit their memory.

    Spark counts the rows of an Arrow batch by default, and 10,000 long texts do
    not fit a worker; a limit that somebody has set stays. The package goes to
    the executors as a zip file, once per application.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1))) > MOST_BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="termloom-"), "termloom_package.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def driver_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of rows made on the driver, sent as Arrow.

    Rows sent as they are would be unpickled by Python workers, which every executor starts
    and keeps for them.
    """
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return spark.createDataFrame(pa.table([list(column) for column in columns], names=fields.names), fields)


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def uniform(*columns: Column | str, seed: int) -> Column:
    """A number in [0, 1) that depends on the values of the columns only."""
    return (F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) once per id; rows without either are dropped.

    An id with several labels has the largest.
    """
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )


def key_runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the rows with one value of ``key`` each, from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for cut in cuts.tolist():
            yield pa.Table.from_batches([*held, batch.slice(start, cut - start)])
            held, start = [], cut
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def vectors_of(column: pa.Array | pa.ChunkedArray, dtype) -> np.ndarray:
    """A matrix from a column of equally long lists without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype, copy=False).reshape(len(column), -1 if len(column) else 0)


def whole_groups(batches: Iterable[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows, but for the last, that cut no group of equal keys.

    The batches are sorted by ``key``.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if size >= rows:
            last = held[-1].column(key)[-1].as_py()
            cut = int(np.searchsorted(keys, last, side="right"))
            if cut:
                held.append(batch.slice(0, cut))
                size += cut
            if cut < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
                batch = batch.slice(cut)
            else:
                continue
        held.append(batch)
        size += batch.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def run_bounds(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
