"""Where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class Workspace:
    """A folder for tables that cut lineage and are read more than once.

    The folder lies under ``spark.checkpoint.dir``, which every executor can
    reach, so a lost executor loses none of it. Written Parquet, unlike a
    checkpoint, keeps column pruning, pushed filters and true size estimates.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{(root or _shared_folder(spark)).rstrip('/')}/termloom-{uuid.uuid4().hex}"

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def close(self) -> None:
        """Delete the folder. Lazy results that read its tables end with it."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, table: DataFrame, name: str) -> DataFrame:
        """Write the table once and return it as read back."""
        path = self.path(f"{name}-{uuid.uuid4().hex[:8]}")
        table.write.parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir()
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="termloom-")
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
