"""The folder that driver and executors share, and tables that cut lineage there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``.

    Where it is unset, a session of this machine alone gets a folder of its own, as in
    tests; on a cluster executors would not see such a folder, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def tasks_for(spark: SparkSession, path: str, size: int = 4 << 20) -> int:
    """The number of tasks that get about ``size`` bytes of the files at ``path`` each; at least that of cores.

    Adaptive execution joins shuffled partitions by their compressed bytes, of which few can be many rows in memory;
    partitions dealt by a given number stay as they are.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-stored // size))


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back.

    This cuts the lineage and survives the loss of any executor.
    """
    path = new_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Writes tables like :func:`materialize` and deletes them at the end of a ``with`` block.

    For what is used up within a function; what a returned DataFrame reads must be
    written by :func:`materialize`.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Callable[[DataFrame, str], DataFrame]:
        return self.write

    def write(self, df: DataFrame, what: str) -> DataFrame:
        path = new_path(self.spark, what)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        conf = self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
