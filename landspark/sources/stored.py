"""Tables stored in buckets at a path, that any session can open.

Tables that are bucketed alike by their join keys are joined without an exchange. How a table is
bucketed is a row in ``_layout`` beside its files, which Spark's readers pass over; a session
that does not know the table yet registers it from there, so it needs no catalog that outlives the session.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYOUT = "_layout"


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether a table was made at ``path``."""
    store, at = _path(spark, f"{path}/{LAYOUT}/_SUCCESS")
    return store.exists(at)


def _quoted(names: list[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}`" for n in names)


def _registered(spark: SparkSession, path: str) -> str:
    """The name of the table at ``path`` in this session."""
    name = "stored_" + hashlib.sha256(path.encode()).hexdigest()[:24]
    if not spark.catalog.tableExists(name):
        row = spark.read.parquet(f"{path}/{LAYOUT}").first()
        spark.sql(f"CREATE TABLE {name} ({row['columns']}) USING parquet CLUSTERED BY ({_quoted(row['keys'])}) SORTED BY ({_quoted(row['keys'])}) INTO {row['buckets']} BUCKETS LOCATION '{path}'")
    return name


def create_stored(spark: SparkSession, path: str, columns: str, keys: list[str], buckets: int) -> None:
    """Makes an empty table of the columns ``columns`` (as DDL), bucketed and sorted by ``keys``, unless there is one."""
    if not is_stored(spark, path):
        spark.createDataFrame([(columns, keys, buckets)], "columns string, keys array<string>, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/{LAYOUT}")


def append_stored(df: DataFrame, path: str) -> None:
    """Adds rows to a table, one file for each bucket.

    Rows are dealt by the very number of their bucket, so a task writes one file, however many tasks the session has.
    """
    spark = df.sparkSession
    layout = spark.read.parquet(f"{path}/{LAYOUT}").first()
    name, keys = _registered(spark, path), layout["keys"]
    bucket = F.pmod(F.hash(*[F.col(f"`{k.replace('`', '``')}`") for k in keys]), F.lit(layout["buckets"]))
    dealt = df.select(*spark.table(name).columns).repartitionById(layout["buckets"], bucket)
    dealt.write.format("parquet").mode("append").bucketBy(layout["buckets"], *keys).sortBy(*keys).saveAsTable(name)


def read_stored(spark: SparkSession, path: str, refresh: bool = False) -> DataFrame:
    """A table that was made at ``path``, by this session or another.

    With ``refresh`` its files are listed anew, for those that another session has added since this one first read it.
    """
    name = _registered(spark, path)
    if refresh:
        spark.catalog.refreshTable(name)
    return spark.table(name)


def write_stored(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Writes ``df`` as a new table bucketed and sorted by ``keys``."""
    if is_stored(df.sparkSession, path):
        raise ValueError(f"there is a table at {path}")
    create_stored(df.sparkSession, path, ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema), keys, buckets)
    append_stored(df, path)


def drop_stored(spark: SparkSession, path: str) -> None:
    """Deletes a table and its files."""
    if is_stored(spark, path):
        spark.sql(f"DROP TABLE IF EXISTS {_registered(spark, path)}")
        store, at = _path(spark, path)
        store.delete(at, True)
