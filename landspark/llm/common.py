"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landspark.sources.shared import Scratch, materialize, new_path  # noqa: F401

#: White space as the operators' contracts state it.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def content_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Two hashes that tell rows apart by id and text, wherever they are stored.

    Rows of equal id and text share them; others do so with a probability of 2 ** -128.
    """
    i, t = F.col(id_col), F.col(text_col)
    return F.xxhash64(i, i.isNull(), t, t.isNull()), F.xxhash64(F.lit(1), t, t.isNull(), i, i.isNull())


def bounded_sample(rows: DataFrame, by: str, most: int) -> tuple[DataFrame, dict]:
    """Up to ``most`` distinct keys of each value of ``by``, those of the smallest hashes, and all rows' counts.

    ``rows`` has ``by`` and the columns ``_k1, _k2`` of :func:`content_key`, so repeated rows are one
    key and rows of one id but other texts are several. A hash threshold thins large
    classes before their keys are ranked, so no task ranks many more than ``most``. The
    values of ``by`` are few, so the keys are bounded by ``most`` and fit for a broadcast.
    """
    found = rows.groupBy(by).agg(F.count("*").alias("n"), F.approx_count_distinct("_k1", 0.02).alias("keys")).collect()
    spark = rows.sparkSession
    shares = spark.createDataFrame([(r[by], min(1.0, 1.2 * most / r["keys"])) for r in found], f"_by {rows.schema[by].dataType.simpleString()}, _share double")
    h = F.pmod(F.xxhash64("_k1", "_k2"), F.lit(1 << 30))
    thin = rows.join(F.broadcast(shares), F.col(by) == F.col("_by")).filter(h < F.col("_share") * (1 << 30)).select(by, "_k1", "_k2").distinct()
    nth = F.row_number().over(W.partitionBy(by).orderBy(h, "_k1", "_k2"))
    return thin.withColumn("_nth", nth).filter(F.col("_nth") <= most).drop("_nth"), {r[by]: r["n"] for r in found}


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Lowers the session's rows and bytes of an Arrow batch, as texts are long: a batch is held several times over.

    Spark reads these settings when a plan runs, which is after an operator has returned
    it, so they stay; limits that are lower already are left alone.
    """
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        if not 0 < int(spark.conf.get(name).rstrip("bB")) <= most:
            spark.conf.set(name, most)


def plainly_named(docs: DataFrame, *keep: str) -> DataFrame:
    """``docs`` with other columns than ``keep`` named by their place, so that helper columns of any name clash with none."""
    return docs.toDF(*[c if c in keep else f"column_{k}" for k, c in enumerate(docs.columns)])
