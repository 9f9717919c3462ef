"""Samples for training: features at labelled cells, and class balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landspark.operators.features import CUBE

NODATA = -9999


def extract_samples(cells: DataFrame, labels: DataFrame, bands: tuple[str, ...] = CUBE, nodata: int = NODATA) -> DataFrame:
    """``row_id, col_id, bands, label`` of the cells with a label.

    NaN features become nodata, and nodata features are kept. The labels are sparse;
    Spark broadcasts them where their measured size allows it, else joins by sorting.
    """
    known = labels.filter(F.col("label") != nodata).select("row_id", "col_id", "label")
    found = cells.join(known, ["row_id", "col_id"])
    return found.select("row_id", "col_id", *[F.nanvl(F.col(b), F.lit(float(nodata)).cast("float")).alias(b) for b in bands], "label")


def sample_coverage(cells: DataFrame, labels: DataFrame, nodata: int = NODATA) -> DataFrame:
    """One row: ``total, valid, percent`` of cells with a label."""
    found = cells.select("row_id", "col_id").join(labels.select("row_id", "col_id", "label"), ["row_id", "col_id"], "left")
    one = found.agg(F.count("*").alias("total"), F.count_if(F.col("label") != nodata).alias("valid"))
    return one.withColumn("percent", F.try_divide(F.col("valid") * 100.0, F.col("total")))


def class_histogram(samples: DataFrame, label: str = "label") -> DataFrame:
    """Samples per class."""
    return samples.groupBy(label).agg(F.count("*").alias("n"))


def label_encoder(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, enc``: the sorted distinct labels numbered from 0; one row per class."""
    classes = df.select(F.col(label).alias("label")).filter("label IS NOT NULL").distinct()
    return classes.withColumn("enc", F.row_number().over(W.orderBy("label")) - 1)


def encode_labels(df: DataFrame, encoder: DataFrame, label: str = "label", out: str = "enc") -> DataFrame:
    """Adds the code of each label; a label that the encoder lacks gives null."""
    known = encoder.select(F.col("label").alias("_label"), F.col("enc").alias(out))
    return df.join(known, F.col(label) == F.col("_label"), "left").drop("_label")


def decode_labels(df: DataFrame, encoder: DataFrame, code: str = "enc", out: str = "label") -> DataFrame:
    """Adds the label of each code."""
    known = encoder.select(F.col("enc").alias("_enc"), F.col("label").alias(out))
    return df.join(known, F.col(code) == F.col("_enc"), "left").drop("_enc")


def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Adds ``rows / (classes * rows of the class)``."""
    per_class = class_histogram(df, label)
    total = per_class.agg(F.sum("n").alias("_rows"), F.count("*").alias("_classes"))
    weights = per_class.crossJoin(F.broadcast(total)).select(F.col(label).alias("_label"), (F.col("_rows") / (F.col("_classes") * F.col("n"))).alias(out))
    # a join by sorting would leave the rows to one task per class
    return df.join(F.broadcast(weights), F.col(label) == F.col("_label")).drop("_label")
