"""Features and labels of image segments (objects)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landspark.operators.features import CUBE

NODATA = -9999
STATS = ("mean", "std", "min", "max")


def segment_ids(segments: DataFrame) -> DataFrame:
    """The distinct segment ids; the background 0 is none. Raises if there are none."""
    found = segments.filter("seg_id > 0").select("seg_id").distinct()
    if found.isEmpty():
        raise ValueError("there is no segment")
    return found


def zonal_stats(cells: DataFrame, segments: DataFrame | None = None, bands: tuple[str, ...] = CUBE, exclude_nodata: bool = False, nodata: float = NODATA) -> DataFrame:
    """``seg_id, n`` and every band's mean, std, min and max over the segment's cells.

    ``cells`` may have ``seg_id`` itself, which saves the join. The background is dropped
    first. Squares are taken in the band's type and summed in double; a NaN in a band
    makes its statistics NaN. Nodata counts as a value unless ``exclude_nodata``, which
    leaves it out band by band. Sums are combined before the one shuffle by segment.
    """
    if segments is not None:
        cells = cells.join(segments.filter("seg_id > 0").select("row_id", "col_id", "seg_id"), ["row_id", "col_id"])
    cells = cells.filter("seg_id > 0")
    aggs = [F.count("*").alias("n")]
    for b in bands:
        x = F.when(F.col(b) != F.lit(nodata).cast("float"), F.col(b)) if exclude_nodata else F.col(b)
        aggs += [F.count(x).alias(f"_{b}_n"), F.sum(x.cast("double")).alias(f"_{b}_s"), F.sum((x * x).cast("double")).alias(f"_{b}_q"), F.min(x).alias(f"_{b}_lo"), F.max(x).alias(f"_{b}_hi")]
    found = cells.groupBy("seg_id").agg(*aggs)
    nan = F.lit(float("nan")).cast("float")
    out = [F.col("seg_id"), F.col("n")]
    for b in bands:
        m, q = (F.try_divide(f"_{b}_{c}", f"_{b}_n") for c in "sq")
        bad = F.isnan(f"_{b}_hi")  # NaN is the largest value
        out += [
            m.cast("float").alias(f"{b}_mean"),
            F.sqrt(F.greatest(q - m * m, F.lit(0.0))).cast("float").alias(f"{b}_std"),
            F.when(bad, nan).otherwise(F.col(f"_{b}_lo")).alias(f"{b}_min"),
            F.when(bad, nan).otherwise(F.col(f"_{b}_hi")).alias(f"{b}_max"),
        ]
    return found.select(*out)


def object_matrix(stats: DataFrame, bands: tuple[str, ...] = CUBE) -> DataFrame:
    """``seg_id`` and the features as floats: all means, all stds, all minima, all maxima."""
    return stats.select("seg_id", *[F.col(f"{b}_{s}").cast("float") for s in STATS for b in bands])


def segment_class_counts(segments: DataFrame | None, labels: DataFrame, known: DataFrame | None = None, nodata: int = NODATA) -> DataFrame:
    """``seg_id, label, n``: labelled cells per segment and class, of ``known`` segments if given.

    ``labels`` may have ``seg_id`` itself, which saves the join; ``segments`` is None then.
    """
    found = labels.filter(F.col("label") != nodata)
    found = found.filter("seg_id > 0") if segments is None else found.join(segments.filter("seg_id > 0"), ["row_id", "col_id"])
    if known is not None:
        found = found.join(known.select("seg_id"), "seg_id", "left_semi")
    return found.groupBy("seg_id", "label").agg(F.count("*").alias("n"))


def majority_label(counts: DataFrame, purity: float = 0.9) -> DataFrame:
    """``seg_id, label, purity`` of segments whose largest class has that share of labelled cells.

    Of equally large classes the smallest code is taken; negative codes are dropped. One
    aggregation, no window.
    """
    found = counts.groupBy("seg_id").agg(F.sum("n").alias("total"), F.max(F.struct("n", (-F.col("label")).alias("minus"))).alias("top"))
    found = found.select("seg_id", (-F.col("top.minus")).alias("label"), (F.col("top.n") / F.col("total")).alias("purity"))
    return found.filter((F.col("purity") >= purity) & (F.col("label") >= 0))


def object_training_set(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of the labelled segments with their label."""
    return matrix.join(labels.select("seg_id", "label"), "seg_id")


def objects_to_map(segments: DataFrame, predictions: DataFrame, nodata: int = NODATA) -> DataFrame:
    """``row_id, col_id, class_code``: each cell gets its segment's prediction.

    Background cells are kept out of the join, as they would be one hot key.
    """
    known = predictions.select("seg_id", F.col("class_code").cast("int"))
    inside = segments.filter("seg_id > 0").join(known, "seg_id", "left").select("row_id", "col_id", F.coalesce("class_code", F.lit(nodata)).alias("class_code"))
    rest = segments.filter("seg_id IS NULL OR seg_id <= 0").select("row_id", "col_id", F.lit(nodata).alias("class_code"))
    return inside.unionByName(rest)
