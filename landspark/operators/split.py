"""Splitting reference polygons into calibration and validation sets by pixels."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landspark.functions.row_ids import numbered
from landspark.sources.shared import Scratch, materialize

NODATA = -9999


def assign_poly_id(df: DataFrame, order: list[str], out: str = "poly_id") -> DataFrame:
    """Ids from 1 on in the order of ``order`` (0 is the background)."""
    return numbered(df, order, out)


def pixel_counts(label_cells: DataFrame) -> DataFrame:
    """``poly_id, pix_count`` of the burnt polygons."""
    return label_cells.filter("poly_id > 0").groupBy("poly_id").agg(F.count("*").alias("pix_count"))


def attach_counts(polys: DataFrame, counts: DataFrame) -> DataFrame:
    """Polygons with their count; null for those that no cell has."""
    return polys.join(counts, "poly_id", "left")


def class_pixel_totals(polys: DataFrame) -> DataFrame:
    """Adds ``crop_pix``: the pixels of the polygon's class.

    Totals are made per class and joined back, so a hot class is not gathered.
    """
    totals = polys.groupBy("crop_code").agg(F.sum("pix_count").alias("crop_pix")).withColumnRenamed("crop_code", "_code")
    return polys.join(totals, F.col("crop_code").eqNullSafe(F.col("_code")), "left").drop("_code")


def calibration_targets(polys: DataFrame, pct: int = 75) -> DataFrame:
    """``crop_code, target``: the pixels that calibration may have of each class."""
    return polys.filter("crop_code IS NOT NULL").groupBy("crop_code").agg((F.sum("pix_count") * pct / 100).alias("target"))


def shuffle_key(seed: int = 42, key: str = "poly_id"):
    """A key that puts ids in a pseudo-random order; the same in any engine."""
    p = F.lit(2147483647).cast("long")
    return F.pmod(F.pmod(F.col(key), p) * F.lit(2654435761).cast("long") + F.lit(seed), p)  # reduced first: no overflow


def seeded_shuffle(df: DataFrame, seed: int = 42, key: str = "poly_id", out: str = "position") -> DataFrame:
    """Adds each row's position, from 1, in the shuffled order."""
    return numbered(df.withColumn("_key", shuffle_key(seed, key)), ["_key", key], out).drop("_key")


def greedy_split(polys: DataFrame, pct: int = 75, seed: int = 42, walk_rows: int = 200_000, rounds: int = 40) -> DataFrame:
    """``poly_id, crop_code, pix_count, set``: every polygon in ``cal`` or ``val``.

    In shuffled order a class's polygon goes to calibration if the pixels so far and its
    own stay within the class's target, else to validation; a polygon that does not fit
    does not stop later, smaller ones. Without a count or a class it is for validation.

    What was taken so far decides on the next polygon, yet most of it is settled in bulk. Polygons lie in
    range partitions of their class and order. In a round, the partitions' sums tell how far each
    class goes on without a polygon that does not fit; all up to there are taken, that one is
    left, and those behind it that are larger than what is left of the target are out for good. Only the
    partition with that polygon is summed row by row. When no more than ``walk_rows`` are
    open, or after ``rounds`` rounds, the rest is walked one by one, as a sorted stream with one running sum kept.
    """
    rows = polys.select(F.col("poly_id").cast("long"), F.col("crop_code").cast("int"), F.col("pix_count").cast("long"))
    targets = calibration_targets(rows, pct).withColumn("target", F.col("target").cast("double"))
    order = ["crop_code", "_key", "poly_id"]
    dealt = rows.withColumn("_key", shuffle_key(seed)).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = materialize(dealt.drop("_key"), "dealt").withColumn("_part", F.shiftright("_id", 33))
    with Scratch(polys.sparkSession) as write:
        # of each class: the place of the last polygon that is settled, and what is left of the target
        state = write(targets.select("crop_code", F.lit(-1).cast("long").alias("_at"), F.col("target").alias("_left")), "state")
        steps = []
        for _ in range(rounds):
            still = placed.join(state, "crop_code").filter((F.col("_id") > F.col("_at")) & (F.col("pix_count") <= F.col("_left")))
            sums = write(still.groupBy("crop_code", "_part").agg(F.sum("pix_count").alias("n"), F.count("*").alias("rows"), F.first("_left").alias("_left")), "sums")
            if (sums.agg(F.sum("rows")).first()[0] or 0) <= walk_rows:
                break
            by_class = W.partitionBy("crop_code").orderBy("_part")
            sums = sums.withColumn("_so_far", F.sum("n").over(by_class)).filter(F.col("_so_far") > F.col("_left"))
            ends = sums.groupBy("crop_code").agg(F.min(F.struct("_part", (F.col("_so_far") - F.col("n")).alias("_before"))).alias("_end")).select("crop_code", "_end.*")
            in_turn = W.partitionBy("crop_code").orderBy("_id")
            near = still.join(ends, ["crop_code", "_part"]).withColumn("_so_far", F.col("_before") + F.sum("pix_count").over(in_turn)).filter(F.col("_so_far") > F.col("_left"))
            near = near.groupBy("crop_code").agg(F.min(F.struct("_id", (F.col("_so_far") - F.col("pix_count")).alias("_taken"))).alias("_end"))
            # a class in which all fit is settled to its end
            at, taken = F.coalesce(F.col("_end._id"), F.lit((1 << 63) - 1)), F.coalesce(F.col("_end._taken"), F.lit(0))
            step = write(state.join(near, "crop_code", "left").select("crop_code", F.col("_at").alias("_from"), F.col("_left").alias("_limit"), at.alias("_at"), (F.col("_left") - taken).alias("_left")), "step")
            steps.append(step.select("crop_code", "_from", "_limit", F.col("_at").alias("_to")))
            state = step.select("crop_code", "_at", "_left")
        known = state
        if steps:
            spans = reduce(DataFrame.unionByName, steps).groupBy("crop_code").agg(F.collect_list(F.struct("_from", "_to", "_limit")).alias("_spans"))  # one for each round
            known = state.join(spans, "crop_code")
        known = materialize(known, "known")
    found = placed.join(known, "crop_code", "left")
    is_open = F.coalesce((F.col("_id") > F.col("_at")) & (F.col("pix_count") <= F.col("_left")), F.lit(False))
    taken = F.lit(False)
    if steps:
        taken = F.exists("_spans", lambda s: (F.col("_id") > s["_from"]) & (F.col("_id") < s["_to"]) & (F.col("pix_count") <= s["_limit"]))
    settled = found.filter(~is_open).select("poly_id", "crop_code", "pix_count", F.when(F.coalesce(taken, F.lit(False)), "cal").otherwise("val").alias("set"))
    rest = found.filter(is_open).select("poly_id", "crop_code", "pix_count", "_id", F.col("_left").alias("target"))
    return _walk(rest).unionByName(settled)


def _walk(rows: DataFrame) -> DataFrame:
    """Takes or leaves polygon by polygon: a class is one sorted stream, read batch by batch."""
    dealt = rows.repartition("crop_code").sortWithinPartitions("crop_code", "_id")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, so_far = None, 0
        for b in batches:
            sets = []
            for c, n, most in zip(b["crop_code"].to_pylist(), b["pix_count"].to_pylist(), b["target"].to_pylist(), strict=True):
                if c != code:
                    code, so_far = c, 0
                fits = so_far + n <= most
                so_far += n if fits else 0
                sets.append("cal" if fits else "val")
            yield pa.record_batch([b["poly_id"], b["crop_code"], b["pix_count"], pa.array(sets, pa.string())], names=["poly_id", "crop_code", "pix_count", "set"])

    return dealt.mapInArrow(walk, "poly_id long, crop_code int, pix_count long, set string")


def split_summary(split: DataFrame) -> DataFrame:
    """``set, crop_code, n_polygons, n_pixels``."""
    return split.groupBy("set", "crop_code").agg(F.count("*").alias("n_polygons"), F.coalesce(F.sum("pix_count"), F.lit(0)).alias("n_pixels"))


def split_overlap(cal: DataFrame, val: DataFrame, label_cells: DataFrame) -> DataFrame:
    """One row: ids in both sets, cells in both masks, and cells of each. Raises if ``val`` is empty."""
    if val.isEmpty():
        raise ValueError("the validation set has no polygon")
    sets = cal.select("poly_id", F.lit(1).alias("c"), F.lit(0).alias("v")).union(val.select("poly_id", F.lit(0), F.lit(1)))
    sets = sets.groupBy("poly_id").agg(F.max("c").alias("c"), F.max("v").alias("v"))
    both = sets.agg(F.count_if(F.expr("c = 1 AND v = 1")).alias("ids_in_both"))
    cells = label_cells.join(sets, "poly_id").agg(F.count_if(F.expr("c = 1 AND v = 1")).alias("cells_in_both"), F.count_if(F.expr("c = 1")).alias("cal_cells"), F.count_if(F.expr("v = 1")).alias("val_cells"))
    return both.crossJoin(cells)


def mask_labels(label_cells: DataFrame, ids: DataFrame) -> DataFrame:
    """``row_id, col_id, label`` of the cells of the given polygons; other cells have no row."""
    return label_cells.join(ids.select("poly_id"), "poly_id", "left_semi").select("row_id", "col_id", F.col("crop_code").alias("label"))


def mask_labels_dense(label_cells: DataFrame, ids: DataFrame, nodata: int = NODATA) -> DataFrame:
    """As :func:`mask_labels`, with nodata for the other cells."""
    known = ids.select("poly_id").distinct().withColumn("_in", F.lit(True))
    return label_cells.join(known, "poly_id", "left").select("row_id", "col_id", F.when(F.col("_in"), F.col("crop_code")).otherwise(F.lit(nodata)).alias("label"))
