"""Spectral features: masks, indices and standardised bands. All but the statistics are map-only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODATA = -9999.0
BANDS = ("red", "green", "blue", "nir")
CUBE = (*BANDS, "ndvi", "ndwi")


def _f(x: float) -> Column:
    return F.lit(x).cast("float")


def mask_nodata(cells: DataFrame, bands: tuple[str, ...] = BANDS, nodata: float = NODATA) -> DataFrame:
    """Cells whose bands are all 0 get nodata in all bands."""
    empty = F.lit(True)
    for b in bands:
        empty &= F.col(b) == 0
    return cells.withColumns({b: F.when(empty, _f(nodata)).otherwise(F.col(b)) for b in bands})


def normalized_difference(df: DataFrame, a: str, b: str, out: str, nodata: float = NODATA) -> DataFrame:
    """``(a - b) / (a + b)`` as float; nodata where the sum is 0.

    Sum and difference are taken in the bands' own type, the quotient in double.
    """
    index = F.try_divide(F.col(a) - F.col(b), F.col(a) + F.col(b)).cast("float")
    return df.withColumn(out, F.when(F.col(a) + F.col(b) != 0, index).otherwise(_f(nodata)))


def build_feature_cube(cells: DataFrame, nodata: float = NODATA) -> DataFrame:
    """``row_id, col_id`` and the six bands, NDVI and NDWI last. Indices see masked bands."""
    out = mask_nodata(cells, BANDS, nodata)
    out = normalized_difference(out, "nir", "red", "ndvi", nodata)
    out = normalized_difference(out, "green", "nir", "ndwi", nodata)
    return out.select("row_id", "col_id", *CUBE)


def valid(bands: tuple[str, ...] = CUBE, nodata: float = NODATA) -> Column:
    """Whether no band is nodata; NaN counts as a value."""
    ok = F.lit(True)
    for b in bands:
        ok &= F.col(b) != _f(nodata)
    return ok


def band_stats(cells: DataFrame, bands: tuple[str, ...] = BANDS, nodata: float = NODATA) -> DataFrame:
    """``band, n, mean, std`` (population) over the cells valid in all six bands."""
    one = cells.filter(valid(nodata=nodata)).agg(
        F.count("*").alias("n"), *[F.avg(F.col(b).cast("double")).alias(f"{b}_mean") for b in bands], *[F.stddev_pop(F.col(b).cast("double")).alias(f"{b}_std") for b in bands]
    )
    rows = F.array(*[F.struct(F.lit(b).alias("band"), F.col("n"), F.col(f"{b}_mean").alias("mean"), F.col(f"{b}_std").alias("std")) for b in bands])
    return one.select(F.inline(rows))


def standardize(cells: DataFrame, bands: tuple[str, ...] = BANDS, nodata: float = NODATA) -> DataFrame:
    """Z-scores of ``bands`` on valid cells, nodata elsewhere; the indices as they are.

    A band without spread has no z-score: null. The statistics are one row.
    """
    stats = cells.filter(valid(nodata=nodata)).agg(
        *[F.avg(F.col(b).cast("double")).alias(f"_{b}_mean") for b in bands], *[F.stddev_pop(F.col(b).cast("double")).alias(f"_{b}_std") for b in bands]
    )
    z = {b: F.when(valid(nodata=nodata), F.try_divide(F.col(b) - F.col(f"_{b}_mean"), F.col(f"_{b}_std")).cast("float")).otherwise(_f(nodata)) for b in bands}
    return cells.crossJoin(F.broadcast(stats)).select(*[z[c].alias(c) if c in z else F.col(c) for c in cells.columns])
