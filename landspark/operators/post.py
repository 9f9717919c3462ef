"""Refining a class map by spectral indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODATA = -9999
#: Class codes of built-up area and water, and the limits of the indices.
BUILT_UP, WATER = 8111, 9111
NDVI_MOST, NDWI_LEAST = 0.48, 0.11


def _low_ndvi() -> Column:
    return ~F.isnan("ndvi") & (F.col("ndvi") <= F.lit(NDVI_MOST).cast("float"))


def _high_ndwi() -> Column:
    return ~F.isnan("ndwi") & (F.col("ndwi") > F.lit(NDWI_LEAST).cast("float"))


def apply_index_rules(class_map: DataFrame, index: DataFrame, nodata: int = NODATA) -> DataFrame:
    """Cells of high NDWI become water, else those of low NDVI built-up; nodata stays.

    A NaN index matches no rule, and neither does a cell without an index.
    """
    found = class_map.join(index.select("row_id", "col_id", "ndvi", "ndwi"), ["row_id", "col_id"], "left")
    code = F.when(F.col("class_code") == nodata, F.lit(nodata)).when(_high_ndwi(), F.lit(WATER)).when(_low_ndvi(), F.lit(BUILT_UP)).otherwise(F.col("class_code"))
    return found.select("row_id", "col_id", code.alias("class_code"))


def rule_counts(class_map: DataFrame, index: DataFrame) -> DataFrame:
    """One row: the cells that match each rule, before one overrides the other and nodata is restored."""
    found = class_map.join(index.select("row_id", "col_id", "ndvi", "ndwi"), ["row_id", "col_id"])
    return found.agg(F.count_if(_low_ndvi()).alias("low_ndvi"), F.count_if(_high_ndwi()).alias("high_ndwi"))
