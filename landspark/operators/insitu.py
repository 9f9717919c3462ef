"""Cleaning and harmonising field observations.

Codes are text in the inputs. A comparison with a null is never lost silently: where a
filter keeps what is not equal to a value, it keeps nulls too (``eqNullSafe``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels of the field codes.
FIELD_LEGEND = {
    0: "Other crops", 1111: "Taro", 1121: "Taamu", 2132: "Mix crops (banana, taro, coconut, etc)", 2133: "Banana", 2136: "Coffee",
    2416: "Breadfruit", 2417: "Coconut", 2419: "Cocoa", 9999: "Noncrop",
    3: "Grassland", 6: "Forest", 5: "Shrubland", 7: "Bare soil", 8: "Built-up area", 9: "Water", 1: "Sand",
    9121: "Seashore", 9311: "Clouds", 9214: "Cloud shadows",
}
#: Labels of the mapped codes.
MAP_LEGEND = {
    1192: "Other crops", 1111: "Taro", 2132: "Mix crops (banana, taro, coconut, etc)", 1121: "Taamu", 2133: "Banana", 2136: "Coffee",
    2416: "Breadfruit", 2417: "Coconut", 2419: "Cocoa",
    3113: "Grassland", 5111: "Shrubland", 6999: "Forest", 7211: "Bare soil", 8111: "Built-up area", 9111: "Water", 9121: "Seashore",
    8511: "Sand", 9311: "Clouds", 9214: "Cloud shadows",
}
NONCROP, MIXED_CODE = "9999", "2132"


def drop_missing_code(df: DataFrame, col: str = "crop") -> DataFrame:
    """Rows that have a code."""
    return df.filter(F.col(col).isNotNull())


def split_crop_noncrop(df: DataFrame, col: str = "crop", sentinel: str = NONCROP) -> tuple[DataFrame, DataFrame]:
    """Crop rows (a code other than the sentinel, or none) and non-crop rows."""
    return df.filter(~F.col(col).eqNullSafe(sentinel)), df.filter(F.col(col) == sentinel)


def recode_mixed(df: DataFrame, col: str = "crop", mixed: str = "mixed", mixed_code: str = MIXED_CODE, sentinel: str = NONCROP, unknown: str = "0") -> DataFrame:
    """Crop rows marked as mixed, recoded to one class; those of the code ``unknown`` go.

    Rows that are not marked, a missing mark included, stay as they are.
    """
    is_mixed = (F.col(mixed) == "1") & ~F.col(col).eqNullSafe(sentinel)
    marked = F.coalesce(is_mixed, F.lit(False))
    rest = ~F.col(mixed).eqNullSafe("1")
    return df.filter(rest | (marked & ~F.col(col).eqNullSafe(unknown))).withColumn(col, F.when(marked, F.lit(mixed_code)).otherwise(F.col(col)))


def harmonise(df: DataFrame, rename: dict[str, str], drop: tuple[str, ...] = ()) -> DataFrame:
    """Renames columns to the common names and drops unused ones; absent ones are ignored."""
    return df.withColumnsRenamed(rename).drop(*drop)


def concat_sources(*sources: DataFrame) -> DataFrame:
    """Stacks inputs by column name; a column that an input lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows without a null in any column (of ``subset``)."""
    return df.dropna(how="any", subset=subset)


def clean_code(df: DataFrame, col: str = "crop", out: str = "crop_code") -> DataFrame:
    """The code as a number; surrounding white space is ignored, other text gives null."""
    return df.withColumn(out, F.expr(f"try_cast(try_cast(trim(BOTH ' \\n\\r\\t' FROM `{col}`) AS double) AS int)"))


def _legend(df: DataFrame, legend: dict, key: str, value: str) -> DataFrame:
    rows = [(k, v) for k, v in legend.items()]
    return F.broadcast(df.sparkSession.createDataFrame(rows, f"`{key}` {'int' if isinstance(rows[0][0], int) else 'string'}, `{value}` {'int' if isinstance(rows[0][1], int) else 'string'}"))


def apply_legend(df: DataFrame, legend: dict[int, str] = FIELD_LEGEND, col: str = "crop_code", out: str = "crop_label") -> DataFrame:
    """The code's label; a code without one keeps its digits as text. The legend is a constant."""
    found = df.join(_legend(df, legend, "_code", "_label"), F.col(col) == F.col("_code"), "left")
    return found.withColumn(out, F.coalesce("_label", F.col(col).cast("string"))).drop("_code", "_label")


def crosswalk(df: DataFrame, legend: dict[int, str] = MAP_LEGEND, col: str = "crop_label", out: str = "map_code") -> DataFrame:
    """The mapped code of a label; null for labels that have none."""
    found = df.join(_legend(df, {v: k for k, v in legend.items()}, "_label", "_code"), F.col(col) == F.col("_label"), "left")
    return found.withColumn(out, F.col("_code")).drop("_code", "_label")


def exclude_classes(df: DataFrame, codes: list[int], col: str = "map_code") -> DataFrame:
    """Rows of other classes; rows without a code stay."""
    return df.filter(~F.coalesce(F.col(col).isin(codes), F.lit(False)))


def drop_duplicate_geometry(df: DataFrame, order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """The first row of each place, nulls first in ``order``, which must end with a unique column.

    An aggregate, so that rows are reduced to one per place before they are shuffled.
    """
    key = F.struct(*[c for o in order for c in (F.col(o).isNotNull(), F.col(o))])
    first = F.min_by(F.struct(*[F.col(c) for c in df.columns]), key)
    return df.groupBy(F.col(x).alias("_x"), F.col(y).alias("_y")).agg(first.alias("_first")).select("_first.*")


def flag_duplicate_geometry(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Adds ``is_duplicate`` and ``group_id``: duplicated places numbered by x, then y.

    Numbers are given to the distinct duplicated places by :func:`landspark.functions.row_ids`,
    so no task holds all of them.
    """
    from landspark.functions.row_ids import numbered

    places = df.groupBy(x, y).count().filter("count > 1").select(F.col(x).alias("_x"), F.col(y).alias("_y"))
    places = numbered(places, ["_x", "_y"], "group_id")
    same: Column = F.col(x).eqNullSafe(F.col("_x")) & F.col(y).eqNullSafe(F.col("_y"))
    return df.join(places, same, "left").withColumn("is_duplicate", F.col("group_id").isNotNull()).drop("_x", "_y")


def value_counts(df: DataFrame, col: str, by_value: bool = False) -> DataFrame:
    """Rows per value, the most frequent first, or by value."""
    found = df.groupBy(col).agg(F.count("*").alias("n"))
    return found.orderBy(F.col(col).asc_nulls_last()) if by_value else found.orderBy(F.desc("n"), F.col(col).asc_nulls_last())


def missing_counts(df: DataFrame) -> DataFrame:
    """``column, n_missing``: nulls of every column, in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column", "n_missing")


def distinct_codes(df: DataFrame, col: str) -> DataFrame:
    """The distinct values that are not null."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct()
