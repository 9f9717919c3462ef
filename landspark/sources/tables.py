"""Reading and writing rasters, vector layers and reports as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landspark.functions import geometry as g

#: Cells on a side of the tiles by which rasters are laid out, and where it is kept what each file of a table covers.
TILE, ZONES = 1024, "_zones"


def tile_order(row: Column, col: Column) -> Column:
    """A number for each tile by which tiles that are near each other are mostly near in order: the bits of both in turn."""
    r, c = row + (1 << 23), col + (1 << 23)  # negative tiles come first
    bits = [F.shiftleft(F.shiftright(x.cast("long"), k).bitwiseAND(F.lit(1).cast("long")), 2 * k + odd) for x, odd in ((r, 1), (c, 0)) for k in range(25)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def write_cells(df: DataFrame, path: str, mode: str = "error", tile: int = TILE) -> None:
    """Writes cells as Parquet, tile after tile in a space-filling order, and beside them what each file covers.

    A file holds a run of that order, and so a compact area; its least and greatest row and column are kept in
    ``_zones``, one row for each file, which Spark's reader of the table passes over. With ``mode="append"`` new files
    are added to it. A tile lies in one file.
    """
    r, c = (F.floor(F.col(x) / tile).cast("int") for x in ("row_id", "col_id"))
    ordered = df.withColumn("_order", tile_order(r, c)).repartitionByRange("_order").sortWithinPartitions("_order", "row_id", "col_id").drop("_order")
    ordered.write.mode(mode).parquet(path)
    spark = df.sparkSession
    if not spark.read.schema(df.schema).parquet(path).inputFiles():
        return
    name = F.regexp_extract(F.input_file_name(), "[^/]+$", 0)
    cells, known = spark.read.schema(df.schema).parquet(path), _zones(spark, path)
    if mode == "append" and known is not None:
        old = {x["file"] for x in known.select("file").collect()}  # a name for each file, as Spark itself keeps
        new = [f"{path}/{n}" for n in _names(cells) if n not in old]
        if not new:
            return
        cells = spark.read.schema(df.schema).parquet(*new)
    zones = cells.groupBy(name.alias("file")).agg(*[f(x).alias(f"{n}_{x}") for x in ("row_id", "col_id") for n, f in (("min", F.min), ("max", F.max))], F.count("*").alias("n"))
    zones.coalesce(1).write.mode(mode if mode == "append" else "overwrite").parquet(f"{path}/{ZONES}")


def _names(cells: DataFrame) -> list[str]:
    return [f.rpartition("/")[2] for f in cells.inputFiles()]


def _zones(spark: SparkSession, path: str) -> DataFrame | None:
    """What each file of a table covers, where that was stored."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{ZONES}")
    return spark.read.parquet(f"{path}/{ZONES}") if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at) else None


def read_cells(spark: SparkSession, path: str, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Reads cells, whole or by a window ``(row_from, row_to, col_from, col_to)``, ends excluded.

    Files that are known to lie outside the window are not opened, whatever tiles they were written by; within
    the others rows and columns are filtered in the scan. Files without a zone, or a table without
    zones, are read as any Parquet.
    """
    cells = spark.read.parquet(path)
    if not window:
        return cells
    r0, r1, c0, c1 = window
    zones = _zones(spark, path)
    if zones is not None:
        meets = (F.col("max_row_id") >= r0) & (F.col("min_row_id") < r1) & (F.col("max_col_id") >= c0) & (F.col("min_col_id") < c1)
        outside = {x["file"] for x in zones.filter(~meets).select("file").collect()}
        names = _names(cells)
        near = [f"{path}/{n}" for n in names if n not in outside]
        if len(near) < len(names):
            cells = spark.read.schema(cells.schema).parquet(*(near or [f"{path}/{names[0]}"]))
    return cells.filter((F.col("row_id") >= r0) & (F.col("row_id") < r1) & (F.col("col_id") >= c0) & (F.col("col_id") < c1))


def write_report(df: DataFrame, path: str, mode: str = "error") -> None:
    """Writes a small result as one CSV file with a header."""
    df.coalesce(1).write.mode(mode).csv(path, header=True)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Reads such a report."""
    return spark.read.schema(schema).csv(path, header=True)


def write_if_absent(df: DataFrame, path: str) -> None:
    """Writes Parquet unless the path exists."""
    df.write.mode("ignore").parquet(path)


def write_features(df: DataFrame, path: str, ring: str = "ring", form: str = "wkt", mode: str = "error", holes: str | None = None) -> None:
    """Writes polygons, with holes where a column has them, and their attributes: Parquet with a WKT column, or GeoJSON lines."""
    rest = [c for c in df.columns if c not in (ring, holes)]
    inner = F.col(holes) if holes else None
    if form == "wkt":
        df.select(*rest, g.wkt(F.col(ring), inner).alias("wkt")).write.mode(mode).parquet(path)
    elif form == "geojson":
        feature = F.struct(F.lit("Feature").alias("type"), F.struct(*rest).alias("properties"), g.shape(F.col(ring), inner).alias("geometry"))
        df.select(F.to_json(feature).alias("value")).write.mode(mode).text(path)
    else:
        raise ValueError("form is 'wkt' or 'geojson'")
