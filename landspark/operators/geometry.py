"""Vector layers: projection, centroids, buffers, and points within regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landspark.functions import geometry as g
from landspark.operators.region import Region


def reproject_utm(df: DataFrame, lon: str = "lon", lat: str = "lat", zone: int = 2, south: bool = True) -> DataFrame:
    """Adds ``x, y``: UTM coordinates of WGS84 degrees."""
    x, y = g.utm(F.col(lon), F.col(lat), zone, south)
    return df.withColumns({"x": x, "y": y})


def polygon_centroid(df: DataFrame, ring: str = "ring") -> DataFrame:
    """Adds ``x, y``: the area-weighted centroid."""
    return df.withColumn("_c", g.centroid(F.col(ring))).withColumns({"x": F.col("_c.x"), "y": F.col("_c.y")}).drop("_c")


def buffer_points(df: DataFrame, radius: float = 1.0, x: str = "x", y: str = "y", out: str = "ring") -> DataFrame:
    """Adds the ring of the buffer around each point, 16 segments to a quadrant.

    A row becomes 65 corners, so points are dealt to as many tasks as shuffles have, however few files they are in.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks).withColumn(out, g.circle(F.col(x), F.col(y), radius))


def within_roi(points: DataFrame, roi: DataFrame, key: list[str], tile: float = 1000.0, x: str = "x", y: str = "y", boundary: str = "exclude", holes: str | None = None, most_edges: int = 256) -> DataFrame:
    """The points inside the union of the polygons of ``roi``; ``key`` tells points apart and is not needed.

    Borders that polygons share are no borders of the union. Points and polygons meet in tiles of the side ``tile``, which
    are cut where they have more than ``most_edges`` edges; neither number changes the result.
    """
    return Region.build(roi, tile, holes, most_edges).with_inside(points, F.col(x), F.col(y), "_in", boundary).filter("_in").drop("_in")
