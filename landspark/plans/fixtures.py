"""Views of the given tables in the shape of rasters, segments, points and polygons.

Each statement runs as it is in Spark and in DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from landspark.sources.shared import tasks_for

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

VIEWS = {
    "cells": """
SELECT CAST(l_partkey AS INT) AS row_id, CAST(l_suppkey AS INT) AS col_id,
  CAST(CASE WHEN l_partkey % 37 = 0 THEN 0 ELSE max(CAST(round(l_quantity) AS INT)) % 10 * 20 END AS FLOAT) AS red,
  CAST(CASE WHEN l_partkey % 37 = 0 THEN 0 ELSE max(CAST(floor(l_extendedprice) AS INT)) % 251 END AS FLOAT) AS green,
  CAST(CASE WHEN l_partkey % 37 = 0 THEN 0 ELSE max(l_linenumber) * 36 END AS FLOAT) AS blue,
  CAST(CASE WHEN l_partkey % 37 = 0 THEN 0 ELSE max(CAST(round(l_discount * 100) AS INT)) * 25 END AS FLOAT) AS nir
FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "segments": """
SELECT row_id, col_id, CAST(CASE WHEN (row_id + col_id) % 11 = 0 THEN 0
  ELSE floor(row_id / 8) * 1000 + floor(col_id / 8) + 1 END AS BIGINT) AS seg_id
FROM cells""",
    "label_cells": """
SELECT row_id, col_id, poly_id,
  CASE (CAST(floor(row_id / 15) AS INT) + CAST(floor(col_id / 5) AS INT)) % 5
    WHEN 0 THEN 1111 WHEN 1 THEN 2132 WHEN 2 THEN 2417 WHEN 3 THEN 6999 ELSE 8111 END AS crop_code
FROM (SELECT row_id, col_id, CAST(CASE WHEN CAST(floor(row_id / 5) AS INT) % 3 = 0
        THEN floor(row_id / 5) * 1000 + floor(col_id / 5) + 1 ELSE 0 END AS BIGINT) AS poly_id FROM cells) t
WHERE poly_id > 0""",
    "insitu_points": """
SELECT event_id AS id, CAST(floor(value) AS DOUBLE) AS x, CAST(user_id AS DOUBLE) AS y,
  CASE k WHEN '0' THEN '0' WHEN '1' THEN '1111' WHEN '2' THEN concat('1111', chr(10)) WHEN '3' THEN '9999'
    WHEN '4' THEN '2136' WHEN '6' THEN '2132' WHEN '7' THEN 'abc' WHEN '8' THEN '2417' WHEN '9' THEN '2133' END AS crop,
  CASE WHEN k = '3' THEN CAST(event_id % 10 AS STRING) END AS noncrop,
  CASE event_id % 3 WHEN 0 THEN '0' WHEN 1 THEN '1' END AS mixed
FROM (SELECT *, CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 10 AS STRING) AS k FROM events) t""",
    "rect_polys": """
SELECT p_partkey AS poly_id, (p_partkey * 7) % 200 + CAST(0.25 AS DOUBLE) AS xmin, (p_partkey * 13) % 150 + CAST(0.25 AS DOUBLE) AS ymin,
  (p_partkey * 7) % 200 + CAST(0.25 AS DOUBLE) + p_size % 9 + 1 AS xmax, (p_partkey * 13) % 150 + CAST(0.25 AS DOUBLE) + p_size % 6 + 1 AS ymax, p_size AS val
FROM part""",
    "aoi_rects": """
SELECT aoi_id, CAST(xmin AS DOUBLE) AS xmin, CAST(ymin AS DOUBLE) AS ymin, CAST(xmax AS DOUBLE) AS xmax, CAST(ymax AS DOUBLE) AS ymax
FROM (VALUES (1, 10.25, 20.25, 90.25, 80.25), (2, 60.25, 50.25, 140.25, 120.25)) AS t(aoi_id, xmin, ymin, xmax, ymax)""",
    "seam_rects": """
SELECT n_nationkey AS aoi_id, CAST(n_nationkey % 5 * 20 AS DOUBLE) AS xmin, CAST(floor(n_nationkey / 5) * 15 AS DOUBLE) AS ymin,
  CAST(n_nationkey % 5 * 20 + 20 AS DOUBLE) AS xmax, CAST(floor(n_nationkey / 5) * 15 + 15 AS DOUBLE) AS ymax
FROM nation WHERE n_nationkey % 7 <> 3""",
    "lonlat_points": """
SELECT c_custkey AS id, -173.0 + CAST(c_custkey % 1000 AS DOUBLE) / 500 AS lon, -14.0 + CAST(c_nationkey AS DOUBLE) / 50 AS lat FROM customer""",
    "predictions": """
SELECT CAST(l_linenumber AS INT) AS y_true,
  CAST(CASE WHEN l_partkey % 4 = 0 THEN l_suppkey % 9 + 1 ELSE l_linenumber END AS INT) AS y_pred
FROM lineitem""",
    "class_map": """
SELECT row_id, col_id, CASE WHEN row_id % 29 = 0 THEN -9999 WHEN (row_id + col_id) % 2 = 0 THEN 6999 ELSE 2417 END AS class_code FROM cells""",
    "feature_cube": """
SELECT row_id, col_id, red, green, blue, nir,
  CASE WHEN nir + red <> 0 THEN CAST((nir - red) / CAST(nir + red AS DOUBLE) AS FLOAT) ELSE CAST(-9999 AS FLOAT) END AS ndvi,
  CASE WHEN green + nir <> 0 THEN CAST((green - nir) / CAST(green + nir AS DOUBLE) AS FLOAT) ELSE CAST(-9999 AS FLOAT) END AS ndwi
FROM (SELECT row_id, col_id,
  CASE WHEN z THEN CAST(-9999 AS FLOAT) ELSE red END AS red, CASE WHEN z THEN CAST(-9999 AS FLOAT) ELSE green END AS green,
  CASE WHEN z THEN CAST(-9999 AS FLOAT) ELSE blue END AS blue, CASE WHEN z THEN CAST(-9999 AS FLOAT) ELSE nir END AS nir
  FROM (SELECT *, red = 0 AND green = 0 AND blue = 0 AND nir = 0 AS z FROM cells) t) m""",
}

#: Views that group a table: the table is dealt by these keys, to more tasks the larger it is.
DEALT = {"cells": ("lineitem", ["l_partkey", "l_suppkey"])}

_FROM = re.compile(r"\b(FROM|JOIN) (\w+)\b")


class Tables:
    """The given tables and the views, as DataFrames of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        if name not in self.made:
            used = {n for _, n in _FROM.findall(VIEWS[name]) if n in VIEWS or n in TABLES}
            text = _FROM.sub(lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in used else m[0], VIEWS[name])
            parts = {n: getattr(self, n) for n in used}
            if name in DEALT:
                table, keys = DEALT[name]
                parts[table] = parts[table].repartition(tasks_for(self.spark, f"{self.sf_dir}/{table}.parquet"), *keys)
            self.made[name] = self.spark.sql(text, **parts)
        return self.made[name]


def with_views(sql: str, **more: str) -> str:
    """``sql`` with the views it uses as ``WITH`` clauses in front, and ``more`` of them by name."""
    every, order, seen = VIEWS | more, [], set()

    def need(text: str) -> None:
        for name in every:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                need(every[name])
                order.append(name)

    need(sql)
    return f"WITH RECURSIVE {', '.join(f'{n} AS ({every[n]})' for n in order)} {sql}" if order else sql
