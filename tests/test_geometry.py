"""Polygons: points within, burning, tracing, and plans."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landspark.functions import geometry as g
from landspark.operators import features, geometry, grid, model, objects, region
from landspark.sources import tables as io
from landspark.sources.shared import new_path
from tests.conftest import rows

RING = "array<struct<x:double,y:double>>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_boundaries(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]  # open
    df = spark.createDataFrame([(square, float(x), float(y)) for x, y in [(1, 1), (0, 1), (2, 1), (1, 0), (1, 2), (3, 1)]], f"ring {RING}, x double, y double")
    for boundary, want in (("exclude", [True, False, False, False, False, False]), ("half_open", [True, True, False, True, False, False])):
        got = df.select(g.contains(g.edges(F.col("ring")), F.col("x"), F.col("y"), boundary).alias("in"))
        assert [r["in"] for r in got.collect()] == want


def test_holes(spark):
    outer, hole = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)], [(3.0, 3.0), (6.0, 3.0), (6.0, 6.0), (3.0, 6.0)]
    roi = spark.createDataFrame([(outer, [hole])], f"ring {RING}, holes array<{RING}>")
    points = spark.createDataFrame([(1, 4.5, 4.5), (2, 1.0, 1.0), (3, 20.0, 1.0)], "id int, x double, y double")
    assert rows(geometry.within_roi(points, roi, ["id"], tile=2.0, holes="holes").select("id")) == [(2,)]


def test_triangle_burns_like_a_loop(spark):
    tri = [(0.3, 0.2), (17.4, 3.1), (5.5, 14.9)]
    df = spark.createDataFrame([(1, 7, tri)], f"poly_id long, val int, ring {RING}")
    got = {(r["row_id"], r["col_id"]) for r in grid.rasterize(df, grid.Grid(), ["val"], "poly_id").collect()}

    def inside(x, y):
        n = 0
        for (x1, y1), (x2, y2) in zip(tri, tri[1:] + tri[:1], strict=True):
            n += (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
        return n % 2 == 1

    assert got == {(r, c) for r in range(20) for c in range(20) if inside(c + 0.5, r + 0.5)}


def test_centroid_and_buffer(spark):
    df = spark.createDataFrame([([(1e6, 2e6), (1e6 + 3, 2e6), (1e6, 2e6 + 3)],), ([(0.0, 0.0), (1.0, 1.0)],)], f"ring {RING}")
    got = geometry.polygon_centroid(df).select("x", "y").collect()
    assert got[0]["x"] == pytest.approx(1e6 + 1, abs=1e-9) and got[0]["y"] == pytest.approx(2e6 + 1, abs=1e-9) and got[1]["x"] is None
    ring = geometry.buffer_points(spark.createDataFrame([(5.0, 6.0)], "x double, y double"), 2.0).first()["ring"]
    assert len(ring) == 65 and all(math.hypot(p["x"] - 5, p["y"] - 6) == pytest.approx(2) for p in ring)


def test_buffers_compute_their_point_once(spark):
    # a centre that differs each time it is computed
    ring = spark.range(1).select(g.circle(F.rand(1) * 1000, F.rand(2) * 1000, 2.0).alias("ring")).first()["ring"]
    x, y = (ring[0]["x"] + ring[32]["x"]) / 2, (ring[16]["y"] + ring[48]["y"]) / 2
    assert all(math.hypot(p["x"] - x, p["y"] - y) == pytest.approx(2) for p in ring)
    # points in one file are not left to one task
    assert geometry.buffer_points(spark.range(8).select(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).coalesce(1)).rdd.getNumPartitions() > 1


def test_utm_on_the_central_meridian(spark):
    got = geometry.reproject_utm(spark.createDataFrame([(-171.0, 0.0), (-171.0, -14.0)], "lon double, lat double")).collect()
    assert got[0]["x"] == pytest.approx(500000) and got[0]["y"] == pytest.approx(10000000)
    # 0.9996 times the length of the meridian arc of 14 degrees, by quadrature
    e2, phi = g.FLATTENING * (2 - g.FLATTENING), np.linspace(0, math.radians(14), 100_001)
    arc = np.trapezoid(g.SEMI_MAJOR * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5, phi)
    assert got[1]["y"] == pytest.approx(10000000 - 0.9996 * arc, abs=1e-3)


def test_polygonize(spark):
    # a ring of eight cells around a hole, two cells that touch at a corner, an unlabelled one
    ring = [(1, r, c) for r in range(3) for c in range(3) if (r, c) != (1, 1)]
    cells = spark.createDataFrame([*ring, (2, 10, 10), (2, 11, 11), (3, 5, 5), (0, 6, 6)], "seg_id long, row_id int, col_id int")
    labels = spark.createDataFrame([(1, 10), (2, 20)], "seg_id long, label int")
    got = rows(grid.polygonize_segments(cells, labels))
    assert [(s, c, n) for s, c, _, n in got] == [(1, 10, 8), (2, 20, 1), (2, 20, 1)]
    assert got[0][2] == "POLYGON ((0 0, 3 0, 3 3, 0 3, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))"
    assert {w for s, _, w, _ in got if s == 2} == {"POLYGON ((10 10, 11 10, 11 11, 10 11, 10 10))", "POLYGON ((11 11, 12 11, 12 12, 11 12, 11 11))"}


def test_pinched_part_keeps_simple_rings(spark):
    # a 4-connected part that meets itself at a corner
    part = {(0, 0), (0, 1), (0, 2), (1, 0), (2, 0), (2, 1), (1, 2)} - {(1, 1)}
    area = sum(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(q, q[1:], strict=False)) / 2 for q in grid._rings(part))
    assert area == len(part)
    for q in grid._rings({(0, 0), (0, 1), (1, 1), (1, 2), (0, 3), (0, 2)}):
        assert q[0] == q[-1]


def test_segment_id_column(spark):
    df = spark.createDataFrame([("5", 1)], "my_seg string, v int")
    assert grid.resolve_segment_id(df).first()["seg_id"] == 5
    with pytest.raises(ValueError, match="segment id"):
        grid.resolve_segment_id(df.select("v"))


def test_map_only_plans(spark):
    cells = spark.createDataFrame([(0, 0, 1.0, 2.0, 3.0, 4.0)], "row_id int, col_id int, red float, green float, blue float, nir float")
    assert "Exchange" not in plan(features.build_feature_cube(cells))
    counts = spark.createDataFrame([(1, 2, 3)], "seg_id long, label int, n long")
    assert plan(objects.majority_label(counts)).count("Exchange") == 1


def test_cells_round_trip_prunes(spark):
    path = new_path(spark, "cells")
    cells = spark.range(64 * 64).select((F.col("id") % 64 - 16).cast("int").alias("row_id"), (F.floor(F.col("id") / 64) - 16).cast("int").alias("col_id"), F.col("id").cast("float").alias("red"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        io.write_cells(cells, path, tile=8)
        files = len(spark.read.parquet(path).inputFiles())
        assert files >= 12 and rows(io.read_cells(spark, path)) == rows(cells)
        for window, most in (((-16, -8, -16, -8), 2), ((0, 16, 0, 16), 4), ((20, 21, 5, 6), 2), ((-16, 48, -16, 48), files), ((100, 200, 0, 5), 1)):
            r0, r1, c0, c1 = window
            got = io.read_cells(spark, path, window)
            assert rows(got) == rows(cells.filter(f"row_id >= {r0} AND row_id < {r1} AND col_id >= {c0} AND col_id < {c1}"))
            assert len(got.inputFiles()) <= most and "PushedFilters: [IsNotNull(row_id)" in plan(got)
        # more cells, by the library and by another writer
        more = cells.select((F.col("row_id") + 1000).cast("int").alias("row_id"), "col_id", "red")
        io.write_cells(more, path, "append", tile=32)
        other = cells.select((F.col("row_id") + 2000).cast("int").alias("row_id"), "col_id", "red").coalesce(1)
        other.write.mode("append").parquet(path)
        got = io.read_cells(spark, path, (1000, 1002, 0, 4))
        assert rows(got) == rows(more.filter("row_id >= 1000 AND row_id < 1002 AND col_id >= 0 AND col_id < 4")) and len(got.inputFiles()) <= 6
        assert io.read_cells(spark, path, (2000, 2001, 0, 4)).count() == 4 and io.read_cells(spark, path).count() == 3 * 64 * 64
        io.write_cells(cells.limit(0), path, "overwrite")
        assert io.read_cells(spark, path, (0, 1, 0, 1)).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_geojson(spark):
    path = new_path(spark, "geojson")
    df = spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)])], f"id int, ring {RING}")
    io.write_features(df, path, form="geojson")
    assert spark.read.text(path).first()[0] == '{"type":"Feature","properties":{"id":1},"geometry":{"type":"Polygon","coordinates":[[[0.0,0.0],[1.0,0.0],[0.0,1.0],[0.0,0.0]]]}}'


def test_model_separates_and_passes_nodata(spark):
    samples = spark.range(200).select((F.col("id") % 2 * 10 + 5).cast("int").alias("label"), (F.col("id") % 2 + F.rand(1) / 10).cast("float").alias("a"))
    trained = model.fit_classifier(samples, ["a"], trees=5, depth=2)
    cells = spark.createDataFrame([(0, 0, 0.05), (0, 1, 1.05), (0, 2, -9999.0), (0, 3, float("nan")), (0, 4, None)], "row_id int, col_id int, a float")
    assert [r[2] for r in rows(model.predict_cells(cells, trained))] == [5, 15, -9999, -9999, -9999]


def at_random(seed, height, width, n):
    rng = np.random.default_rng(seed)
    return [(int(s), r, c) for r in range(height) for c, s in enumerate(rng.integers(0, n + 1, width)) if rng.random() < 0.9]


def read_wkt(text):
    return [[tuple(map(float, p.split())) for p in ring.split(", ")] for ring in text.removeprefix("POLYGON ((").removesuffix("))").split("), (")]


def within(rings, x, y):
    crossed = sum((y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) for q in rings for (x1, y1), (x2, y2) in zip(q, q[1:], strict=False))
    return crossed % 2 == 1


@pytest.mark.parametrize("window", [3, 5, 512])
def test_polygons_cover_their_parts_whatever_the_window(spark, window):
    cells = at_random(window, 14, 17, 2) + [(9, 30, c) for c in range(40)]
    df = spark.createDataFrame(cells, "seg_id long, row_id int, col_id int")
    labels = spark.createDataFrame([(1, 10), (2, 20), (9, 90)], "seg_id long, label int")
    got = grid.segment_polygons(df, labels, window=window).withColumn("wkt", g.wkt(F.col("ring"), F.col("holes"))).collect()
    of, seen = {(r, c): s for s, r, c in cells if s}, {}
    for k, row in enumerate(got):
        rings = read_wkt(row["wkt"])
        assert [[(p["x"], p["y"]) for p in q] for q in [row["ring"], *row["holes"]]] == rings
        area = [sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(q, q[1:], strict=False)) / 2 for q in rings]
        assert area[0] > 0 and all(a < 0 for a in area[1:]) and sum(area) == row["n_cells"]
        own = {p for p in of if within(rings, p[1] + 0.5, p[0] + 0.5)}
        assert len(own) == row["n_cells"] and all(of[p] == row["seg_id"] for p in own)
        seen |= dict.fromkeys(own, k)
    assert seen.keys() == of.keys()
    for r, c in of:  # 4-connected cells of a segment share a polygon, and each polygon is connected
        for p in ((r + 1, c), (r, c + 1)):
            if of.get(p) == of[r, c]:
                assert seen[p] == seen[r, c]
    left, n = set(of), 0
    while left:
        n, queue = n + 1, [left.pop()]
        while queue:
            r, c = queue.pop()
            for p in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if p in left and of[p] == of[r, c]:
                    left.discard(p)
                    queue.append(p)
    assert n == len(got) and {row["class_code"] for row in got} == {10, 20, 90}


def test_polygons_in_metres_and_of_any_length(spark):
    at = grid.Grid(x0=412345.25, y0=8470123.5, dx=0.5, dy=-0.5)
    strip = spark.range(5000).select(F.lit(7).cast("long").alias("seg_id"), F.lit(3).alias("row_id"), F.col("id").cast("int").alias("col_id"))
    labels = spark.createDataFrame([(7, 10)], "seg_id long, label int")
    (row,) = grid.polygonize_segments(strip, labels, at).collect()
    assert row["n_cells"] == 5000
    assert read_wkt(row["wkt"]) == [[(412345.25, 8470122.0), (414845.25, 8470122.0), (414845.25, 8470121.5), (412345.25, 8470121.5), (412345.25, 8470122.0)]]


def test_holes_survive_the_writer(spark):
    ring = [(1, r, c) for r in range(3) for c in range(3) if (r, c) != (1, 1)]
    found = grid.segment_polygons(spark.createDataFrame(ring, "seg_id long, row_id int, col_id int"), spark.createDataFrame([(1, 10)], "seg_id long, label int"))
    io.write_features(found.select("seg_id", "ring", "holes"), path := new_path(spark, "geojson"), form="geojson", holes="holes")
    shape = spark.read.json(path).first()["geometry"]
    assert [len(q) for q in shape["coordinates"]] == [5, 5] and shape["coordinates"][1][0] == [1.0, 1.0]
    io.write_features(found.select("seg_id", "ring", "holes"), path := new_path(spark, "wkt"), holes="holes")
    assert len(read_wkt(spark.read.parquet(path).first()["wkt"])) == 2


def in_windows(cells, window, layers=1):
    """Cells ``segment, row, column`` as the arrays of each window, with the cells of others beside it."""
    out = []
    for layer in range(layers):
        for s, r, c in cells:
            near = [(r, c), (r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)]
            out += [(wr * 1000 + wc, layer, r, c, s, (wr, wc) == (r // window, c // window)) for wr, wc in {(y // window, x // window) for y, x in near}]
    np.random.default_rng(1).shuffle(out)
    return [np.array([x[k] for x in out], bool if k == 5 else "i8") for k in range(6)]


def parts_of(cells):
    """The 4-connected parts as sets of cells, one by one."""
    of, found = {(r, c): s for s, r, c in cells}, []
    left = set(of)
    while left:
        part, queue = set(), [left.pop()]
        while queue:
            r, c = queue.pop()
            part.add((r, c))
            for p in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if p in left and of[p] == of[r, c]:
                    left.discard(p)
                    queue.append(p)
        found.append((of[min(part)], part))
    return found


@pytest.mark.parametrize(("window", "height", "width", "n", "layers"), [(64, 40, 50, 1, 1), (64, 40, 50, 2, 2), (7, 30, 30, 1, 1), (5, 20, 40, 3, 2), (2, 12, 12, 1, 1), (1, 5, 5, 2, 1)])
def test_parts_of_many_windows_are_traced_at_once(window, height, width, n, layers):
    # with cells at negative places, holes, and parts that meet themselves at corners
    cells = [(s, r - 9, c - 11) for s, r, c in at_random(window + n, height, width, n) if s]
    got = grid.window_parts(*(given := in_windows(cells, window, layers)))
    want, every = [], set(cells)
    for key in sorted({(r // window, c // window) for _, r, c in cells}):
        for s, part in parts_of([q for q in cells if (q[1] // window, q[2] // window) == key]):
            beyond = [p for r, c in part for p in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)) if (p[0] // window, p[1] // window) != key and (s, *p) in every]
            want.append((s, min(part), len(part), len(beyond), [] if beyond else grid._rings(part)))
    ends = np.concatenate([[0], np.cumsum(got["ring_length"])])
    rings = {}
    for k, part in enumerate(got["ring_part"].tolist()):
        rings.setdefault(part, []).append([(x, y) for x, y in zip(got["x"][ends[k] : ends[k + 1]].tolist(), got["y"][ends[k] : ends[k + 1]].tolist(), strict=True)])
    sides = np.bincount(got["sides"][:, 0], minlength=len(got["first"]))
    found = [(int(given[4][f]), (int(given[2][f]), int(given[3][f])), int(got["cells"][k]), int(sides[k]), rings.get(k, [])) for k, f in enumerate(got["first"])]
    assert sorted(found) == sorted(want * layers)
    assert got["open"].tolist() == (sides > 0).tolist() and got["open"].any()


def test_windows_are_read_whole():
    keys = [1, 1, 1, 2, 3, 3, 3, 3, 3, 3, 4, 5]
    for size in (1, 2, 5, 100):
        batches = [pa.RecordBatch.from_pydict({"k": keys[i : i + size], "v": list(range(i, min(i + size, len(keys))))}) for i in range(0, len(keys), size)]
        got = [t.to_pydict() for t in grid._whole_windows(iter([batches[0].slice(0, 0), *batches]), "k", 3)]
        assert sum((t["v"] for t in got), []) == list(range(len(keys)))
        assert len(got) == len({k for k in keys}) - sum(len(set(t["k"])) - 1 for t in got)


def test_polygons_of_odd_labels(spark):
    cells = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 5, 5), (-4, 6, 6)], "seg_id long, row_id int, col_id int")
    labels = spark.createDataFrame([(1, 10), (1, 20), (2, None), (None, 5), (-4, 9), (8, 1)], "seg_id int, label long")
    for window in (1, 512):
        got = grid.polygonize_segments(cells.withColumn("class_code", F.lit("x")), labels, window=window)
        assert rows(got) == [(1, 10, "POLYGON ((0 0, 2 0, 2 1, 0 1, 0 0))", 2), (1, 20, "POLYGON ((0 0, 2 0, 2 1, 0 1, 0 0))", 2), (2, None, "POLYGON ((2 0, 3 0, 3 1, 2 1, 2 0))", 1)]


def test_measures_of_polygons(spark):
    square, hole = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)], [(3.0, 3.0), (3.0, 6.0), (6.0, 6.0), (6.0, 3.0), (3.0, 3.0)]
    far = [(1e6, 2e6), (1e6 + 3, 2e6), (1e6, 2e6 + 3.5)]
    given = [(square, [hole, hole[:-1]]), ([*square, square[0]], []), (None, None), ([], []), (hole, []), (far, []), (far[::-1], [])]
    df = spark.createDataFrame(given, f"ring {RING}, holes array<{RING}>")

    def less(f, sign):
        return F.aggregate("holes", F.abs(f(F.col("ring"))), lambda s, h: s + sign * F.abs(f(h)))

    got = df.select(g.polygon_measures(F.col("ring"), F.col("holes")), less(g.ring_area, -1), less(g.ring_length, 1)).collect()
    assert [tuple(r[0]) for r in got] == [(r[1], r[2]) for r in got]
    assert [r[0]["area"] for r in got] == [63.0, 81.0, None, 0.0, 9.0, 5.25, 5.25]


def test_counts_of_cells_with_their_segment(spark):
    cells = [(0, 0, 1, 7), (0, 1, 1, 7), (0, 2, 1, 8), (0, 3, 0, 7), (0, 4, 2, -9999), (0, 5, None, 8), (0, 6, 2, 8)]
    df = spark.createDataFrame(cells, "row_id int, col_id int, seg_id long, label int")
    got = objects.segment_class_counts(None, df)
    assert rows(got) == rows(objects.segment_class_counts(df.drop("label"), df.drop("seg_id"))) == [(1, 7, 2), (1, 8, 1), (2, 8, 1)]
    assert "Join" not in plan(got)


def test_polygonize_nothing(spark):
    none = spark.createDataFrame([], "seg_id long, row_id int, col_id int")
    assert grid.polygonize_segments(none, spark.createDataFrame([(1, 10)], "seg_id long, label int")).count() == 0


def test_tiles_carry_their_own_edges(spark):
    ring = [(50 + 40 * math.cos(k * math.pi / 200), 50 + 40 * math.sin(k * math.pi / 200)) for k in range(400)]
    df = spark.createDataFrame([(ring,)], f"ring {RING}")
    tiles = region.Region.build(df, 10.0).tiles.selectExpr("tx", "ty", "covered", "size(shapes[0].edge_list) AS n").collect()
    assert max(t["n"] or 0 for t in tiles) < 40 and sum(t["n"] or 0 for t in tiles) < 500
    assert all(t["covered"] == (t["n"] is None) for t in tiles) and any(t["covered"] for t in tiles)
    rng = np.random.default_rng(0)
    points = [(k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(0, 100, (400, 2)))]
    got = {r["id"] for r in geometry.within_roi(spark.createDataFrame(points, "id int, x double, y double"), df, ["id"], tile=10.0).collect()}
    assert got == {k for k, x, y in points if within([[*ring, ring[0]]], x, y)}
