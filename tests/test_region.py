"""Points within dissolved regions, adaptive tiles, and burning by runs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landspark.functions import geometry as g
from landspark.operators import geometry, grid
from landspark.operators.region import Region
from tests.conftest import rows

RING = "array<struct<x:double,y:double>>"


def box(x, y, w=1.0, h=1.0):
    return [(float(x), float(y)), (float(x + w), float(y)), (float(x + w), float(y + h)), (float(x), float(y + h))]


def inside(spark, polygons, points, holes=False, **settings):
    """The numbers of the points that are inside; ``polygons`` are rings, or rings and their holes."""
    roi = spark.createDataFrame([p if holes else (p,) for p in polygons], f"ring {RING}" + f", holes array<{RING}>" * holes)
    at = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(points)], "id int, x double, y double")
    found = geometry.within_roi(at, roi, ["id"], holes="holes" if holes else None, **settings)
    return sorted(r["id"] for r in found.collect())


def crosses(ring, x, y):
    n = 0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        n += (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
    return n


def in_union(polygons, x, y):
    """Whether a small circle around a point lies in the union, which edges of small integer corners can't hide."""
    turns = [k * 2 * math.pi / 480 + 0.0011 for k in range(480)]
    return all(any(sum(crosses(r, x + 1e-4 * math.cos(a), y + 1e-4 * math.sin(a)) for r in rings) % 2 for rings in polygons) for a in turns)


SEAMS = [(1, 0.5), (1, 0), (1, 1), (0.5, 0.5), (2, 0.5), (0, 0), (1, 1.5), (1.5, 1), (1, 2)]


@pytest.mark.parametrize("tile", [0.7, 1000.0])
def test_shared_edges_corners_and_junctions(spark, tile):
    cases = [
        ([box(0, 0), box(1, 0)], [0, 3]),
        ([box(0, 0), box(1, 0), box(0, 1), box(1, 1)], [0, 2, 3, 6, 7]),
        ([box(0, 0, 1, 2), box(1, 0), box(1, 1)], [0, 2, 3, 6, 7]),  # a border that meets the middle of another
        ([box(0, 0), box(1, 1)], [3]),  # a corner alone joins nothing
        ([box(0, 0), box(1, 0), box(0, 1)], [0, 3]),  # a quarter is missing
    ]
    polygons = [[(x + 10 * k, y) for x, y in ring] for k, (own, _) in enumerate(cases) for ring in own]
    points = [(x + 10 * k, y) for k in range(len(cases)) for x, y in SEAMS]
    assert inside(spark, polygons, points, tile=tile) == [k * len(SEAMS) + n for k, (_, want) in enumerate(cases) for n in want]


def test_holes_filled_by_others(spark):
    outer, hole = box(0, 0, 9, 9), box(3, 3, 3, 3)
    points = [(4.5, 4.5), (3, 4), (3, 3), (1, 1), (6, 6), (0, 5)]
    cases = [([(outer, [hole])], [3]), ([(outer, [hole]), (hole, None)], [0, 1, 2, 3, 4]), ([(outer, [hole, box(3, 6, 1, 1)]), (hole, [])], [0, 1, 2, 3, 4])]
    moved = [tuple(None if rings is None else [[(x + 20 * k, y) for x, y in r] for r in rings] for rings in ([ring], inner)) for k, (own, _) in enumerate(cases) for ring, inner in own]
    found = inside(spark, [(ring[0], inner) for ring, inner in moved], [(x + 20 * k, y) for k in range(3) for x, y in points], holes=True, tile=7.0)
    assert found == [6 * k + n for k, (_, want) in enumerate(cases) for n in want]


@pytest.mark.parametrize("seed", range(2))
def test_union_by_small_circles(spark, seed):
    rng = np.random.default_rng(seed)
    polygons = []
    for _ in range(14):
        if rng.random() < 0.5:
            x, y, w, h = rng.integers(0, 6, 2).tolist() + rng.integers(1, 4, 2).tolist()
            polygons.append(box(x, y, w, h)[:: rng.choice([1, -1])])
        else:
            corners = rng.integers(0, 8, (3, 2)).astype(float).tolist()
            if np.linalg.det(np.subtract(corners[1:], corners[0])):
                polygons.append([tuple(c) for c in corners])
    points = [(x / 2, y / 2) for x in range(-1, 19) for y in range(-1, 19)]
    want = [k for k, (x, y) in enumerate(points) if in_union([[p] for p in polygons], x, y)]
    for tile, most in ((1.0, 256), (64.0, 24)):
        assert inside(spark, polygons, points, tile=tile, most_edges=most) == want


def test_any_tiles_give_the_same(spark):
    rng = np.random.default_rng(5)
    star = [(50 + (20 + 28 * (k % 2)) * math.cos(k * math.pi / 60), 50 + (20 + 28 * (k % 2)) * math.sin(k * math.pi / 60)) for k in range(120)]
    comb = [(5.0, 5.0)] + [(5.0 + k / 4, 95.0 if k % 2 else 8.0) for k in range(1, 320)] + [(90.0, 5.0)]
    points = [tuple(p) for p in rng.uniform(0, 100, (1500, 2)).tolist()]
    want = [k for k, (x, y) in enumerate(points) if crosses(star, x, y) % 2 or crosses(comb, x, y) % 2]
    roi = spark.createDataFrame([(star,), (comb,)], f"ring {RING}")
    at = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(points)], "id int, x double, y double")
    for tile, most in ((1000.0, 10**9), (200.0, 60), (13.0, 40)):
        region = Region.build(roi, tile, most_edges=most)
        assert region.tiles.filter(f"aggregate(shapes, 0, (n, s) -> n + size(s.edge_list)) > {most}").isEmpty()
        for boundary in ("exclude", "half_open"):
            assert sorted(r["id"] for r in region.with_inside(at, F.col("x"), F.col("y"), "in", boundary).filter("in").collect()) == want


def test_dense_tile_is_cut(spark):
    """A hundred thousand triangles in what was one tile."""
    at = spark.range(100_000).selectExpr("id % 400 * 2.5 AS x", "floor(id / 400) * 4.0 AS y")
    roi = at.select(F.array(*[F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")) for dx, dy in ((0.1, 0.1), (2.3, 0.2), (1.2, 3.9))]).alias("ring"))
    region = Region.build(roi, 1000.0, most_edges=200)
    sizes = region.tiles.filter("NOT covered").selectExpr("depth", "aggregate(shapes, 0, (n, s) -> n + size(s.edge_list)) AS n").collect()
    assert max(r["n"] for r in sizes) <= 200 and sum(r["n"] for r in sizes) < 600_000 and len(sizes) > 1500
    points = at.select((F.col("x") + 1.2).alias("x"), (F.col("y") + 1.3).alias("y")).union(at.select(F.col("x") + 2.35, F.col("y") + 3.0))
    assert rows(region.with_inside(points, F.col("x"), F.col("y"), "in").groupBy("in").count()) == [(False, 100_000), (True, 100_000)]


def test_points_and_polygons_without_coordinates(spark):
    points = spark.createDataFrame([(1, None, 1.0), (2, 0.5, 0.5), (3, 0.5, None)], "id int, x double, y double")
    roi = spark.createDataFrame([(box(0, 0),), (None,), ([],), ([(3.0, 3.0)],)], f"ring {RING}")
    assert rows(geometry.within_roi(points, roi, ["id"], tile=1.0).select("id")) == [(2,)]
    assert geometry.within_roi(points, roi.limit(0), ["id"]).count() == 0 and geometry.within_roi(points.limit(0), roi, ["id"]).count() == 0


@pytest.mark.parametrize("step", [(1.0, 1.0), (0.7, -0.3), (-2.0, 0.9)])
def test_burning_equals_testing_each_centre(spark, step):
    rng = np.random.default_rng(3)
    shapes = [(k, k % 5, [tuple(p) for p in (rng.integers(0, 40, (5, 2)) / 2).tolist()], [box(4, 4, 3, 5)] if k % 3 == 0 else None) for k in range(12)]
    own = grid.Grid(x0=1.25 if step[0] > 0 else 21.0, y0=2.0 if step[1] > 0 else 17.5, dx=step[0], dy=step[1], width=30, height=40)
    df = spark.createDataFrame(shapes, f"poly_id long, val int, ring {RING}, holes array<{RING}>").repartition(3)
    got = {(r["row_id"], r["col_id"]): (r["val"], r["poly_id"]) for r in grid.rasterize(df, own, ["val", "poly_id"], "poly_id", holes="holes").collect()}
    want = {}
    for k, val, ring, holes in shapes:
        for r in range(own.height):
            for c in range(own.width):
                x, y = own.x0 + (c + 0.5) * own.dx, own.y0 + (r + 0.5) * own.dy
                if sum(crosses(one, x, y) for one in [ring, *(holes or [])]) % 2:
                    want[r, c] = (val, k)
    assert got == want and len(got) > 100


def test_burning_is_work_in_rows_and_runs(spark):
    """Three thousand teeth over two hundred rows: marks are few for each, and nothing is tested cell by cell."""
    comb = [(0.0, 0.0)] + [(0.25 + k, 200.0 if k % 2 else 10.0) for k in range(3000)] + [(3000.0, 0.0)]
    df = spark.createDataFrame([(1, comb)], f"poly_id long, ring {RING}")
    burnt = grid.rasterize(df, grid.Grid(), ["poly_id"], "poly_id")
    plan = burnt._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Generate explode") == 3
    xs, ys = np.arange(3001) + 0.5, np.arange(200) + 0.5
    odd = np.zeros((200, 3001), bool)
    for (x1, y1), (x2, y2) in zip(comb, comb[1:] + comb[:1], strict=True):
        if y1 != y2:
            odd ^= (((y1 <= ys) != (y2 <= ys))[:, None]) & (xs[None, :] < (x1 + (ys - y1) * (x2 - x1) / (y2 - y1))[:, None])
    assert burnt.count() == odd.sum()


def test_sectors(spark):
    df = spark.createDataFrame([(box(0, 0), 0.0, 0.0), (box(0, 0), 1.0, 1.0), (box(0, 0), 0.5, 0.0), (box(0, 0), 0.5, 0.5)], f"ring {RING}, x double, y double")
    edges, x, y = g.edges(F.col("ring")), F.col("x"), F.col("y")
    first = g.path_parity(edges, x, y, F.lit(9.0), F.lit(9.0), True)
    got = [[(round(s["lo"] / math.pi, 9), round(s["hi"] / math.pi, 9)) for s in r["s"]] for r in df.select(g.sectors(edges, x, y, first).alias("s")).collect()]
    assert got == [[(0, 0.5)], [(1, 1.5)], [(0, 1)], [(0, 2)]]
