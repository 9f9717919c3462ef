"""Geometry as column expressions.

A ring is ``array<struct<x, y>>``, closed or not. A polygon has an outer ring and may have
holes; its edges are those of all its rings, and a point is inside if a ray from it
crosses an odd number of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The WGS84 ellipsoid, and the scale and false origin of UTM.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, FALSE_EASTING, FALSE_NORTHING_SOUTH = 0.9996, 500000.0, 10000000.0


def krueger() -> tuple[float, list[float]]:
    """The rectifying radius and the coefficients of Krüger's series to the fourth order."""
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    return radius, [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]


def utm(lon: Column, lat: Column, zone: int, south: bool) -> tuple[Column, Column]:
    """Easting and northing of WGS84 degrees by the transverse Mercator projection."""
    n = FLATTENING / (2 - FLATTENING)
    e = 2 * math.sqrt(n) / (1 + n)
    radius, alpha = krueger()
    phi, away = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east += a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north += a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return FALSE_EASTING + SCALE * radius * east, (FALSE_NORTHING_SOUTH if south else 0.0) + SCALE * radius * north


def rectangle(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """The closed ring of an axis-parallel rectangle."""
    corners = ((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin))
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners])


def edges(ring: Column) -> Column:
    """``array<struct<x1, y1, x2, y2>>``; the edge that closes an open ring is added."""
    ahead = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))
    return F.zip_with(ring, ahead, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def polygon_edges(ring: Column, holes: Column | None = None) -> Column:
    """The edges of the outer ring and of the holes."""
    return edges(ring) if holes is None else F.concat(edges(ring), F.coalesce(F.flatten(F.transform(holes, edges)), F.slice(edges(ring), F.lit(1), F.lit(0))))


def contains(edge_list: Column, x: Column, y: Column, boundary: str = "exclude") -> Column:
    """Whether a point is inside a polygon given by its edges.

    ``boundary`` is ``exclude`` (points on an edge are outside) or ``half_open`` (points on
    lower and left edges are inside, on upper and right ones outside, so that polygons
    that share an edge never share a point).
    """
    if boundary not in ("exclude", "half_open"):
        raise ValueError("boundary is 'exclude' or 'half_open'")

    def crossed(n: Column, e: Column) -> Column:
        at = e["x1"] + F.try_divide((y - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])
        return n + F.when(((e["y1"] <= y) != (e["y2"] <= y)) & (x < at), 1).otherwise(0)

    inside = F.aggregate(edge_list, F.lit(0), crossed) % 2 == 1
    if boundary == "half_open":
        return inside

    def touched(e: Column) -> Column:
        on_line = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])
        return on_line & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    return inside & ~F.exists(edge_list, touched)


def turn(e: Column, x: Column, y: Column) -> Column:
    """Positive if a point is on the left hand of one who goes along an edge, negative on the right, 0 on its line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])


def straddles(a: Column, b: Column, level: Column) -> Column:
    """Whether two values are on either side of a level, which itself counts as lower."""
    return (a <= level) != (b <= level)


def left_of(e: Column, x: Column, y: Column) -> Column:
    """Whether a point is to the left of an edge that passes its height."""
    s = turn(e, x, y)
    return F.when(e["y2"] > e["y1"], s > 0).otherwise(s < 0)


def below(e: Column, x: Column, y: Column) -> Column:
    """Whether a point is below an edge; points on its line count as to the right of it, like those of :func:`left_of`."""
    s = turn(e, x, y)
    return F.when(s == 0, (e["x2"] - e["x1"]) * (e["y2"] - e["y1"]) > 0).when(e["x2"] > e["x1"], s < 0).otherwise(s > 0)


def path_crosses(e: Column, x: Column, y: Column, cx: Column, cy: Column, passing: bool = False) -> Column:
    """Whether an edge is crossed an odd number of times on the way from ``x, y`` sideways to ``cx``, then to ``cx, cy``.

    With ``passing``, edges that the first point is on are not crossed sideways.
    """
    sideways = straddles(e["y1"], e["y2"], y) & (left_of(e, x, y) != left_of(e, cx, y))
    if passing:
        sideways = sideways & ~touches(e, x, y)
    return sideways != (straddles(e["x1"], e["x2"], cx) & (below(e, cx, y) != below(e, cx, cy)))


def path_parity(edge_list: Column, x: Column, y: Column, cx: Column, cy: Column, passing: bool = False) -> Column:
    """Whether that way crosses edges an odd number of times."""
    return F.aggregate(edge_list, F.lit(False), lambda odd, e: odd != path_crosses(e, x, y, cx, cy, passing))


def touches(e: Column, x: Column, y: Column) -> Column:
    """Whether a point is on an edge, ends included."""
    return (turn(e, x, y) == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))


def sectors(edge_list: Column, x: Column, y: Column, first: Column) -> Column:
    """``array<struct<lo, hi>>``: the angles around a point, from 0 to a full turn, at which a polygon is.

    ``first`` says whether it is at the least angle above 0. An edge that ends in the point is one direction, one
    that goes through it two; at each of them inside and outside change.
    """

    def angle(dx: Column, dy: Column) -> Column:
        a = F.atan2(dy, dx)
        return F.when(a <= 0, a + 2 * math.pi).otherwise(a)

    def ends(e: Column) -> Column:
        there = F.array(*[F.when((e[f"x{k}"] != x) | (e[f"y{k}"] != y), angle(e[f"x{k}"] - x, e[f"y{k}"] - y)) for k in (1, 2)])
        return F.filter(there, lambda a: a.isNotNull())

    at = F.array_sort(F.flatten(F.transform(F.filter(edge_list, lambda e: touches(e, x, y)), ends)))
    bounds = F.concat(F.array(F.lit(0.0)), at, F.array(F.lit(2 * math.pi)))
    spans = F.transform(F.sequence(F.lit(0), F.size(at)), lambda k: F.struct(bounds[k].alias("lo"), bounds[k + 1].alias("hi"), (first != (k % 2 == 1)).alias("own")))
    return F.transform(F.filter(spans, lambda s: s["own"] & (s["lo"] < s["hi"])), lambda s: F.struct(s["lo"].alias("lo"), s["hi"].alias("hi")))


def whole_turn(spans: Column, gap: float) -> Column:
    """Whether spans of angles leave no gap wider than ``gap`` in a full turn."""
    reached = F.aggregate(F.array_sort(spans), F.lit(0.0), lambda r, s: F.when(s["lo"] <= r + gap, F.greatest(r, s["hi"])).otherwise(r))
    return reached >= 2 * math.pi - gap


def centroid(ring: Column) -> Column:
    """The area-weighted centroid ``struct<x, y>``; null for a ring without area.

    Coordinates are taken relative to the first point, which keeps them exact far from 0.
    """
    first = ring[0]
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(s: Column, e: Column) -> Column:
        x1, y1, x2, y2 = e["x1"] - first["x"], e["y1"] - first["y"], e["x2"] - first["x"], e["y2"] - first["y"]
        cross = x1 * y2 - x2 * y1
        return F.struct((s["a"] + cross).alias("a"), (s["x"] + (x1 + x2) * cross).alias("x"), (s["y"] + (y1 + y2) * cross).alias("y"))

    s = F.aggregate(edges(ring), zero, add)
    return F.when(s["a"] != 0, F.struct((first["x"] + s["x"] / (3 * s["a"])).alias("x"), (first["y"] + s["y"] / (3 * s["a"])).alias("y")))


def circle(x: Column, y: Column, radius: float = 1.0, quadrant: int = 16) -> Column:
    """The closed ring of a regular polygon with ``4 * quadrant`` corners around a point.

    The point is bound to a variable first, so its coordinates are computed once: an expression for
    them that the optimizer moves into the function of the corners would be computed at each corner.
    """
    step = math.pi / 2 / quadrant
    around = F.array(*[F.struct(F.lit(radius * math.cos(i * step)).alias("x"), F.lit(radius * math.sin(i * step)).alias("y")) for i in range(4 * quadrant + 1)])
    centre = F.array(F.struct(x.alias("x"), y.alias("y")))
    return F.transform(centre, lambda p: F.transform(around, lambda c: F.struct((p["x"] + c["x"]).alias("x"), (p["y"] + c["y"]).alias("y"))))[0]


def wkt(ring: Column, holes: Column | None = None, whole: bool = False) -> Column:
    """Well-known text of a polygon, with all digits; with ``whole`` whole numbers have no fraction."""

    def number(c: Column) -> Column:
        return F.regexp_replace(c.cast("string"), r"\.0$", "") if whole else c.cast("string")

    def text(r: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat_ws(" ", number(p["x"]), number(p["y"]))), ", "), F.lit(")"))

    rings = F.array(text(ring)) if holes is None else F.concat(F.array(text(ring)), F.coalesce(F.transform(holes, text), F.array().cast("array<string>")))
    return F.concat(F.lit("POLYGON ("), F.array_join(rings, ", "), F.lit(")"))


def shape(ring: Column, holes: Column | None = None) -> Column:
    """A polygon as the struct that GeoJSON states."""

    def points(r: Column) -> Column:
        return F.transform(r, lambda p: F.array(p["x"], p["y"]))

    rings = F.array(points(ring)) if holes is None else F.concat(F.array(points(ring)), F.coalesce(F.transform(holes, points), F.array().cast("array<array<array<double>>>")))
    return F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates"))


def geojson(ring: Column, holes: Column | None = None) -> Column:
    """GeoJSON of a polygon."""
    return F.to_json(shape(ring, holes))


def ring_area(ring: Column) -> Column:
    """The area within a ring, positive if it goes round counterclockwise.

    Coordinates are taken relative to the first point, which keeps them exact far from 0.
    """
    first = ring[0]

    def add(s: Column, e: Column) -> Column:
        return s + (e["x1"] - first["x"]) * (e["y2"] - first["y"]) - (e["x2"] - first["x"]) * (e["y1"] - first["y"])

    return F.aggregate(edges(ring), F.lit(0.0), add) / 2


def ring_length(ring: Column) -> Column:
    """The length of a ring."""
    return F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"]))


def _measures(rings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The area within each ring, positive if it goes round counterclockwise, and its length."""
    sizes = rings.value_lengths().fill_null(0).to_numpy()
    points, ring = rings.flatten(), np.repeat(np.arange(len(sizes)), sizes)
    x, y = (points.field(c).to_numpy() for c in ("x", "y"))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ahead = np.arange(1, len(x) + 1)
    ahead[starts[1:][sizes > 0] - 1] = starts[:-1][sizes > 0]
    u, v = x - x[starts[ring]], y - y[starts[ring]]
    sums = (np.bincount(ring, a, len(sizes)) for a in (u * v[ahead] - u[ahead] * v, np.hypot(x[ahead] - x, y[ahead] - y)))
    return next(sums) / 2, next(sums)


def polygon_measures(ring: Column, holes: Column) -> Column:
    """``struct<area, outline>`` of a polygon: what is within its outer ring but in no hole, and the length of all its rings.

    The same as by :func:`ring_area` and :func:`ring_length`, for whole batches of polygons at once. Null holes are none.
    """

    @F.arrow_udf("struct<area:double,outline:double>")
    def measured(ring: pa.Array, holes: pa.Array) -> pa.Array:
        area, outline = _measures(ring)
        less, more = _measures(holes.flatten())
        row = np.repeat(np.arange(len(ring)), holes.value_lengths().fill_null(0).to_numpy())
        found = np.abs(area) - np.bincount(row, np.abs(less), len(ring)), outline + np.bincount(row, more, len(ring))
        return pa.StructArray.from_arrays([pa.array(v, mask=ring.is_null().to_numpy(False)) for v in found], ["area", "outline"])

    return measured(ring, holes)
