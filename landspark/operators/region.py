"""Points inside a region of many polygons, by tiles that adapt to where edges are dense.

A region's edges are cut by a grid of tiles, and a tile with more edges than a stated number is
cut in four, again and again. A tile holds the edges that meet it and no others, and says of
each of these polygons whether it has the tile's upper right corner. Whether a
polygon has a point then follows from the edges that a path from the point to that corner
crosses: to the right up to the tile's border, and upwards along it. Which side of an edge a
point is on is one expression wherever it is asked, so that the two legs of a path agree where they meet.
Corners of smaller tiles are told in the same way from the tile that they are cut from, so no step
sees more than the edges of a tile, and these are rows: only the tiles that are left at the end
become arrays. Tiles that a polygon covers whole need no edges at all.

The union of the polygons is what counts, as if shared borders were dissolved: a point on
borders is inside if the sectors of the polygons around it leave no gap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landspark.functions import geometry as g
from landspark.sources.shared import Scratch, materialize

#: Times that a tile is cut in four, at most; a tile with too many edges through one point stays too full.
DEPTH = 20
#: A hair more than a tile, as its number is a rounded quotient.
HAIR = 1e-6
#: Gaps between sectors, in radians, that are rounding.
SLIVER = 1e-9
EDGE = ("x1", "y1", "x2", "y2")


def _meets(e: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """Whether an edge meets a box."""
    in_box = (F.greatest(e["x1"], e["x2"]) >= x0) & (F.least(e["x1"], e["x2"]) <= x1) & (F.greatest(e["y1"], e["y2"]) >= y0) & (F.least(e["y1"], e["y2"]) <= y1)
    sides = [g.turn(e, x, y) for x in (x0, x1) for y in (y0, y1)]
    return in_box & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def _box(tx: Column, ty: Column, size: float) -> tuple[Column, Column, Column, Column]:
    return (tx - HAIR) * size, (tx + 1 + HAIR) * size, (ty - HAIR) * size, (ty + 1 + HAIR) * size


def _edge() -> Column:
    return F.struct(*EDGE)


def _base(edges: DataFrame, tile: float, write) -> tuple[DataFrame, DataFrame]:
    """The edges of each tile of the first grid, with ``ref``, and the tiles that a polygon covers.

    A corner is inside if an odd number of its polygon's edges pass to its right, which a running
    count along each row of tiles tells.
    """
    e, low, high = _edge(), F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("ty", F.explode(F.sequence(F.floor(low / tile - HAIR), F.floor(high / tile + HAIR))))
    # the part of the edge within the row gives the tiles that it may meet
    slope = F.coalesce(F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")), F.lit(0.0))
    at = [F.col("x1") + (F.least(F.greatest((F.col("ty") + d) * tile, low), high) - F.col("y1")) * slope for d in (-HAIR, 1 + HAIR)]
    level = F.col("y1") == F.col("y2")
    first = F.when(level, F.least("x1", "x2")).otherwise(F.greatest(F.least(*at), F.least("x1", "x2")))
    last = F.when(level, F.greatest("x1", "x2")).otherwise(F.least(F.greatest(*at), F.greatest("x1", "x2")))
    local = rows.withColumn("tx", F.explode(F.sequence(F.floor(first / tile - 1e-3), F.floor(last / tile + 1e-3))))
    local = local.filter(_meets(e, *_box(F.col("tx"), F.col("ty"), tile)))

    top = (F.col("ty") + 1) * tile
    crossing = rows.filter(g.straddles(e["y1"], e["y2"], top)).withColumn("_k", F.floor((F.col("x1") + (top - F.col("y1")) * slope) / tile))
    # the last tile whose corner is to the left of the edge, by the expression that all use
    is_left = reduce(lambda a, b: a + b, [g.left_of(e, (F.col("_k") + d) * tile, top).cast("int") for d in (-1, 0, 1, 2)])
    events = crossing.groupBy("poly", "ty", (F.col("_k") - 3 + is_left).cast("long").alias("tx")).agg(F.count("*").alias("crossed"), F.lit(0).alias("n"))
    seen = events.unionByName(local.groupBy("poly", "ty", "tx").agg(F.lit(0).cast("long").alias("crossed"), F.max(F.lit(1)).alias("n")))
    seen = seen.groupBy("poly", "ty", "tx").agg(F.sum("crossed").alias("crossed"), F.max("n").alias("n"))
    leftward = W.partitionBy("poly", "ty").orderBy(F.desc("tx"))
    seen = seen.withColumn("ref", F.sum("crossed").over(leftward) % 2 == 1).withColumn("_next", F.lead("tx").over(leftward))
    seen = write(seen, "corners")
    # between two tiles with edges all corners are alike
    none = F.array().cast("array<bigint>")
    between = F.when(F.col("_next") + 1 < F.col("tx"), F.sequence(F.col("_next") + 1, F.col("tx") - 1)).otherwise(none)
    own = F.when(F.col("n") == 0, F.array("tx")).otherwise(none)
    covered = seen.filter("ref").select(F.explode(F.concat(between, own)).alias("tx"), "ty").distinct()
    local = local.join(seen.filter("n > 0").select("poly", "tx", "ty", "ref"), ["poly", "tx", "ty"])
    return local.select("poly", "tx", "ty", "ref", *EDGE).join(covered, ["tx", "ty"], "left_anti"), covered


def _quarters(full: DataFrame, size: float) -> tuple[DataFrame, DataFrame]:
    """As :func:`_base`, for the quarters of the given tiles of that size."""
    e, half = _edge(), size / 2
    kids = [(F.col("tx") * 2 + i, F.col("ty") * 2 + j) for i in (0, 1) for j in (0, 1)]
    corner = (F.col("tx") + 1) * size, (F.col("ty") + 1) * size
    crossed = [F.sum(g.path_crosses(e, (tx + 1) * half, (ty + 1) * half, *corner).cast("int")) for tx, ty in kids]
    refs = full.groupBy("poly", "tx", "ty", "ref").agg(*[c.alias(f"n{k}") for k, c in enumerate(crossed)])
    odd = [F.struct(tx.alias("tx"), ty.alias("ty"), (F.col("ref") != (F.col(f"n{k}") % 2 == 1)).alias("ref")) for k, (tx, ty) in enumerate(kids)]
    refs = refs.select("poly", F.inline(F.array(*odd)))
    dealt = F.explode(F.array(*[F.when(_meets(e, *_box(tx, ty, half)), F.struct(tx.alias("tx"), ty.alias("ty"))) for tx, ty in kids])).alias("kid")
    local = full.select("poly", *EDGE, dealt).filter("kid IS NOT NULL").select("poly", *EDGE, "kid.tx", "kid.ty")
    covered = refs.filter("ref").join(local.select("poly", "tx", "ty").distinct(), ["poly", "tx", "ty"], "left_anti").select("tx", "ty").distinct()
    local = local.join(refs, ["poly", "tx", "ty"]).select("poly", "tx", "ty", "ref", *EDGE)
    return local.join(covered, ["tx", "ty"], "left_anti"), covered


class Region:
    """The tiles of a region: ``depth, tx, ty, covered, shapes``, and for each depth the tiles that are cut further.

    A shape is what a polygon has of a tile: ``edge_list`` and whether the tile's upper right corner is inside, ``ref``.
    """

    def __init__(self, tiles: DataFrame, cut: list[DataFrame], tile: float):
        self.tiles, self.cut, self.tile = tiles, cut, tile

    @classmethod
    def build(cls, polygons: DataFrame, tile: float, holes: str | None = None, most_edges: int = 256) -> Region:
        """Tiles of the side ``tile`` and smaller ones of at most ``most_edges`` edges, but for edges that :data:`DEPTH` cuts don't part.

        A polygon without a ring is left out, as are edges without a length.
        """
        with Scratch(polygons.sparkSession) as write:
            named = polygons.select(F.monotonically_increasing_id().alias("poly"), g.polygon_edges(F.col("ring"), F.col(holes) if holes else None).alias("edge_list"))
            edges = named.select("poly", F.inline("edge_list")).filter("x1 != x2 OR y1 != y2")
            local, covered = _base(write(edges, "edges"), tile, write)
            done, cut, size, depth = [], [], tile, 0
            while True:
                local = write(local, "tile-edges")
                done.append((depth, local, covered))
                full = local.groupBy("tx", "ty").agg(F.count("*").alias("n")).filter(F.col("n") > most_edges).select("tx", "ty")
                if depth == DEPTH or full.isEmpty():
                    break
                cut.append(materialize(full, "cut-tiles"))
                done[-1] = (depth, local.join(cut[-1], ["tx", "ty"], "left_anti"), covered)
                local, covered = _quarters(local.join(cut[-1], ["tx", "ty"], "left_semi"), size)
                local, covered = write(local, "quarter-edges"), write(covered, "covered")
                size, depth = size / 2, depth + 1
            parts = []
            for d, own, inner in done:
                shapes = own.groupBy("tx", "ty", "poly", "ref").agg(F.collect_list(F.struct(*EDGE)).alias("edge_list"))
                shapes = shapes.groupBy("tx", "ty").agg(F.collect_list(F.struct("edge_list", "ref")).alias("shapes"))
                parts.append(shapes.select(F.lit(d).alias("depth"), "tx", "ty", F.lit(False).alias("covered"), "shapes"))
                parts.append(inner.select(F.lit(d).alias("depth"), "tx", "ty", F.lit(True).alias("covered"), F.lit(None).cast(shapes.schema["shapes"].dataType).alias("shapes")))
            return cls(materialize(reduce(DataFrame.unionByName, parts), "tiles"), cut, tile)

    def with_inside(self, points: DataFrame, x: Column, y: Column, out: str, boundary: str = "exclude") -> DataFrame:
        """``points`` with ``out``: whether they are inside. A point stays one row; without coordinates it is outside.

        ``boundary`` is ``exclude`` (points on the border of the region are outside, those on
        borders within it inside) or ``half_open`` (points on lower and left edges are inside, on upper and right ones outside).
        """
        if boundary not in ("exclude", "half_open"):
            raise ValueError("boundary is 'exclude' or 'half_open'")
        at = points.withColumns({"_px": x, "_py": y, "_depth": F.lit(0)})

        def place(c: str, size: Column | float) -> Column:
            return F.floor(F.col(c) / size)

        for d, cut in enumerate(self.cut):
            size = self.tile / 2**d
            own = cut.select(F.col("tx").alias("_tx"), F.col("ty").alias("_ty"), F.lit(d).alias("_d"))
            found = at.join(own, (place("_px", size) == F.col("_tx")) & (place("_py", size) == F.col("_ty")) & (F.col("_depth") == F.col("_d")), "left")
            at = found.withColumn("_depth", F.when(F.col("_d").isNotNull(), d + 1).otherwise(F.col("_depth"))).drop("_tx", "_ty", "_d")
        size = F.lit(self.tile) / F.pow(F.lit(2.0), F.col("_depth"))
        at = at.withColumns({"_tx": place("_px", size), "_ty": place("_py", size)})
        tiles = self.tiles.select(F.col("depth").alias("_depth"), F.col("tx").alias("_tx"), F.col("ty").alias("_ty"), F.col("covered").alias("_covered"), F.col("shapes").alias("_shapes"))
        near = at.join(tiles, ["_depth", "_tx", "_ty"], "left")
        px, py, cx, cy = F.col("_px"), F.col("_py"), (F.col("_tx") + 1) * size, (F.col("_ty") + 1) * size
        if boundary == "half_open":
            inside = F.exists("_shapes", lambda s: g.path_parity(s["edge_list"], px, py, cx, cy) != s["ref"])
        else:
            touched = F.filter("_shapes", lambda s: F.exists(s["edge_list"], lambda e: g.touches(e, px, py)))
            inside = F.exists("_shapes", lambda s: ~F.exists(s["edge_list"], lambda e: g.touches(e, px, py)) & (g.path_parity(s["edge_list"], px, py, cx, cy) != s["ref"]))
            sectors = F.flatten(F.transform(touched, lambda s: g.sectors(s["edge_list"], px, py, g.path_parity(s["edge_list"], px, py, cx, cy, True) != s["ref"])))
            inside = inside | (F.size(touched) > 1) & g.whole_turn(sectors, SLIVER)
        inside = F.col("_covered") | inside
        return near.withColumn(out, F.coalesce(inside, F.lit(False))).select(*points.columns, out)
