"""Rasters as tables of cells: alignment, tiles, resampling, burning and tracing polygons.

A cell is keyed by ``row_id, col_id``; the absence of a cell stands for background.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landspark.functions import geometry as g
from landspark.functions.components import components
from landspark.operators.region import Region
from landspark.sources.shared import materialize

NODATA = -9999
#: Cells on a side of the windows in which parts of segments are found.
WINDOW = 512
#: Rows from which on a task traces the windows that it has read; a window is never cut.
AT_ONCE = 1 << 17


@dataclass(frozen=True)
class Grid:
    """Origin and step of a raster; the centre of cell (r, c) is (x0 + (c + .5) dx, y0 + (r + .5) dy)."""

    x0: float = 0.0
    y0: float = 0.0
    dx: float = 1.0
    dy: float = 1.0
    width: int = 0
    height: int = 0
    crs: str = ""

    def x(self, col: Column) -> Column:
        return self.x0 + (col + 0.5) * self.dx

    def y(self, row: Column) -> Column:
        return self.y0 + (row + 0.5) * self.dy


def check_alignment(a: Grid, b: Grid) -> None:
    """Raises if sizes or reference systems differ; warns if origins or steps do."""
    if (a.width, a.height) != (b.width, b.height):
        raise ValueError(f"grids differ in size: {a.width} x {a.height} and {b.width} x {b.height}")
    if a.crs != b.crs:
        raise ValueError(f"grids differ in reference system: {a.crs} and {b.crs}")
    if (a.x0, a.y0, a.dx, a.dy) != (b.x0, b.y0, b.dx, b.dy):
        warnings.warn("grids differ in origin or step", stacklevel=2)


def alignment_report(a: DataFrame, b: DataFrame) -> DataFrame:
    """``side, n, min_row, max_row, min_col, max_col, unmatched`` for both tables of cells."""

    def one(side: str, own: DataFrame, other: DataFrame) -> DataFrame:
        other = other.select("row_id", "col_id").distinct().withColumn("_in", F.lit(True))
        found = own.select("row_id", "col_id").join(other, ["row_id", "col_id"], "left")
        return found.agg(
            F.lit(side).alias("side"), F.count("*").alias("n"), F.min("row_id").alias("min_row"), F.max("row_id").alias("max_row"), F.min("col_id").alias("min_col"), F.max("col_id").alias("max_col"), F.count_if(F.col("_in").isNull()).alias("unmatched")
        )

    return one("a", a, b).unionByName(one("b", b, a))


def stack_bands(*bands: DataFrame) -> DataFrame:
    """Joins rasters by cell in one grouped pass; a cell that a raster lacks is null there.

    A raster has a cell once. Columns of different rasters must have different names. Rasters stored in
    equal buckets (:mod:`landspark.sources.stored`) are better joined, as that moves nothing.
    """
    own = [[c for c in b.columns if c not in ("row_id", "col_id")] for b in bands]
    names = [c for some in own for c in some]
    if len(set(names)) < len(names):
        raise ValueError("rasters share a column name")
    types = {c: b.schema[c].dataType for b, some in zip(bands, own, strict=True) for c in some}
    every = [b.select("row_id", "col_id", *[F.col(c) if c in some else F.lit(None).cast(types[c]).alias(c) for c in names]) for b, some in zip(bands, own, strict=True)]
    return reduce(DataFrame.unionByName, every).groupBy("row_id", "col_id").agg(*[F.any_value(c, True).alias(c) for c in names])


def assign_tiles(cells: DataFrame, grid: Grid, size: int = 1024) -> DataFrame:
    """Adds ``tile_r, tile_c`` and the tile's height and width, which are less at the far edges."""
    r, c = F.floor(F.col("row_id") / size).cast("int"), F.floor(F.col("col_id") / size).cast("int")
    out = cells.withColumns({"tile_r": r, "tile_c": c})
    return out.withColumns({"tile_h": F.least(F.lit(size), grid.height - F.col("tile_r") * size), "tile_w": F.least(F.lit(size), grid.width - F.col("tile_c") * size)})


def clip_to_aoi(cells: DataFrame, aoi: DataFrame, grid: Grid, bands: tuple[str, ...], nodata: float = NODATA, tile: float = 1000.0) -> DataFrame:
    """Cells of the window around the area; bands are nodata where the centre is outside it.

    The window is four numbers of the area, put into the filter, so that it reaches the
    scan. Cells are joined with the area's tiles once and keep their number.
    """
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    box = aoi.agg(F.min(F.array_min(xs)), F.max(F.array_max(xs)), F.min(F.array_min(ys)), F.max(F.array_max(ys))).first()
    if box[0] is None:
        return cells.limit(0)
    lo_c, hi_c = sorted(((box[0] - grid.x0) / grid.dx, (box[1] - grid.x0) / grid.dx))
    lo_r, hi_r = sorted(((box[2] - grid.y0) / grid.dy, (box[3] - grid.y0) / grid.dy))
    window = cells.filter((F.col("col_id") > lo_c - 1) & (F.col("col_id") < hi_c) & (F.col("row_id") > lo_r - 1) & (F.col("row_id") < hi_r))
    found = Region.build(aoi, tile).with_inside(window, grid.x(F.col("col_id")), grid.y(F.col("row_id")), "_in", "half_open")
    return found.select(*[F.when(F.col("_in"), F.col(c)).otherwise(F.lit(nodata).cast(cells.schema[c].dataType)).alias(c) if c in bands else F.col(c) for c in cells.columns])


def rasterize(polygons: DataFrame, grid: Grid, value_cols: list[str], order: str, holes: str | None = None) -> DataFrame:
    """``row_id, col_id`` and the values of the last polygon, by ``order``, that has the cell's centre.

    Each edge is followed from row to row of the grid and marks the first cell behind it there. Along a
    row, the marks of a polygon's edges turn it on and off, so every other gap between marks is a run of
    cells; cells are listed from runs at the end. The work is in rows that edges pass, runs and
    cells that are burnt, and a large polygon is as many groups as it has rows. Edges are half-open.
    """
    rings = polygons.select(F.col(order).alias("order_key"), F.struct(*value_cols).alias("values"), F.monotonically_increasing_id().alias("_poly"), g.polygon_edges(F.col("ring"), F.col(holes) if holes else None).alias("edge_list"))
    rings, e = rings.select("order_key", "values", "_poly", F.explode("edge_list").alias("e")), F.col("e")

    def first_at(c: Column, origin: float, step: float) -> Column:
        """The first row or column, in the order of numbers, whose centre may lie behind a coordinate."""
        return F.ceil((c - origin) / step - 0.5)

    a, b = first_at(e["y1"], grid.y0, grid.dy), first_at(e["y2"], grid.y0, grid.dy)
    low, high = F.least(a, b) - 1, F.greatest(a, b)  # one more on either side, for rounding
    if grid.height:
        low, high = F.greatest(low, F.lit(0)), F.least(high, F.lit(grid.height - 1))
    passed = rings.filter(e["y1"] != e["y2"]).withColumn("row_id", F.explode(F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))))
    y = grid.y(F.col("row_id"))
    passed = passed.filter(g.straddles(e["y1"], e["y2"], y)).withColumn("_x", e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]))
    guess = first_at(F.col("_x"), grid.x0, grid.dx)
    # a centre counts as behind an edge as its coordinate is compared with the crossing, whatever the quotient was rounded to
    before = [(grid.x(guess + d) < F.col("_x")) if grid.dx > 0 else (grid.x(guess + d) >= F.col("_x")) for d in (-1, 0)]
    marks = passed.select("_poly", "order_key", "values", "row_id", (guess - 1 + sum((c.cast("int") for c in before), F.lit(0))).alias("_from"))
    along = W.partitionBy("_poly", "row_id").orderBy("_from")
    runs = marks.withColumns({"_nth": F.row_number().over(along), "_to": F.lead("_from").over(along) - 1}).filter("_nth % 2 = 1")
    start, end = F.col("_from"), F.col("_to")
    if grid.width:
        start, end = F.greatest(start, F.lit(0)), F.least(end, F.lit(grid.width - 1))
    burnt = runs.select("row_id", "order_key", "values", F.explode(F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<bigint>"))).alias("col_id"))
    last = burnt.groupBy("row_id", "col_id").agg(F.max_by("values", "order_key").alias("v"))
    return last.select(F.col("row_id").cast("int").alias("row_id"), F.col("col_id").cast("int").alias("col_id"), *[F.col("v")[c].alias(c) for c in value_cols])


def resample_nearest(targets: DataFrame, cells: DataFrame, src: Grid, dst: Grid) -> DataFrame:
    """Cells of ``targets`` (of ``dst``) with the values of the source cell that has their centre."""
    at = targets.select("row_id", "col_id", F.floor((dst.y(F.col("row_id")) - src.y0) / src.dy).cast("int").alias("_r"), F.floor((dst.x(F.col("col_id")) - src.x0) / src.dx).cast("int").alias("_c"))
    source = cells.withColumnsRenamed({"row_id": "_r", "col_id": "_c"})
    return at.join(source, ["_r", "_c"], "left").drop("_r", "_c")


def resample_bilinear(targets: DataFrame, cells: DataFrame, src: Grid, dst: Grid, bands: tuple[str, ...], nodata: float = NODATA) -> DataFrame:
    """Cells of ``targets`` with bands weighted over the four nearest source centres.

    Neighbours that are absent or nodata are left out and the weights of the others
    scaled; without any the band is nodata. Equal grids need no neighbours and are joined.
    """
    if (src.x0, src.y0, src.dx, src.dy) == (dst.x0, dst.y0, dst.dx, dst.dy):
        found = targets.select("row_id", "col_id").join(cells.select("row_id", "col_id", *bands), ["row_id", "col_id"], "left")
        return found.select("row_id", "col_id", *[F.coalesce(F.col(b), F.lit(nodata).cast("float")).alias(b) for b in bands])
    v, u = (dst.y(F.col("row_id")) - src.y0) / src.dy - 0.5, (dst.x(F.col("col_id")) - src.x0) / src.dx - 0.5
    at = targets.select("row_id", "col_id", F.floor(v).cast("int").alias("_r0"), F.floor(u).cast("int").alias("_c0"), (v - F.floor(v)).alias("_fr"), (u - F.floor(u)).alias("_fc"))
    corners = []
    for i in (0, 1):
        for j in (0, 1):
            w = (F.col("_fr") if i else 1 - F.col("_fr")) * (F.col("_fc") if j else 1 - F.col("_fc"))
            corners.append(F.struct((F.col("_r0") + i).alias("_r"), (F.col("_c0") + j).alias("_c"), w.alias("_w")))
    near = at.select("row_id", "col_id", F.inline(F.array(*corners))).filter("_w > 0")
    near = near.join(cells.withColumnsRenamed({"row_id": "_r", "col_id": "_c"}), ["_r", "_c"], "left")
    out = []
    for b in bands:
        ok = F.col(b) != F.lit(nodata).cast("float")
        mean = F.try_divide(F.sum(F.when(ok, F.col("_w") * F.col(b))), F.sum(F.when(ok, F.col("_w"))))
        out.append(F.coalesce(mean, F.lit(nodata)).cast("float").alias(b))
    return near.groupBy("row_id", "col_id").agg(*out)


def resolve_segment_id(df: DataFrame) -> DataFrame:
    """``df`` with ``seg_id long`` from the column of that name, else the first whose name has "id" or "seg"."""
    name = "seg_id" if "seg_id" in df.columns else next((c for c in df.columns if "id" in c.lower() or "seg" in c.lower()), None)
    if name is None:
        raise ValueError(f"no column can be the segment id: {df.columns}")
    return df.withColumn("seg_id", F.col(name).cast("long"))


#: Sides of a cell: the step to the neighbour, and where the side begins and ends, the cell on its left.
_SIDES = (((-1, 0), (0, 0), (1, 0)), ((0, 1), (1, 0), (1, 1)), ((1, 0), (1, 1), (0, 1)), ((0, -1), (0, 1), (0, 0)))


def linked_rings(edges: np.ndarray) -> list[list[tuple[int, int]]]:
    """Closed corner rings of directed edges ``x1, y1, x2, y2``, the part on their left: the outer ring first, then holes."""
    ahead: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for x1, y1, x2, y2 in edges.tolist():
        ahead.setdefault((x1, y1), []).append((x2, y2))
    rings = []
    for start in sorted(ahead):
        while ahead.get(start):
            ring, at, step = [start], start, (0, 0)
            while True:
                options = ahead[at]
                # where the part meets itself at a corner, the left turn stays on the same cell
                to = max(options, key=lambda p: step[0] * np.sign(p[1] - at[1]) - step[1] * np.sign(p[0] - at[0])) if len(options) > 1 else options[0]
                options.remove(to)
                way = ((to[0] > at[0]) - (to[0] < at[0]), (to[1] > at[1]) - (to[1] < at[1]))
                if way == step:
                    ring[-1] = to
                else:
                    ring.append(to)
                at, step = to, way
                if at == start:
                    break
            rings.append(ring)
    return sorted(rings, key=lambda q: -sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(q, q[1:], strict=False)))


def _rings(part: set[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """The rings of a set of cells ``row, column``."""
    sides = [(c + a[0], r + a[1], c + b[0], r + b[1]) for r, c in part for (dr, dc), a, b in _SIDES if (r + dr, c + dc) not in part]
    return linked_rings(np.array(sides).reshape(-1, 4))


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of the component of each of ``n`` nodes, given links from ``a`` to ``b``."""
    least = np.arange(n)
    while len(a):
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := least[least], least):
            least = up
        a, b = least[a], least[b]
        a, b = a[a != b], b[a != b]
    return least


def _straight(edges: np.ndarray) -> np.ndarray:
    """Unit edges of one part and direction each (``part, x1, y1, x2, y2``), joined where they go straight on."""
    way = edges[:, 3:] - edges[:, 1:3]
    along = np.where(way[:, 0] != 0, edges[:, 1] * way[:, 0], edges[:, 2] * way[:, 1])
    across = np.where(way[:, 0] != 0, edges[:, 2], edges[:, 1])
    keys = np.stack([edges[:, 0], way[:, 0], way[:, 1], across, along])
    order = np.lexsort(keys[::-1])
    keys, edges = keys[:, order], edges[order]
    begins = np.concatenate([[True], (keys[:4, 1:] != keys[:4, :-1]).any(0) | (keys[4, 1:] != keys[4, :-1] + 1)])
    starts = np.flatnonzero(begins)
    ends = np.concatenate([starts[1:], [len(edges)]]) - 1
    return np.concatenate([edges[starts, :3], edges[ends, 3:]], axis=1)


def _neighbours(order: np.ndarray, along: np.ndarray, across: np.ndarray, alike: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The number of the cell before and after each cell along a line of equal cells (-1 for none), in an order that goes along lines."""
    before, after = np.full(len(order), -1), np.full(len(order), -1)
    a, b = order[:-1], order[1:]
    same = (along[b] == along[a] + 1) & (across[b] == across[a])
    for key in alike:
        same &= key[b] == key[a]
    before[b[same]], after[a[same]] = a[same], b[same]
    return before, after


def _cycles(x: np.ndarray, y: np.ndarray, ahead: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Closed rings of corners, each followed by the corner ``ahead``: a ring's part and length, and all corners' ``x, y``.

    Rings are ordered by part, the outer one first, and start at their least corner. All corners step
    along at once, twice as far each time, so the passes are as many as the longest ring's length has digits.
    """
    n = len(x)
    rank = np.empty(n, "i8")
    rank[np.lexsort((y, x))] = np.arange(n)
    least, to = rank, ahead
    for _ in range(n.bit_length()):
        if np.array_equal(least, least[ahead]):
            break
        least, to = np.minimum(least, least[to]), to[to]
    starts = np.flatnonzero(least == rank)
    ring = np.empty(n, "i8")
    ring[rank[starts]] = np.arange(len(starts))
    ring = ring[least]
    final = least[ahead] == rank[ahead]
    left, to = np.where(final, 0, 1), np.where(final, np.arange(n), ahead)
    for _ in range(n.bit_length()):
        if final[to].all():
            break
        left, to = left + left[to], to[to]
    length, area = left[starts] + 1, np.zeros(len(starts), "i8")
    np.add.at(area, ring, x * y[ahead] - x[ahead] * y)
    order = np.lexsort((rank[starts], -area, part[starts]))
    place = np.empty(len(starts), "i8")
    place[order] = np.concatenate([[0], np.cumsum(length[order] + 1)[:-1]])
    out = np.empty((2, n + len(starts)), "i8")
    at = place[ring] + length[ring] - 1 - left
    out[0, at], out[1, at] = x, y
    out[:, place + length] = out[:, place]
    return part[starts][order], length[order] + 1, out[0], out[1]


def window_parts(windows: np.ndarray, layers: np.ndarray, rows: np.ndarray, cols: np.ndarray, segments: np.ndarray, own: np.ndarray) -> dict[str, np.ndarray]:
    """The 4-connected parts of segments within windows, given windows' ``own`` cells and those of others beside them.

    Cells of different ``layers`` do not meet. Of each part there are its ``first`` cell (as its place among
    the cells given), the number of its ``cells`` and whether it is ``open``, that is goes on in another window. Rings of closed parts are
    ``ring_part``, ``ring_length`` and their corners ``x, y``; of open parts there are ``edges``, straight runs between
    the part and other cells, and ``sides``, the unit sides behind which it goes on, both with their part in front.
    Nothing is looped over but passes over all cells.
    """
    order = np.lexsort((cols, rows, layers, windows))
    w, layer, r, c, s, own = (a[order] for a in (windows, layers, rows.astype("i8"), cols.astype("i8"), segments, own))
    n, alike = len(order), (w, layer, s)
    left, right = _neighbours(np.arange(n), c, r, alike)
    up, down = _neighbours(np.lexsort((r, c, layer, w)), r, c, alike)
    beside = np.stack([up, right, down, left])  # as in _SIDES
    inside = own & (beside >= 0) & own[beside]
    # runs of a row are joined with those that they touch below
    run = np.cumsum(own & ~inside[3]) - 1
    above = np.flatnonzero(inside[2])
    touch = np.stack([run[above], run[down[above]]])
    touch = touch[:, np.concatenate([[True], (touch[:, 1:] != touch[:, :-1]).any(0)])] if len(above) else touch
    runs = int((own & ~inside[3]).sum())
    roots, part_of_run = np.unique(_joined(runs, *touch), return_inverse=True)
    part = np.where(own, part_of_run[run], -1) if runs else np.full(n, -1)
    parts = len(roots)
    across = own & (beside >= 0) & ~inside
    is_open = np.zeros(parts, bool)
    is_open[part[across.any(0)]] = True

    def unit(side: np.ndarray, cell: np.ndarray) -> np.ndarray:
        a, b = (np.array([q[k] for q in _SIDES])[side] for k in (1, 2))
        return np.stack([part[cell], c[cell] + a[:, 0], r[cell] + a[:, 1], c[cell] + b[:, 0], r[cell] + b[:, 1]], axis=1)

    edge, opened = own & (beside < 0), own & is_open[part] if parts else own
    sides, edges = unit(*np.nonzero(across)), unit(*np.nonzero(edge & opened))
    edges = _straight(edges) if len(edges) else edges
    # along each edge of a closed part to the next: to the left on the same cell, straight on, or to the right
    side, cell = np.nonzero(edge & ~opened)
    number = np.empty((4, n), "i8")
    number[side, cell] = np.arange(len(side))
    ahead = beside[(side + 1) % 4, cell]
    beyond = beside[side, ahead]
    way = np.where(ahead < 0, 1, np.where(beyond < 0, 0, 3))
    follow = number[(side + way) % 4, np.where(way == 1, cell, np.where(way == 0, ahead, beyond))]
    turns = way != 0
    end = np.where(turns, np.arange(len(side)), follow)
    while not np.array_equal(to := end[end], end):
        end = to
    corner = np.zeros(len(side), bool)
    corner[follow[turns]] = True
    corners = np.flatnonzero(corner)
    nth = np.cumsum(corner) - 1
    at = unit(side[corners], cell[corners])
    ring_part, ring_length, x, y = _cycles(at[:, 1], at[:, 2], nth[follow[end[corners]]], at[:, 0])
    starts = np.flatnonzero(own & ~inside[3])[roots] if parts else roots
    return {
        "first": order[starts], "cells": np.bincount(part[own], minlength=parts), "open": is_open, "ring_part": ring_part, "ring_length": ring_length, "x": x, "y": y,
        "edges": edges[np.argsort(edges[:, 0], kind="stable")], "sides": sides[np.argsort(sides[:, 0], kind="stable")],
    }


_RINGS = "ring array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>"
_EDGES = "array<struct<x1:int,y1:int,x2:int,y2:int>>"


def _structs(columns: dict[str, np.ndarray]) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype("i4"))


def _as_edges(edges: np.ndarray, parts: int) -> pa.Array:
    """Edges with their part in front, in the parts' order, as a list for each part."""
    return pa.ListArray.from_arrays(_offsets(np.bincount(edges[:, 0], minlength=parts)), _structs({c: edges[:, k].astype("i4") for k, c in enumerate(("x1", "y1", "x2", "y2"), 1)}))


def _as_rings(parts: int, ring_part: np.ndarray, ring_length: np.ndarray, x: np.ndarray, y: np.ndarray, grid: Grid) -> dict[str, pa.Array]:
    """``ring`` and ``holes`` of each part, on a grid, given its rings with the outer one first; a part without rings has an empty ring."""
    outer = np.concatenate([[True], ring_part[1:] != ring_part[:-1]])[: len(ring_part)]
    corner, x, y = np.repeat(outer, ring_length), grid.x0 + x * float(grid.dx), grid.y0 + y * float(grid.dy)
    lengths = np.zeros(parts, "i8")
    lengths[ring_part[outer]] = ring_length[outer]
    ring, hole = (_structs({"x": x[own], "y": y[own]}) for own in (corner, ~corner))
    inner = pa.ListArray.from_arrays(_offsets(ring_length[~outer]), hole)
    return {"ring": pa.ListArray.from_arrays(_offsets(lengths), ring), "holes": pa.ListArray.from_arrays(_offsets(np.bincount(ring_part[~outer], minlength=parts)), inner)}


def _whole_windows(batches: Iterator[pa.RecordBatch], key: str, at_once: int) -> Iterator[pa.Table]:
    """Rows in the order of ``key`` as tables of at least ``at_once`` rows, but for the last, with all rows of each key."""
    kept, n = [], 0
    for batch in batches:
        if batch.num_rows:
            kept.append(pa.Table.from_batches([batch]))
            n += batch.num_rows
        if n < at_once or kept[0].column(key)[0] == kept[-1].column(key)[-1]:
            continue
        rows = pa.concat_tables(kept)
        keys = rows.column(key).to_numpy()
        done = int(np.searchsorted(keys, keys[-1]))
        yield rows.slice(0, done)
        kept, n = [rows.slice(done)], n - done
    if n:
        yield pa.concat_tables(kept)


def segment_polygons(segments: DataFrame, labels: DataFrame, grid: Grid | None = None, window: int = WINDOW) -> DataFrame:
    """``seg_id, class_code, n_cells, ring, holes``: a polygon for every 4-connected part of a labelled segment.

    ``segments`` has one row per cell, ``labels`` one per segment. Only labelled segments
    are kept before anything is gathered, and cells take their label along. Cells are gathered by window, whatever their
    segment, with those of other windows beside them; parts that do not go on there are traced at once, all parts of
    a window and small windows together. Where a part goes on, the sides of both windows meet and join their
    parts. The joined parts are connected components, and each is
    traced from its edges, so a part of any size is one polygon and no task holds more than
    a few windows' cells or one polygon's outline. ``window`` changes no result.
    """
    grid = grid or Grid()
    # joined before tracing, so what labels are derived from is computed once
    known = materialize(labels.select("seg_id", F.col("label").cast("int").alias("class_code")), "known")
    cells = segments.filter("seg_id > 0").select("seg_id", "row_id", "col_id").join(known, "seg_id")
    cells = cells.select(F.col("seg_id").cast("long"), "class_code", F.col("row_id").cast("int"), F.col("col_id").cast("int"))
    # a cell on its window's border goes to the windows beside it, too
    (wr, r), (wc, c) = ((F.floor(F.col(x) / window), F.pmod(F.col(x), F.lit(window))) for x in ("row_id", "col_id"))

    def key(dr: int, dc: int) -> Column:
        return F.shiftleft(wr + dr, 32) + (wc + dc)

    last = window - 1
    others = [F.when(x == at, key(*step)) for x, at, step in ((r, 0, (-1, 0)), (r, last, (1, 0)), (c, 0, (0, -1)), (c, last, (0, 1)))]
    within = r.between(1, last - 1) & c.between(1, last - 1)
    dealt = cells.select("*", F.explode(F.when(within, F.array(key(0, 0))).otherwise(F.array(key(0, 0), *others))).alias("_window")).filter("_window IS NOT NULL")
    corner, edge = pa.struct([("x", pa.float64()), ("y", pa.float64())]), pa.struct([(x, pa.int32()) for x in ("x1", "y1", "x2", "y2")])
    kinds = {
        "seg_id": pa.int64(), "class_code": pa.int32(), "n_cells": pa.int64(), "open": pa.bool_(), "part": pa.struct([("r", pa.int32()), ("c", pa.int32())]),
        "ring": pa.list_(corner), "holes": pa.list_(pa.list_(corner)), "edges": pa.list_(edge), "sides": pa.list_(edge),
    }

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in _whole_windows(batches, "_window", AT_ONCE):
            windows, row, col = (cells.column(x).to_numpy() for x in ("_window", "row_id", "col_id"))
            own = windows == (row.astype("i8") // window << 32) + col.astype("i8") // window
            if not own.any():
                continue
            layer = cells.column("class_code")
            found = window_parts(windows, layer.fill_null(0).to_numpy() + (layer.is_null().to_numpy().astype("i8") << 32), row, col, cells.column("seg_id").to_numpy(), own)
            first, parts = found["first"], len(found["first"])
            out = {x: cells.column(x).take(pa.array(first)).combine_chunks() for x in ("seg_id", "class_code")}
            out |= {"n_cells": pa.array(found["cells"]), "open": pa.array(found["open"]), "part": _structs({"r": row[first], "c": col[first]})}
            out |= _as_rings(parts, found["ring_part"], found["ring_length"], found["x"], found["y"], grid)
            out |= {x: _as_edges(found[x], parts) for x in ("edges", "sides")}
            yield from pa.table({x: out[x].cast(t) for x, t in kinds.items()}).to_batches(max_chunksize=10_000)

    parts = dealt.repartition("_window").sortWithinPartitions("_window").mapInArrow(trace, f"seg_id long, class_code int, n_cells long, open boolean, part struct<r:int,c:int>, {_RINGS}, edges {_EDGES}, sides {_EDGES}")
    parts = materialize(parts, "parts")

    # what goes on in another window
    open_parts = parts.filter("open")
    place = [F.least("x1", "x2").alias("x"), F.least("y1", "y2").alias("y"), (F.col("x1") == F.col("x2")).alias("upright")]
    met = open_parts.select("seg_id", "class_code", "part", F.inline("sides")).groupBy("seg_id", "class_code", *place).agg(F.min("part").alias("a"), F.max("part").alias("b"))
    joined = components(met.select("a", "b"))
    whole = open_parts.select("seg_id", "class_code", "n_cells", "part", "edges").join(joined, F.col("part") == F.col("node"), "left").withColumn("whole", F.coalesce("component", "part"))

    def close(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        flat = rows.column("edges").combine_chunks().flatten()
        rings = linked_rings(np.stack([flat.field(x).to_numpy() for x in ("x1", "y1", "x2", "y2")], axis=1).astype("i8"))
        x, y = np.array([p for ring in rings for p in ring], "i8").reshape(-1, 2).T
        n = pa.compute.sum(rows.column("n_cells"))
        out = {"seg_id": pa.array([key[0].as_py()], pa.int64()), "class_code": pa.array([key[1].as_py()], pa.int32()), "n_cells": pa.array([n.as_py()], pa.int64())}
        return pa.table(out | _as_rings(1, np.zeros(len(rings), "i8"), np.array([len(q) for q in rings]), x, y, grid))

    traced = whole.groupBy("seg_id", "class_code", "whole").applyInArrow(close, f"seg_id long, class_code int, n_cells long, {_RINGS}")
    return traced.unionByName(parts.filter("NOT open").select(*traced.columns))


def polygonize_segments(segments: DataFrame, labels: DataFrame, grid: Grid | None = None, window: int = WINDOW) -> DataFrame:
    """``seg_id, class_code, wkt, n_cells``: the polygons of :func:`segment_polygons` as text, with all digits."""
    found = segment_polygons(segments, labels, grid, window)
    return found.select("seg_id", "class_code", g.wkt(F.col("ring"), F.col("holes"), whole=True).alias("wkt"), "n_cells")
