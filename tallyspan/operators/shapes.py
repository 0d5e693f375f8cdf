"""Spatial join of points with boxes, circles and polygons given as data.

Every shape is covered by cells of a quadtree. The first ones are about half as wide as the shape; a cell that the
shape's border may cross is cut into four, some levels deep. Cells off the shape go; a cell that lies wholly inside
needs no further test. A cell of a polygon carries only those edges that a point in it can need, so each exact
test is short however many corners the polygon has. Points look up their one cell per level in use, by equality: no
pairs are formed, and a shape that covers everything is met cell by cell, in as many tasks as its cells fall into.

Coordinates are 32-bit floats. Deciding what to do with a cell leaves a margin for rounding, so the answer for a point
is always that of the exact test. Covers are made per shape over Arrow batches; points and their tests stay in the JVM.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyspan.session import materialise

DEEP = 2  # times that a border cell is cut
_MARGIN = 1e-6


def _f(c: Column) -> Column:
    return c.cast("float").cast("double")


def box(min_x: Column, max_x: Column, min_y: Column, max_y: Column) -> Column:
    """A shape column: points between both corners, borders included."""
    return _shape("box", box=[min_x, max_x, min_y, max_y])


def circle(x: Column, y: Column, radius: Column) -> Column:
    """A shape column: points at most the radius away."""
    return _shape("circle", circle=[x, y, radius])


def polygon(xs: Column, ys: Column) -> Column:
    """A shape column from arrays of corners, border included; null with fewer than three, uneven arrays, or missing coordinates."""
    fits = (F.size(xs) == F.size(ys)) & (F.size(xs) > 2) & ~F.exists(xs, lambda v: v.isNull()) & ~F.exists(ys, lambda v: v.isNull())
    ax, ay = (F.transform(v, _f) for v in (xs, ys))
    turned = lambda v: F.concat(F.slice(v, 2, F.size(v) - 1), F.slice(v, 1, 1))
    edges = F.zip_with(
        F.arrays_zip(ax.alias("x"), ay.alias("y")), F.arrays_zip(turned(ax).alias("x"), turned(ay).alias("y")),
        lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")),
    )
    return F.when(fits, _shape("polygon", edges=edges))


_EDGES = "array<struct<ax:double,ay:double,bx:double,by:double>>"


def _shape(kind: str, box=None, circle=None, edges=None) -> Column:
    none = F.lit(None).cast("double")
    lo_x, hi_x, lo_y, hi_y = map(_f, box) if box else [none] * 4
    x, y, radius = map(_f, circle) if circle else [none] * 3
    out = F.struct(
        F.lit(kind).alias("kind"), lo_x.alias("lo_x"), hi_x.alias("hi_x"), lo_y.alias("lo_y"), hi_y.alias("hi_y"),
        x.alias("x"), y.alias("y"), radius.alias("radius"), (edges if edges is not None else F.lit(None)).cast(_EDGES).alias("edges"),
    )
    known = [lo_x, hi_x, lo_y, hi_y] if box else [x, y, radius] if circle else []
    for c in known:
        out = F.when(c.isNotNull() & ~F.isnan(c), out)
    return out


def contains(shape: Column, x: Column, y: Column, edges: Column) -> Column:
    """The exact test, with the edges of a polygon or those of them that can matter for the point."""
    px, py = _f(x), _f(y)
    turn = lambda e: (e["bx"] - e["ax"]) * (py - e["ay"]) - (e["by"] - e["ay"]) * (px - e["ax"])
    border = lambda e: (
        (turn(e) == 0)
        & px.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
        & py.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
    )
    left = lambda e: ((e["ay"] <= py) != (e["by"] <= py)) & F.when(e["by"] > e["ay"], turn(e) > 0).otherwise(turn(e) < 0)
    inside = F.exists(edges, border) | (F.size(F.filter(edges, left)) % 2 == 1)
    # differences of coordinates are rounded to 32 bits, their squares are not
    far = F.pow(_f(px - shape["x"]), F.lit(2.0)) + F.pow(_f(py - shape["y"]), F.lit(2.0))
    return F.coalesce(
        F.when(shape["kind"] == "box", (px >= shape["lo_x"]) & (px <= shape["hi_x"]) & (py >= shape["lo_y"]) & (py <= shape["hi_y"]))
        .when(shape["kind"] == "circle", far <= F.pow(shape["radius"], F.lit(2.0)))
        .otherwise(inside),
        F.lit(False),
    )


def _box_of(shape: dict) -> tuple[float, ...] | None:
    """The box around a shape, with a margin around a circle; None if it holds no point."""
    if shape["kind"] == "box":
        out = shape["lo_x"], shape["hi_x"], shape["lo_y"], shape["hi_y"]
    elif shape["kind"] == "circle":
        x, y, r = shape["x"], shape["y"], abs(shape["radius"]) * (1 + _MARGIN)
        out = x - r, x + r, y - r, y + r
    else:
        xs, ys = [e["ax"] for e in shape["edges"]], [e["ay"] for e in shape["edges"]]
        out = min(xs), max(xs), min(ys), max(ys)
    return out if all(map(math.isfinite, out)) and out[0] <= out[1] and out[2] <= out[3] else None


def _top(lo_x: float, hi_x: float, lo_y: float, hi_y: float) -> int:
    """Level of cells about half as wide as a box."""
    width = max(hi_x - lo_x, hi_y - lo_y)
    return max(math.ceil(math.log2(width)) - 1, -40) if width > 0 else -40


def _cells(shape: dict, deep: int):
    """(level, cx, cy, wholly inside, edges that matter in it) of every cell of one shape's cover, by a quadtree."""
    bounds = _box_of(shape)
    if bounds is None:
        return
    kind, level = shape["kind"], _top(*bounds)
    lo_x, hi_x, lo_y, hi_y = bounds
    edges = np.array([(e["ax"], e["ay"], e["bx"], e["by"]) for e in shape["edges"] or ()], np.float64).reshape(-1, 4)
    side = 2.0**level
    first = [(level, x, y, edges) for x in range(math.floor(lo_x / side), math.floor(hi_x / side) + 1) for y in range(math.floor(lo_y / side), math.floor(hi_y / side) + 1)]
    while first:
        at, cx, cy, near = first.pop()
        side = 2.0**at
        slack = side * _MARGIN
        x0, x1, y0, y1 = cx * side - slack, (cx + 1) * side + slack, cy * side - slack, (cy + 1) * side + slack
        if kind == "box":
            off = x1 < shape["lo_x"] or x0 > shape["hi_x"] or y1 < shape["lo_y"] or y0 > shape["hi_y"]
            inside = x0 >= shape["lo_x"] and x1 <= shape["hi_x"] and y0 >= shape["lo_y"] and y1 <= shape["hi_y"]
        elif kind == "circle":
            x, y, r2 = shape["x"], shape["y"], shape["radius"] ** 2
            off = max(x0 - x, x - x1, 0.0) ** 2 + max(y0 - y, y - y1, 0.0) ** 2 > r2 * (1 + 4 * _MARGIN)
            inside = max(abs(x - x0), abs(x - x1)) ** 2 + max(abs(y - y0), abs(y - y1)) ** 2 < r2 * (1 - 4 * _MARGIN)
        else:
            ax, ay, bx, by = near.T
            # a ray to the right from a point of the cell meets only edges of its height that are not wholly to its left
            keep = (np.maximum(ay, by) >= y0) & (np.minimum(ay, by) <= y1) & (np.maximum(ax, bx) >= x0)
            near = near[keep]
            ax, ay, bx, by = near.T
            # an edge crosses the cell if their boxes meet and corners of the cell lie on both sides of it
            dx, dy = bx - ax, by - ay
            low = np.minimum(dx * y0, dx * y1) - np.maximum(dy * x0, dy * x1)
            high = np.maximum(dx * y0, dx * y1) - np.minimum(dy * x0, dy * x1)
            line = dx * ay - dy * ax
            crossed = bool(((np.minimum(ax, bx) <= x1) & (low <= line) & (line <= high)).any())
            x, y = (x0 + x1) / 2, (y0 + y1) / 2
            turn = dx * (y - ay) - dy * (x - ax)
            inside = not crossed and bool((((ay <= y) != (by <= y)) & np.where(by > ay, turn > 0, turn < 0)).sum() % 2)
            off = not crossed and not inside
        if off:
            continue
        if inside or at == level - deep:
            yield at, cx, cy, inside, near[:0] if inside else near
        else:
            first += [(at - 1, 2 * cx + x, 2 * cy + y, near) for x in (0, 1) for y in (0, 1)]


def covered(shapes: DataFrame, shape: str, deep: int = DEEP) -> DataFrame:
    """``shapes`` with a row per cell of each one's cover: ``_level``, ``_cx``, ``_cy``, ``_in``, ``_edges``. Null shapes have none."""
    cells = T._parse_datatype_string(f"_level int, _cx long, _cy long, _in boolean, _edges {_EDGES}")

    def run(batches):
        for batch in batches:
            for i, one in enumerate(batch.column(shape).to_pylist()):
                found = list(_cells(one, deep))
                if not found:
                    continue
                level, cx, cy, inside, edges = zip(*found)
                flat = np.concatenate(edges)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(4)], ["ax", "ay", "bx", "by"])
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(e) for e in edges]))).astype(np.int32))
                rows = pa.Table.from_batches([batch.slice(i, 1)]).take(pa.array([0] * len(level)))
                for name, values in (
                    ("_level", pa.array(level, pa.int32())), ("_cx", pa.array(cx, pa.int64())), ("_cy", pa.array(cy, pa.int64())),
                    ("_in", pa.array(inside, pa.bool_())), ("_edges", pa.ListArray.from_arrays(offsets, structs)),
                ):
                    rows = rows.append_column(name, values)
                yield from rows.combine_chunks().to_batches()

    whole = shapes.where(F.col(shape).isNotNull())
    return whole.mapInArrow(run, T.StructType([*whole.schema.fields, *cells.fields]))


def join_shapes(points: DataFrame, x: str, y: str, shapes: DataFrame, shape: str = "shape", deep: int = DEEP) -> DataFrame:
    """Every (point, shape) with the point in the shape; columns of both but the shape itself.

    ``shape`` is a column made by ``box``, ``circle`` or ``polygon``. Points without a coordinate (null or NaN), shapes that
    are null and shapes with coordinates that are not finite are in no pair. The cells are written when called, and their
    levels (a few dozen numbers at most) read. Where the cells are few Spark broadcasts them and no point is moved; else both
    sides meet by a hash of the cell, and adaptive execution splits a crowded one.
    """
    exact = F.struct(*[F.col(shape)[k].alias(k) for k in ("kind", "lo_x", "hi_x", "lo_y", "hi_y", "x", "y", "radius")])
    cells = materialise(covered(shapes, shape, deep).withColumn(shape, exact), "cells")
    levels = [r[0] for r in cells.select("_level").distinct().collect()]
    side = F.pow(F.lit(2.0), F.col("_level").cast("double"))
    known = ~F.isnan(_f(F.col(x))) & ~F.isnan(_f(F.col(y)))
    at = points.where(known).withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))
    at = at.withColumns({"_cx": F.floor(_f(F.col(x)) / side), "_cy": F.floor(_f(F.col(y)) / side)})
    met = at.join(cells, ["_level", "_cx", "_cy"])
    met = met.where(F.col("_in") | contains(F.col(shape), F.col(x), F.col(y), F.col("_edges")))
    return met.drop("_level", "_cx", "_cy", "_in", "_edges", shape)
