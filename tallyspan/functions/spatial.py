"""Spatial predicates on coordinate arrays of floats."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, functions as F


def _f(x) -> Column:
    """A coordinate as a 32-bit float."""
    return (x if isinstance(x, Column) else F.lit(float(x))).cast("float")


def coordinate(*parts: Column) -> Column:
    """Coordinate of several columns; null unless every part is a number."""
    numbers = [p.try_cast("float") for p in parts]
    whole = reduce(lambda a, b: a & b, [n.isNotNull() for n in numbers])
    return F.when(whole, F.array(*numbers))


def decode(text: Column) -> Column:
    """Text ``x,y`` → coordinate; null if any part is no number."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("float"))
    return F.when(~F.exists(parts, lambda p: p.isNull()), parts)


def in_rectangle(point: Column, low: list[float], high: list[float]) -> Column:
    """Inside both corners, inclusive, in any number of dimensions."""
    inside = [(F.get(point, i) >= _f(a)) & (F.get(point, i) <= _f(b)) for i, (a, b) in enumerate(zip(low, high))]
    return F.coalesce(reduce(lambda a, b: a & b, inside), F.lit(False))


def in_radius(point: Column, centre: list[float], radius: float) -> Column:
    """Euclidean distance at most the radius; the enclosing rectangle is tested first."""
    slack = radius * 1e-5 + 1e-30  # the rectangle is in floats, the distance in doubles
    near = in_rectangle(point, [x - radius - slack for x in centre], [x + radius + slack for x in centre])
    squares = [F.pow((F.get(point, i) - _f(x)).cast("double"), F.lit(2.0)) for i, x in enumerate(centre)]
    return near & (reduce(lambda a, b: a + b, squares) <= F.pow(_f(radius).cast("double"), F.lit(2.0)))


def in_polygon(point: Column, xs: list[float], ys: list[float]) -> Column:
    """Point in polygon; corners and border count as inside. Behind its bounding rectangle.

    A ray to the right crosses an edge whose two ends lie on different sides of its height, where a side is "at
    or below" or "above": each corner belongs to one side, so a ray through a corner is counted once. On which
    side of the edge the point lies is the sign of a cross product; zero within the edge's box is the border.
    Coordinates are 32-bit floats, products doubles.
    """
    if len(xs) != len(ys) or len(xs) < 3:
        raise ValueError("a polygon has at least three corners, each with two coordinates")
    corners = [(float(np.float32(x)), float(np.float32(y))) for x, y in zip(xs, ys)]
    x, y = (F.get(point, i).cast("double") for i in (0, 1))
    border, crossings = [], []
    for (ax, ay), (bx, by) in zip(corners, [*corners[1:], corners[0]]):
        turn = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        border.append((turn == 0) & x.between(min(ax, bx), max(ax, bx)) & y.between(min(ay, by), max(ay, by)))
        if ay != by:
            left = turn > 0 if by > ay else turn < 0
            crossings.append(F.when(((F.lit(ay) <= y) != (F.lit(by) <= y)) & left, 1).otherwise(0))
    box = in_rectangle(point, [min(xs), min(ys)], [max(xs), max(ys)])
    inside = reduce(lambda p, q: p + q, crossings, F.lit(0)) % 2 == 1
    return box & F.coalesce(reduce(lambda p, q: p | q, border) | inside, F.lit(False))
