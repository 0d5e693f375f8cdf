"""Join with shapes as data: against the exact test on all pairs; covers and plans."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.functions import spatial as sp
from tallyspan.operators import shapes as sh

PARAMETERS = "shape_id long, kind string, a double, b double, r double, d double, xs array<double>, ys array<double>, x int, _level string"


def table(spark, rows):
    c = F.col
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], PARAMETERS)
    made = (
        F.when(c("kind") == "circle", sh.circle(c("a"), c("b"), c("r")))
        .when(c("kind") == "box", sh.box(c("a"), c("b"), c("r"), c("d")))
        .when(c("kind") == "polygon", sh.polygon(c("xs"), c("ys")))
    )
    return df.select("shape_id", made.alias("shape"))


def f(v):
    return float(np.float32(v))


def holds(row, px, py):
    _, kind, a, b, r, d, xs, ys = row
    if kind == "circle":
        return float(np.float32(px - f(a))) ** 2 + float(np.float32(py - f(b))) ** 2 <= f(r) ** 2
    if kind == "box":
        return f(a) <= px <= f(b) and f(r) <= py <= f(d)
    inside = False
    for (ax, ay), (bx, by) in zip(zip(map(f, xs), map(f, ys)), zip(map(f, xs[1:] + xs[:1]), map(f, ys[1:] + ys[:1]))):
        turn = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        if turn == 0 and min(ax, bx) <= px <= max(ax, bx) and min(ay, by) <= py <= max(ay, by):
            return True
        if (ay <= py) != (by <= py) and (turn > 0 if by > ay else turn < 0):
            inside = not inside
    return inside


def star(rng, x, y, r, n):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [x + r * rng.uniform(0.2, 1) * math.cos(t) for t in turns], [y + r * rng.uniform(0.2, 1) * math.sin(t) for t in turns]


@pytest.mark.parametrize("deep", [0, 3])
def test_join_equals_all_pairs(spark, deep):
    """Shapes of every size, some on the points and on the borders of cells, huge and empty ones."""
    rng = random.Random(deep)
    points = [(i, f(rng.gauss(0, 1)), f(rng.gauss(0, 1))) for i in range(250)]
    points += [(1000 + i, f(x / 4), f(y / 4)) for i, (x, y) in enumerate((x, y) for x in range(-3, 4) for y in range(-3, 4))]
    rows = []
    for i in range(60):
        x, y, r = rng.choice([(rng.gauss(0, 1), rng.gauss(0, 1)), points[i][1:], (0.25, 0.5)]) + (rng.choice([0.0, 0.01, 0.25, 0.5, 3.0, 500.0]),)
        kind = ["circle", "box", "polygon"][i % 3]
        if kind == "circle":
            rows.append((i, kind, x, y, r, None, None, None))
        elif kind == "box":
            rows.append((i, kind, x - r, x + r, y - r / 2, y + r, None, None))
        else:
            rows.append((i, kind, None, None, None, None, *star(rng, x, y, r, rng.choice([3, 5, 40]))))
    rows.append((100, "polygon", None, None, None, None, [0.0, 0.5, 0.5, 0.0], [0.0, 0.0, 0.5, 0.5]))
    got = sh.join_shapes(spark.createDataFrame(points, "id long, px float, py float"), "px", "py", table(spark, rows), deep=deep)
    assert got.columns == ["id", "px", "py", "shape_id"]
    got = [(r.id, r.shape_id) for r in got.collect()]
    want = [(i, row[0]) for i, px, py in points for row in rows if holds(row, px, py)]
    assert len(got) == len(set(got)) and set(got) == set(want)


def test_odd_shapes_and_points(spark):
    nan = float("nan")
    rows = [
        (1, "circle", None, 0.0, 1.0, None, None, None), (2, "box", 1.0, 0.0, 0.0, 1.0, None, None), (3, "polygon", None, None, None, None, [0.0, 1.0], [0.0, 1.0]),
        (4, "polygon", None, None, None, None, [0.0, 1.0, None], [0.0, 1.0, 2.0]), (5, None, None, None, None, None, None, None), (6, "circle", nan, 0.0, 1.0, None, None, None),
        (7, "circle", 0.0, 0.0, 1.0, None, None, None), (7, "circle", 0.0, 0.0, 1.0, None, None, None), (8, "box", 0.0, math.inf, 0.0, 1.0, None, None),
    ]
    points = spark.createDataFrame([(1, 0.5, 0.5), (1, 0.5, 0.5), (2, None, 0.5), (3, nan, 0.0)], "id long, px float, py float")
    assert sorted((r.id, r.shape_id) for r in sh.join_shapes(points, "px", "py", table(spark, rows)).collect()) == [(1, 7)] * 4
    assert sh.join_shapes(points, "px", "py", table(spark, rows).limit(0)).count() == 0
    assert sh.join_shapes(points.limit(0), "px", "py", table(spark, rows)).count() == 0


def test_polygon_with_many_corners_has_short_tests(spark):
    n = 1000
    turns = [2 * math.pi * k / n for k in range(n)]
    rows = [(1, "polygon", None, None, None, None, [math.cos(t) for t in turns], [math.sin(t) for t in turns])]
    cells = list(sh._cells({"kind": "polygon", "edges": [dict(zip(("ax", "ay", "bx", "by"), e)) for e in zip(rows[0][6], rows[0][7], rows[0][6][1:] + rows[0][6][:1], rows[0][7][1:] + rows[0][7][:1])]}, 5))
    border = [len(e) for _, _, _, inside, e in cells if not inside]
    assert border and max(border) <= n / 8 and all(len(e) == 0 for _, _, _, inside, e in cells if inside)
    points = spark.range(2000).select("id", (F.col("id") % 50 / 20 - 1.2).cast("float").alias("px"), (F.floor(F.col("id") / 50) / 16 - 1.2).cast("float").alias("py"))
    got = {r.id for r in sh.join_shapes(points, "px", "py", table(spark, rows), deep=5).collect()}
    assert got == {r.id for r in points.collect() if holds(rows[0], r.px, r.py)}


def test_a_huge_shape_spreads_and_no_pairs_are_formed(spark):
    """The cover of a shape around all points has many cells, and the join is by equality."""
    rows = [(1, "circle", 0.0, 0.0, 100.0, None, None, None)]
    cells = {(at, x, y) for at, x, y, _, _ in sh._cells({"kind": "circle", "x": 0.0, "y": 0.0, "radius": 100.0, "edges": None}, 2)}
    assert len(cells) > 30
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id long, px float, py float")
    plan = sh.join_shapes(points, "px", "py", table(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_same_answers_as_single_predicates(spark, t):
    at = sp.coordinate(F.get("embedding", 0), F.get("embedding", 1))
    points = t.embeddings.select("vec_id", at.alias("at")).select("vec_id", "at", F.get("at", 0).alias("px"), F.get("at", 1).alias("py"))
    xs, ys = [-0.2, 0.0, 0.2, 0.1, 0.0], [0.0, 0.2, 0.0, -0.2, -0.05]
    rows = [(1, "polygon", None, None, None, None, xs, ys), (2, "circle", 0.02, 0.03, 0.12, None, None, None), (3, "box", -0.05, 0.15, -0.1, 0.1, None, None)]
    got = sh.join_shapes(points, "px", "py", table(spark, rows)).collect()
    for number, test in ((1, sp.in_polygon(F.col("at"), xs, ys)), (2, sp.in_radius(F.col("at"), [0.02, 0.03], 0.12)), (3, sp.in_rectangle(F.col("at"), [-0.05, -0.1], [0.15, 0.1]))):
        assert {r.vec_id for r in got if r.shape_id == number} == {r.vec_id for r in points.where(test).collect()}
