"""Spatial queries over the first two components of the embeddings."""

import math

from pyspark.sql import functions as F

from tallyspan.functions import spatial as sp
from tallyspan.operators import shapes
from tallyspan.operators.spatial import join_boxes
from tallyspan.plans.registry import query

c = F.col
POINTS = "p AS (SELECT vec_id, label, embedding[1] AS x, embedding[2] AS y FROM embeddings)"


def _points(t):
    e = c("embedding")
    return t.embeddings.select("vec_id", "label", sp.coordinate(F.get(e, 0), F.get(e, 1)).alias("at"))


@query(
    "spatial_build",
    f"""
    WITH {POINTS} SELECT vec_id, CASE WHEN vec_id % 7 <> 0 THEN x::DOUBLE END AS x, CASE WHEN vec_id % 7 <> 0 THEN y::DOUBLE END AS y,
      CASE WHEN vec_id % 7 <> 0 THEN 3 END::INTEGER AS parts FROM p
    """,
)
def spatial_build(t):
    e = c("embedding")
    third = F.when(c("vec_id") % 7 == 0, "n/a").otherwise(c("label").cast("string"))
    at = sp.coordinate(F.get(e, 0), F.get(e, 1), third)
    return t.embeddings.select(
        "vec_id", F.get(at, 0).cast("double").alias("x"), F.get(at, 1).cast("double").alias("y"), F.when(at.isNotNull(), F.size(at)).alias("parts")
    )


@query(
    "spatial_decode",
    f"WITH {POINTS} SELECT vec_id, CASE WHEN vec_id % 7 <> 0 THEN x::DOUBLE END AS x, CASE WHEN vec_id % 7 <> 0 THEN y::DOUBLE END AS y FROM p",
)
def spatial_decode(t):
    e = c("embedding")
    y = F.when(c("vec_id") % 7 == 0, "north").otherwise(F.get(e, 1).cast("string"))
    at = sp.decode(F.concat_ws(",", F.get(e, 0).cast("string"), y))
    return t.embeddings.select("vec_id", F.get(at, 0).cast("double").alias("x"), F.get(at, 1).cast("double").alias("y"))


@query(
    "spatial_rectangle",
    f"WITH {POINTS} SELECT vec_id FROM p WHERE x >= (-0.05)::FLOAT AND x <= 0.15::FLOAT AND y >= (-0.1)::FLOAT AND y <= 0.1::FLOAT",
)
def spatial_rectangle(t):
    return _points(t).where(sp.in_rectangle(c("at"), [-0.05, -0.1], [0.15, 0.1])).select("vec_id")


@query(
    "spatial_radius",
    f"WITH {POINTS} SELECT vec_id FROM p WHERE power((x - 0.02::FLOAT)::DOUBLE, 2) + power((y - 0.03::FLOAT)::DOUBLE, 2) <= power(0.12::FLOAT::DOUBLE, 2)",
)
def spatial_radius(t):
    return _points(t).where(sp.in_radius(c("at"), [0.02, 0.03], 0.12)).select("vec_id")


LEVEL_SQL = "(CASE vec_id % 5 WHEN 0 THEN 0.0 WHEN 1 THEN 0.2 WHEN 2 THEN 0.0 WHEN 3 THEN -0.2 ELSE -0.05 END)"
XS, YS = [-0.2, 0.0, 0.2, 0.1, 0.0], [0.0, 0.2, 0.0, -0.2, -0.05]


@query(
    "spatial_polygon",
    f"""
    WITH {POINTS}, k AS (SELECT unnest({XS}::FLOAT[])::DOUBLE AS ax, unnest({YS}::FLOAT[])::DOUBLE AS ay,
      unnest({XS[1:] + XS[:1]}::FLOAT[])::DOUBLE AS bx, unnest({YS[1:] + YS[:1]}::FLOAT[])::DOUBLE AS "by"),
    q AS (SELECT vec_id, x::DOUBLE AS x, y::DOUBLE AS y, 'as they are' AS points FROM p
      UNION ALL SELECT vec_id, x::DOUBLE, {LEVEL_SQL}::FLOAT::DOUBLE, 'level with corners' FROM p),
    t AS (SELECT *, (bx - ax) * (y - ay) - ("by" - ay) * (x - ax) AS turn FROM q, k)
    SELECT vec_id, points FROM t GROUP BY ALL
    HAVING bool_or(turn = 0 AND x BETWEEN least(ax, bx) AND greatest(ax, bx) AND y BETWEEN least(ay, "by") AND greatest(ay, "by"))
      OR count(*) FILTER (WHERE (ay <= y) <> ("by" <= y) AND ((turn > 0) = ("by" > ay)) AND turn <> 0) % 2 = 1
    """,
)
def spatial_polygon(t):
    points = _points(t).withColumn("points", F.lit("as they are"))
    # every point once more at the height of one of the corners
    heights = F.array(*[F.lit(v).cast("float") for v in YS])
    at = F.array(F.get("at", 0), F.get(heights, (c("vec_id") % len(YS)).cast("int")))
    level = _points(t).withColumns({"at": at, "points": F.lit("level with corners")})
    return points.unionByName(level).where(sp.in_polygon(c("at"), XS, YS)).select("vec_id", "points")


@query(
    "spatial_join",
    f"""
    WITH {POINTS}, b AS (SELECT min(vec_id)::BIGINT AS box_id, min(x) AS min_x, (max(x) + (1 + min(vec_id) % 5) * 0.01)::FLOAT AS max_x, min(y) AS min_y, (max(y) + 0.02)::FLOAT AS max_y
      FROM p GROUP BY floor(x * 10), floor(y * 10))
    SELECT vec_id, box_id FROM p JOIN b ON x >= min_x AND x <= max_x AND y >= min_y AND y <= max_y
    """,
)
def spatial_join(t):
    points = _points(t).select("vec_id", F.get("at", 0).alias("x"), F.get("at", 1).alias("y"))
    # one box per grid cell, a little larger than its points: as many as the area has cells, however many points
    cells = points.groupBy(F.floor(c("x") * 10), F.floor(c("y") * 10)).agg(
        F.min("vec_id").alias("box_id"), F.min("x").alias("min_x"), F.max("x").alias("x"), F.min("y").alias("min_y"), F.max("y").alias("y")
    )
    boxes = cells.select(
        "box_id",
        "min_x",
        (c("x").cast("double") + (1 + c("box_id") % 5) * 0.01).cast("float").alias("max_x"),
        "min_y",
        (c("y").cast("double") + 0.02).cast("float").alias("max_y"),
    )
    return join_boxes(points, "x", "y", boxes).select("vec_id", "box_id")


# a circle, a box or a star of ten corners around the first point of every grid cell, and one polygon around all points
SHAPE_CORNERS = 10
SHAPES_SQL = f"""
    {POINTS}, g AS (SELECT min(vec_id)::BIGINT AS shape_id, min(x)::DOUBLE AS x, min(y)::DOUBLE AS y, (0.02 + (min(vec_id) % 7) * 0.01)::FLOAT::DOUBLE AS r
      FROM p GROUP BY floor(x * 20), floor(y * 20)),
    corner AS (SELECT shape_id, k, (x + (CASE WHEN k % 2 = 0 THEN r ELSE r / 4 END) * ({{cos}})[k + 1])::FLOAT::DOUBLE AS cx,
        (y + (CASE WHEN k % 2 = 0 THEN r ELSE r / 4 END) * ({{sin}})[k + 1])::FLOAT::DOUBLE AS cy
      FROM g, (SELECT unnest(range({SHAPE_CORNERS})) AS k) WHERE shape_id % 3 = 2
      UNION ALL SELECT -1, k, [-9.0, 9.0, 9.0, -9.0][k + 1], [-8.0, -9.0, 8.0, 7.0][k + 1] FROM (SELECT unnest(range(4)) AS k)),
    edge AS (SELECT a.shape_id, a.cx AS ax, a.cy AS ay, b.cx AS bx, b.cy AS "by" FROM corner a JOIN corner b
      ON a.shape_id = b.shape_id AND b.k = (a.k + 1) % (CASE WHEN a.shape_id < 0 THEN 4 ELSE {SHAPE_CORNERS} END)),
    t AS (SELECT vec_id, shape_id, p.x::DOUBLE AS x, p.y::DOUBLE AS y, ax, ay, bx, "by", (bx - ax) * (p.y::DOUBLE - ay) - ("by" - ay) * (p.x::DOUBLE - ax) AS turn FROM p, edge)
    SELECT vec_id, shape_id FROM t GROUP BY vec_id, shape_id
    HAVING bool_or(turn = 0 AND x BETWEEN least(ax, bx) AND greatest(ax, bx) AND y BETWEEN least(ay, "by") AND greatest(ay, "by"))
      OR count(*) FILTER (WHERE (ay <= y) <> ("by" <= y) AND ((turn > 0) = ("by" > ay)) AND turn <> 0) % 2 = 1
    UNION ALL
    SELECT vec_id, shape_id FROM p JOIN g ON shape_id % 3 = 0 AND power((p.x - g.x::FLOAT)::DOUBLE, 2) + power((p.y - g.y::FLOAT)::DOUBLE, 2) <= power(r, 2)
    UNION ALL
    SELECT vec_id, shape_id FROM p JOIN g ON shape_id % 3 = 1 AND p.x >= (g.x - r)::FLOAT AND p.x <= (g.x + r)::FLOAT AND p.y >= (g.y - r / 2)::FLOAT AND p.y <= (g.y + r / 2)::FLOAT
"""
_TURNS = [2 * math.pi * k / SHAPE_CORNERS for k in range(SHAPE_CORNERS)]
COS, SIN = [round(math.cos(a), 6) for a in _TURNS], [round(math.sin(a), 6) for a in _TURNS]


@query("spatial_join_shapes", "WITH " + SHAPES_SQL.format(cos=[float(v) for v in COS], sin=[float(v) for v in SIN]))
def spatial_join_shapes(t):
    points = _points(t).select("vec_id", F.get("at", 0).alias("x"), F.get("at", 1).alias("y"))
    around = points.groupBy(F.floor(c("x") * 20), F.floor(c("y") * 20)).agg(F.min("vec_id").alias("shape_id"), F.min("x").alias("x"), F.min("y").alias("y"))
    around = around.select(
        "shape_id", c("x").cast("double").alias("x"), c("y").cast("double").alias("y"), (0.02 + (c("shape_id") % 7) * 0.01).cast("float").cast("double").alias("r")
    )
    arm = lambda k: c("r") if k % 2 == 0 else c("r") / 4
    star = shapes.polygon(F.array(*[c("x") + arm(k) * v for k, v in enumerate(COS)]), F.array(*[c("y") + arm(k) * v for k, v in enumerate(SIN)]))
    square = shapes.box(c("x") - c("r"), c("x") + c("r"), c("y") - c("r") / 2, c("y") + c("r") / 2)
    kind = c("shape_id") % 3
    some = around.select("shape_id", F.when(kind == 0, shapes.circle(c("x"), c("y"), c("r"))).when(kind == 1, square).otherwise(star).alias("shape"))
    corners = [F.array(*[F.lit(v) for v in side]) for side in ([-9.0, 9.0, 9.0, -9.0], [-8.0, -9.0, 8.0, 7.0])]
    whole = t.spark.range(1).select(F.lit(-1).cast("long").alias("shape_id"), shapes.polygon(*corners).alias("shape"))
    return shapes.join_shapes(points, "x", "y", some.unionByName(whole)).select("vec_id", "shape_id")
