"""Spatial join of points with bounds given as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_boxes(points: DataFrame, x: str, y: str, boxes: DataFrame) -> DataFrame:
    """Every (point, box) with the point inside the box, borders included.

    ``boxes`` has ``min_x, max_x, min_y, max_y``. Each box gets a grid as coarse as its longer side
    (a power of two), of which it covers at most four cells; each point looks up its one cell per
    grid size in use. So small and huge boxes meet points by an equality join, and every pair is
    found once. Reads the exponents of the box sizes (a few dozen at most) when called.
    """
    side = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")).cast("double")
    level = F.when(side > 0, F.ceil(F.log2(F.when(side > 0, side)))).otherwise(-40).cast("int")
    sized = boxes.withColumn("_level", level)
    # a handful of numbers: the exponents of the box sizes
    levels = [r[0] for r in sized.select("_level").distinct().collect()]

    def cell(c, lv):
        return F.floor(c.cast("double") / F.pow(F.lit(2.0), lv.cast("double")))

    lv = F.col("_level")
    cells = sized.withColumn("_cx", F.explode(F.sequence(cell(F.col("min_x"), lv), cell(F.col("max_x"), lv)))).withColumn(
        "_cy", F.explode(F.sequence(cell(F.col("min_y"), lv), cell(F.col("max_y"), lv)))
    )
    at = points.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels])))
    at = at.withColumns({"_cx": cell(F.col(x), lv), "_cy": cell(F.col(y), lv)})
    inside = (F.col(x) >= F.col("min_x")) & (F.col(x) <= F.col("max_x")) & (F.col(y) >= F.col("min_y")) & (F.col(y) <= F.col("max_y"))
    return at.join(cells, ["_level", "_cx", "_cy"]).where(inside).drop("_level", "_cx", "_cy")
