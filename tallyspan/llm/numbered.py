"""Consecutive row numbers for a table, without a sort and without a window over the whole of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyspan.session import materialise


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with a column ``name``: 0, 1, 2 … in no particular order. Writes the rows when called, so numbers stay.

    Rows are numbered inside their task; a running sum over one count per task does the rest.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = materialise(rows.withColumns({"_task": F.spark_partition_id(), "_within": within}), "numbered")
    sizes = placed.groupBy("_task").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return placed.join(first, "_task").withColumn(name, F.col("_first") + F.col("_within")).drop("_task", "_within", "_first")
