"""Interval operators on tables with a start and an end column; intervals are ``[start, end)``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspan.session import materialise


def micros_of(t: datetime | str | int) -> int:
    """An instant given as text, datetime (both in UTC unless they carry a zone) or microseconds."""
    if isinstance(t, int):
        return t
    if isinstance(t, str):
        t = datetime.fromisoformat(t.replace("Z", "+00:00"))
    t = t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t
    return (t - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def instant(t: datetime | str | int) -> Column:
    """A literal instant, whatever zone the driver runs in."""
    return F.timestamp_micros(F.lit(micros_of(t)).cast("long"))


def condense_literals(intervals: Sequence[tuple]) -> list[tuple[int, int]]:
    """Query arguments in microseconds, merged where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((micros_of(a), micros_of(b)) for a, b in intervals):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def within(ts: Column, start, end) -> Column:
    """``start <= ts < end`` on the bare column, so that it is pushed into the scan."""
    return (ts >= instant(start)) & (ts < instant(end))


def within_any(ts: Column, intervals: Sequence[tuple]) -> Column:
    return reduce(lambda a, b: a | b, [within(ts, lo, hi) for lo, hi in condense_literals(intervals)], F.lit(False))


def _celled(marks: DataFrame, group: list[str], cell: str) -> tuple[DataFrame, list[str]]:
    """``marks`` (group, ``_at``, ``_end``, …) with ``_carried``, the latest end of the group's earlier time cells; and the
    columns that part them into cells.

    Rows are shuffled once, by hash, for the join and the windows after it. The carried ends come from one row per
    (group, cell), aggregated before their shuffle: as many as the times have cells, however many rows a group has. With
    them a window needs to see one cell only, so a group spreads over its cells. Rows without a time are left out.
    """
    rows = marks.withColumns({"_cell": F.date_trunc(cell, "_at"), "_g": F.xxhash64(*group) if group else F.lit(0)})
    parts = ["_g", *group, "_cell"]
    before = Window.partitionBy("_g", *group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*parts).agg(F.max("_end").alias("_most")).withColumn("_carried", F.max("_most").over(before))
    carried = carried.select("_carried", *[F.col(x).alias(f"_r{x}") for x in parts])
    on = (F.col("_g") == F.col("_r_g")) & (F.col("_cell") == F.col("_r_cell"))
    for x in group:  # the hash finds the group; this tells groups of one hash apart, and is no key that asks for another shuffle
        on &= F.coalesce(F.col(x) == F.col(f"_r{x}"), F.col(x).isNull() & F.col(f"_r{x}").isNull())
    return rows.repartition("_g", "_cell").join(carried, on).drop(*[f"_r{x}" for x in parts]), parts


def condense(df: DataFrame, group: list[str], start: str = "start", end: str = "end", cell: str = "day") -> DataFrame:
    """Merge overlapping or touching intervals per group, for groups of any size.

    Inside a time cell a window over (group, cell) finds the islands, given how far the earlier cells reach. Only the
    first and last island of a cell can belong together with another cell: those, two rows per cell at most, are merged in
    the end. ``cell`` is a unit of ``date_trunc``, coarser for sparse times.
    """
    rows, parts = _celled(df.select(*group, F.col(start).alias("_at"), F.col(end).alias("_end")), group, cell)
    along = Window.partitionBy(*parts).orderBy("_at", "_end")
    before = F.max("_end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("_at") <= F.greatest(F.col("_carried"), F.col("_before")), 0).otherwise(1)
    pieces = (
        rows.withColumn("_before", before)
        .withColumn("_open", opens)
        .withColumn("_island", F.sum("_open").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*parts, "_island")
        .agg(F.min("_at").alias("start"), F.max("_end").alias("end"))
        .withColumn("_last", F.max("_island").over(Window.partitionBy(*parts)))
    )
    edge = (F.col("_island") == 0) | (F.col("_island") == F.col("_last"))
    # an island numbered 0 was not opened in its cell: it goes on from the last one opened before
    opened = F.sum((F.col("_island") > 0).cast("int")).over(
        Window.partitionBy("_g", *group).orderBy("_cell", "_island").rowsBetween(Window.unboundedPreceding, 0)
    )
    edges = pieces.where(edge).withColumn("_no", opened).groupBy("_g", *group, "_no").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return pieces.where(~edge).select(*group, "start", "end").unionByName(edges.select(*group, "start", "end"))


def umbrella(df: DataFrame, group: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Smallest interval that covers all."""
    return df.groupBy(*group).agg(F.min(start).alias("start"), F.max(end).alias("end"))


def clip(df: DataFrame, lo, hi, start: str = "start", end: str = "end") -> DataFrame:
    """Intersection with ``[lo, hi)``; rows that do not meet it are left out."""
    lo, hi = instant(lo), instant(hi)
    return (
        df.where((F.col(start) < hi) & (F.col(end) > lo))
        .withColumns({start: F.greatest(F.col(start), lo), end: F.least(F.col(end), hi)})
        .where(F.col(start) < F.col(end))
    )


def _meets(rows: DataFrame, at: str, inclusive: bool, intervals: DataFrame, key: list[str], cell: str) -> DataFrame:
    """Rows with ``_reach``: the latest end among intervals of the same key that start before ``at``.

    Both sides meet in time order inside (key, cell), with a running maximum that begins with what the earlier cells
    reach. No pairs are formed, and a hot key spreads over its cells. ``inclusive`` counts an interval that starts exactly
    at ``at``.
    """
    side = 0 if inclusive else 1
    looks = rows.withColumns({"_at": F.col(at), "_side": F.lit(1 - side)})
    marks = intervals.select(*key, F.col("start").alias("_at"), F.col("end").alias("_end"), F.lit(side).alias("_side"))
    both, parts = _celled(looks.unionByName(marks, allowMissingColumns=True), key, cell)
    along = Window.partitionBy(*parts).orderBy("_at", "_side").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached = both.withColumn("_reach", F.greatest(F.col("_carried"), F.max("_end").over(along)))
    return reached.where(F.col("_side") == 1 - side).drop("_at", "_side", "_end", "_cell", "_carried", "_g")


def overlapping(
    left: DataFrame, right: DataFrame, key: list[str], start: str = "start", end: str = "end", cell: str = "day"
) -> DataFrame:
    """Rows of ``left`` whose interval overlaps any interval of ``right`` with the same key.

    That is so when, of the right intervals that start before the left one ends, the latest end is
    after the left start.
    """
    r = right.select(*key, F.col(start).alias("start"), F.col(end).alias("end")).where(F.col("start") < F.col("end"))
    rows = left.where(F.col(start) < F.col(end))
    return _meets(rows, end, False, r, key, cell).where(F.col("_reach") > F.col(start)).drop("_reach")


def in_interval_table(df: DataFrame, ts: str, intervals: DataFrame, cell: str = "day") -> DataFrame:
    """Rows whose time is in any interval of a table, each row once.

    Runs small jobs over the intervals when called: they are condensed, so they no longer overlap, and their
    first start and last end become a filter that reaches the scan. Then rows and intervals meet by equality on
    the time cells (``hour``, ``day``, ``month`` …) that an interval touches. The rows are neither sorted nor written.
    """
    table = materialise(condense(intervals, []), "intervals")
    span = table.agg(F.unix_micros(F.min("start")), F.unix_micros(F.max("end"))).first()
    if span[0] is None:
        return df.where(F.lit(False))
    return _in_cells(df.where(within(F.col(ts), span[0], span[1])), ts, table, cell)


def _in_cells(df: DataFrame, ts: str, table: DataFrame, cell: str) -> DataFrame:
    """Semi-join with disjoint intervals on the cell of the time and the exact bounds."""
    first, last = F.date_trunc(cell, "start"), F.date_trunc(cell, F.col("end") - F.expr("interval 1 microsecond"))
    cells = table.where(F.col("start") < F.col("end")).select(
        F.explode(F.sequence(first, last, F.expr(f"interval 1 {cell}"))).alias("_cell"), F.col("start").alias("_start"), F.col("end").alias("_end")
    )
    at = F.col(ts)
    return df.join(cells, (F.date_trunc(cell, at) == F.col("_cell")) & (at >= F.col("_start")) & (at < F.col("_end")), "left_semi")


def in_intervals(df: DataFrame, ts: str, intervals: Sequence[tuple], cell: str = "day") -> DataFrame:
    """Rows in any of the given intervals.

    Merged first; their outer bounds are a filter that reaches the scan. What is left of a single interval is
    that filter; the gaps between several are cut out by the join of ``in_interval_table``, however many there are.
    """
    spans = [(a, z) for a, z in condense_literals(intervals) if a < z]
    if not spans:
        return df.where(F.lit(False))
    rows = df.where(within(F.col(ts), spans[0][0], spans[-1][1]))
    if len(spans) == 1:
        return rows
    table = df.sparkSession.createDataFrame(spans, "a long, z long")
    return _in_cells(rows, ts, table.select(F.timestamp_micros("a").alias("start"), F.timestamp_micros("z").alias("end")), cell)
