"""Pages of every (segment, time bucket), with cursors that are tables.

A cursor has a row per segment and bucket: the last offset shown there. A row whose bucket is null (or missing as a
column) holds for all buckets of its segment that have no row of their own. Offsets count from 0 in time order, or from
-1 backwards for descending pages.

Reading on for many pages pays for counting once: ``PageIndex`` holds the number of rows per (segment, bucket, time
cell), from which each page takes the cells that hold it. Their outer bounds are literals that reach the scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspan.functions.granularity import Granularity
from tallyspan.operators.ordered import Desc, sort_columns
from tallyspan.operators.intervals import within
from tallyspan.session import materialise

BUCKET = "bucket"
OFFSET = "paging_offset"
WRONG_SIGN = "the sign of a paging offset does not fit the direction of the pages"


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)], F.lit(True))


def _whole(cursor: DataFrame) -> DataFrame:
    """The cursor with a bucket column."""
    return cursor if BUCKET in cursor.columns else cursor.withColumn(BUCKET, F.lit(None).cast("timestamp"))


@dataclass
class PageIndex:
    """Rows per (segment, bucket, cell) of one direction, with the number of rows before the cell in its bucket."""

    rows: DataFrame
    segment: list[str]
    ts: str
    tiebreak: str
    gran: Granularity
    descending: bool
    cell: str
    cells: DataFrame

    @classmethod
    def of(
        cls, df: DataFrame, segment: list[str], ts: str, tiebreak: str, gran: Granularity, descending: bool = False, cell: str = "hour"
    ) -> PageIndex:
        """Counts the rows: runs one job over (segment, ts) when called. Rows without a time are on no page."""
        keys = [*segment, BUCKET, "_cell"]
        placed = df.where(F.col(ts).isNotNull()).select(*segment, F.col(ts).alias("_ts"))
        # a cell never reaches over the border of a bucket: the border cuts it
        start = gran.start(F.col("_ts"))
        counts = placed.select(*segment, start.alias(BUCKET), F.date_trunc(cell, "_ts").alias("_cell"), "_ts").groupBy(*keys)
        counts = counts.agg(F.count("*").alias("_n"), F.min("_ts").alias("_first"), F.max("_ts").alias("_last"))
        along = Window.partitionBy(*segment, BUCKET).orderBy(*sort_columns([Desc("_cell") if descending else "_cell"]))
        cells = counts.withColumn("_skip", F.sum("_n").over(along) - F.col("_n"))
        return cls(df, segment, ts, tiebreak, gran, descending, cell, materialise(cells, "page-index"))

    def starts(self, cursor: DataFrame | None, from_next: bool) -> DataFrame:
        """The cells with ``_from``, the number of rows of the bucket before its page."""
        cells = self.cells
        if cursor is None:
            return cells.withColumn("_from", F.lit(0).cast("long"))
        at = F.col(OFFSET).cast("long")
        at = F.when((at < 0) == F.lit(self.descending), at).when(at.isNotNull(), F.raise_error(F.lit(WRONG_SIGN)).cast("long"))
        step = (-at - 1 if self.descending else at) + int(from_next)
        named = [f"_s_{x}" for x in self.segment]
        steps = _whole(cursor).select(*[F.col(x).alias(n) for x, n in zip(self.segment, named)], F.col(BUCKET).alias("_s_bucket"), step.alias("_step"))
        # one row per key: of repeated ones the furthest counts
        own = steps.groupBy(*named, "_s_bucket").agg(F.max("_step").alias("_step"))
        segments = _same(self.segment, named)
        exact = own.where("_s_bucket is not null").withColumnRenamed("_step", "_exact")
        whole = own.where("_s_bucket is null").drop("_s_bucket").withColumnRenamed("_step", "_whole")
        cells = cells.join(exact, segments & (F.col(BUCKET) == F.col("_s_bucket")), "left").drop(*exact.columns[:-1])
        cells = cells.join(whole, segments, "left").drop(*whole.columns[:-1])
        return cells.withColumn("_from", F.coalesce("_exact", "_whole", F.lit(0).cast("long"))).drop("_exact", "_whole")

    def page(self, cursor: DataFrame | None, threshold: int, from_next: bool = True) -> DataFrame:
        """At most ``threshold`` rows of every bucket of every segment, with ``bucket`` and ``paging_offset``.

        Starts at the cursor's offset, or one further on with ``from_next``; buckets that the cursor does not name
        start at their first row. Runs a small job over the index when called: the times of the first and last wanted
        cell become bounds of the scan. Nothing is left to read when it returns no rows.
        """
        at = self.starts(cursor, from_next)
        held = (F.col("_skip") < F.col("_from") + threshold) & (F.col("_skip") + F.col("_n") > F.col("_from"))
        wanted = at.where(held)
        span = wanted.agg(F.unix_micros(F.min("_first")), F.unix_micros(F.max("_last"))).first()
        rows = self.rows.where(within(F.col(self.ts), span[0], span[1] + 1)) if span[0] is not None else self.rows.where(F.lit(False))
        rows = rows.withColumns({BUCKET: self.gran.start(F.col(self.ts)), "_cell": F.date_trunc(self.cell, F.col(self.ts))})
        keys = [*self.segment, BUCKET, "_cell"]
        wanted = wanted.select(*[F.col(k).alias(f"_w_{k}") for k in keys], "_skip", "_from")
        order = [Desc(self.ts), Desc(self.tiebreak)] if self.descending else [self.ts, self.tiebreak]
        inside = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        rank = F.col("_skip") + F.row_number().over(inside) - 1
        placed = rows.join(wanted, _same(keys, [f"_w_{k}" for k in keys])).withColumn("_rank", rank)
        kept = placed.where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_from") + threshold))
        shown = F.lit(-1) - F.col("_rank") if self.descending else F.col("_rank")
        return kept.select(*self.rows.columns, BUCKET, shown.cast("long").alias(OFFSET))


def cursor_of(pages: DataFrame, segment: list[str], descending: bool = False) -> DataFrame:
    """(segment, bucket, paging_offset): the last row shown of each, to be stored for the next request."""
    fold = F.min if descending else F.max
    return pages.groupBy(*segment, BUCKET).agg(fold(OFFSET).alias(OFFSET))


def next_cursor(cursor: DataFrame, descending: bool = False) -> DataFrame:
    """The same cursor one row further on, for requests without ``from_next``."""
    return cursor.withColumn(OFFSET, F.col(OFFSET) + (-1 if descending else 1))


def merge_cursors(cursors: Iterable[DataFrame], segment: list[str], descending: bool = False) -> DataFrame:
    """Cursors of several responses as one: per segment and bucket the furthest offset."""
    return cursor_of(reduce(lambda a, b: a.unionByName(b), map(_whole, cursors)), segment, descending)


def merge_pages(pages: DataFrame, ts: str, segment: list[str], threshold: int, descending: bool = False) -> DataFrame:
    """Of each bucket the first ``threshold`` rows of all segments together, in time order (ties by segment and offset)."""
    order = [Desc(k) if descending else k for k in (ts, *segment, OFFSET)]
    ranked = pages.withColumn("_rank", F.row_number().over(Window.partitionBy(BUCKET).orderBy(*sort_columns(order))))
    return ranked.where(F.col("_rank") <= threshold).drop("_rank")


def read_on(index: PageIndex, threshold: int, cursor: DataFrame | None = None, most_pages: int | None = None):
    """Pages one after the other, each resumed from the stored cursor of those before, until a page is empty (or ``most_pages``).

    Yields (page, cursor after it); both are written tables, so a later process can go on from the cursor.
    """
    number = 0
    while most_pages is None or number < most_pages:
        page = materialise(index.page(cursor, threshold), "page")
        if page.isEmpty():
            return
        seen = cursor_of(page, index.segment, index.descending)
        held = [seen] if cursor is None else [cursor, seen]
        cursor = materialise(merge_cursors(held, index.segment, index.descending), "cursor")
        yield page, cursor
        number += 1
