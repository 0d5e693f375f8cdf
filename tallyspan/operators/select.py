"""The select query: interval, filter, projection, virtual columns, buckets, order, paging, merge."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tallyspan.functions.granularity import Granularity
from tallyspan.operators.intervals import in_intervals
from tallyspan.operators.ordered import Desc, sort_columns

TIME = "__time"
WRONG_SIGN = "the sign of an offset gives the direction"


# filters: two-valued, so that NOT of an unmatched null is true -----------------------------------


def matches(p: Column) -> Column:
    return F.coalesce(p, F.lit(False))


def all_of(*ps: Column) -> Column:
    return reduce(lambda a, b: a & b, ps)


def any_of(*ps: Column) -> Column:
    return reduce(lambda a, b: a | b, ps)


def none_of(p: Column) -> Column:
    """NOT with a null read as false. For a single value ``value_is_not`` says the same and reaches the scan."""
    return ~matches(p)


def always() -> Column:
    return F.lit(True)


def never() -> Column:
    return F.lit(False)


def _is_list(df: DataFrame, dim: str) -> bool:
    return isinstance(df.schema[dim].dataType, T.ArrayType)


def value_is(df: DataFrame, dim: str, value: str | None) -> Column:
    """Dimension equals the value, or any element does. Null (and empty) match an empty row.

    Null-safe equality on the bare column, which Parquet filters by. On a column that is no text the value is
    read as the column's type; one that can't be read so matches nothing.
    """
    c = F.col(dim)
    if _is_list(df, dim):
        if not value:
            return (F.coalesce(F.size(c), F.lit(0)) <= 0) | matches(F.exists(c, lambda x: x.isNull() | (x == "")))
        return matches(F.array_contains(c, value))
    kind = df.schema[dim].dataType
    text = isinstance(kind, T.StringType)
    if not value:
        return c.isNull() | c.eqNullSafe(F.lit("")) if text else c.isNull()
    wanted = F.lit(value) if text else F.lit(value).try_cast(kind)
    return c.eqNullSafe(wanted) if text else c.eqNullSafe(wanted) & wanted.isNotNull()


def value_is_not(df: DataFrame, dim: str, value: str | None) -> Column:
    return ~value_is(df, dim, value)


def value_like(df: DataFrame, dim: str, predicate: Callable[[Column], Column]) -> Column:
    """An arbitrary predicate on the dimension's values; an empty list is tested as null."""
    c = F.col(dim)
    if not _is_list(df, dim):
        return matches(predicate(c))
    none = matches(predicate(F.lit(None).cast("string")))
    return F.when(F.coalesce(F.size(c), F.lit(0)) <= 0, none).otherwise(F.exists(c, lambda x: matches(predicate(x))))


# dimensions --------------------------------------------------------------------------------------


def dimension(dim: str, out: str | None = None, kind: str = "string") -> Column:
    return F.col(dim).cast(kind).alias(out or dim)


def list_filtered(c: Column, values: Iterable[str], keep: bool = True) -> Column:
    """Keep (or drop) the listed values inside a multi-value dimension."""
    wanted = [v for v in values if v is not None]
    return F.filter(c, lambda x: F.coalesce(x, F.lit("")).isin(*wanted) if keep else ~F.coalesce(x, F.lit("")).isin(*wanted))


def regex_filtered(c: Column, pattern: str) -> Column:
    """Keep the elements that match the pattern from end to end; null is read as empty."""
    return F.filter(c, lambda x: F.coalesce(x, F.lit("")).rlike(f"^(?:{pattern})$"))


def normalised(c: Column, policy: str = "SORTED_ARRAY") -> Column:
    """Multi-value policy: sorted with repeats, sorted without, or as given; nulls first."""
    if policy == "ARRAY":
        return c
    if policy == "SORTED_SET":
        c = F.array_distinct(c)
    elif policy != "SORTED_ARRAY":
        raise ValueError(f"unknown multi-value policy {policy}")
    return F.sort_array(c, asc=True)


def scalarised(c: Column) -> Column:
    """One element as itself, several as a bracketed list, none as null — in a text column."""
    some = F.concat(F.lit("["), F.array_join(c, ", ", "null"), F.lit("]"))
    return F.when(F.size(c) == 1, F.element_at(c, 1)).when(F.size(c) > 1, some)


def strings_of(c: Column, is_list: bool) -> Column:
    """Any dimension value as a list of texts; null is the empty list, a null element is "null"."""
    if is_list:
        texts = F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("null")))
    else:
        texts = F.array(c.cast("string"))
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(texts)


def group_key(df: DataFrame, ts: Column, dims: list[str]) -> Column:
    """Time plus the sorted distinct values of each non-empty dimension, in name order."""
    parts = []
    for d in sorted(dims):
        values = F.array_sort(F.array_distinct(strings_of(F.col(d), _is_list(df, d))))
        parts.append(F.when(F.size(values) > 0, values).alias(d))
    return F.struct(ts.alias("ts"), *parts)


# virtual columns -----------------------------------------------------------------------------------


def with_virtual_columns(df: DataFrame, columns: list[tuple[str, Callable[[DataFrame], Column] | Column, list[str]]]) -> DataFrame:
    """Named expression columns ``(name, expression, names it reads)`` that may build on each other.

    Columns of the same depth are added in one projection.
    """
    names = [n for n, _, _ in columns]
    if any(not n for n in names):
        raise ValueError("a virtual column needs a name")
    if TIME in names:
        raise ValueError(f"{TIME} cannot be a virtual column")
    if len(set(names)) != len(names):
        raise ValueError("duplicate virtual column name")
    waiting = {n: (e, {r for r in reads if r in names}) for n, e, reads in columns}
    done: set[str] = set()
    while waiting:
        ready = [n for n, (_, needs) in waiting.items() if needs <= done]
        if not ready:
            raise ValueError(f"virtual columns refer to each other in a cycle: {sorted(waiting)}")
        df = df.withColumns({n: waiting[n][0] for n in ready})
        done |= set(ready)
        for n in ready:
            del waiting[n]
    return df


# the query -------------------------------------------------------------------------------------------


def select_events(
    df: DataFrame,
    ts: str,
    intervals: list[tuple],
    dims: list[str] = (),
    metrics: list[str] = (),
    where: Column | None = None,
    all_dims: list[str] = (),
    all_metrics: list[str] = (),
) -> DataFrame:
    """Time and the chosen dimensions and metrics; an empty list means all of them.

    ``all_dims`` and ``all_metrics`` say which those are. Where neither list nor its ``all_*`` is given, every
    column that is not the time and not on the other side is meant.
    """
    out = in_intervals(df, ts, intervals)
    if where is not None:
        out = out.where(where)
    dims, metrics = list(dims or all_dims), list(metrics or all_metrics)
    others = [x for x in df.columns if x != ts and x not in dims and x not in metrics]
    if not dims:
        dims = [x for x in others if x not in all_metrics]
    elif not metrics:
        metrics = [x for x in others if x not in all_dims]
    return out.select(F.col(ts).alias(TIME), *dims, *metrics)


def bucketed_select(df: DataFrame, ts: str, gran: Granularity, start: str, end: str) -> DataFrame:
    """The rows with their bucket, and one row of nulls for every bucket without rows.

    The empty buckets come from an anti join with the distinct buckets, so the rows themselves are
    not shuffled.
    """
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    rows = df.where((F.col(ts) >= lo) & (F.col(ts) < hi)).withColumn("bucket", gran.start(F.col(ts)))
    series = bucket_table(df.sparkSession, gran, start, end)
    gaps = series.join(rows.select("bucket").distinct(), "bucket", "left_anti")
    blank = gaps.select("bucket", *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return rows.select("bucket", *df.columns).unionByName(blank)


def bucket_table(spark: SparkSession, gran: Granularity, start: str, end: str) -> DataFrame:
    """All buckets that meet ``[start, end)``, one day of them per input row, so that fine buckets
    over a long interval are made in parallel."""
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    days = max(1, math.ceil((datetime.fromisoformat(end) - datetime.fromisoformat(start)) / timedelta(days=1)))
    first = lo + F.make_interval(days=F.col("id").cast("int"))
    after = F.least(first + F.expr("interval 1 day"), hi)
    mine = F.filter(gran.covering(first, after), lambda b: (b >= first) | (F.col("id") == 0))
    return spark.range(days).select(F.explode(mine).alias("bucket"))


# paging ------------------------------------------------------------------------------------------------


def page(
    df: DataFrame,
    segment: list[str],
    ts: str,
    tiebreak: str,
    offsets: DataFrame | dict | None,
    threshold: int,
    descending: bool = False,
    from_next: bool = True,
    cell: str = "hour",
) -> DataFrame:
    """At most ``threshold`` rows per segment, from the offset stored for it.

    Offsets count from 0 in time order; descending pages count from -1 backwards and take the newest
    rows first. ``offsets`` maps a segment to its last offset (a dict for one segment column, or a
    table with ``paging_offset``); ``from_next`` starts one row further on. An offset of the wrong sign
    fails: in a dict at once, in a table when the page is read.

    Rows are counted per segment and time cell; running sums of the counts show which cells hold the page, and
    only the rows of those are ranked. The plan is the same at any depth, and no row is written.
    """
    spark = df.sparkSession
    order = [Desc(ts), Desc(tiebreak)] if descending else [ts, tiebreak]
    rows = df.withColumn("_cell", F.date_trunc(cell, F.col(ts)))
    along = Window.partitionBy(*segment).orderBy(*sort_columns([Desc("_cell") if descending else "_cell"]))
    cells = rows.groupBy(*segment, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    cells = cells.withColumn("_skip", F.sum("_n").over(along) - F.col("_n"))
    start = F.lit(0).cast("long")
    if isinstance(offsets, dict) and offsets:
        if any((v < 0) != descending for v in offsets.values()):
            raise ValueError(WRONG_SIGN)
        offsets = spark.createDataFrame(list(offsets.items()), "_key string, paging_offset long").withColumnRenamed("_key", segment[0])
    if isinstance(offsets, DataFrame):
        at = F.col("paging_offset").cast("long")
        at = F.when((at < 0) == F.lit(descending), at).when(at.isNotNull(), F.raise_error(F.lit(WRONG_SIGN)).cast("long"))
        steps = offsets.select(*[F.col(x).cast("string").alias(f"_s_{x}") for x in segment], ((-at - 1 if descending else at) + int(from_next)).alias("_start"))
        same = reduce(lambda a, b: a & b, [F.col(x).cast("string").eqNullSafe(F.col(f"_s_{x}")) for x in segment])
        cells = cells.join(steps, same, "left").drop(*[f"_s_{x}" for x in segment])
        start = F.coalesce(F.col("_start"), F.lit(0))
    keys = [*segment, "_cell"]
    wanted = cells.withColumn("_from", start).where((F.col("_skip") < F.col("_from") + threshold) & (F.col("_skip") + F.col("_n") > F.col("_from")))
    wanted = wanted.select(*[F.col(k).alias(f"_w_{k}") for k in keys], "_skip", "_from")
    held = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys])
    inside = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    placed = rows.join(wanted, held).withColumn("_rank", F.col("_skip") + F.row_number().over(inside) - 1)
    kept = placed.where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_from") + threshold))
    shown = (F.lit(-1) - F.col("_rank")) if descending else F.col("_rank")
    return kept.select(*df.columns, shown.cast("long").alias("paging_offset"))


def paging_identifiers(pages: DataFrame, segment: list[str], descending: bool = False) -> DataFrame:
    """Last offset per segment, to be stored for the next request."""
    fold = F.min if descending else F.max
    return pages.groupBy(*segment).agg(fold("paging_offset").alias("paging_offset"))


def next_cursor(offsets: dict[str, int], descending: bool = False) -> dict[str, int]:
    return {k: v - 1 if descending else v + 1 for k, v in offsets.items()}


def merge_cursors(cursors: Iterable[dict[str, int]]) -> dict[str, int]:
    """Cursors of several responses as one; the last one wins."""
    out: dict[str, int] = {}
    for cursor in cursors:
        out.update(cursor)
    return out


def merge_pages(pages: DataFrame, ts: str, segment: str, threshold: int, descending: bool = False) -> DataFrame:
    """Pages of all segments ordered by (time, segment, offset), cut at the threshold; ≤ 0 means all."""
    order = [ts, segment, "paging_offset"]
    out = pages.orderBy(*[F.desc(o) if descending else F.asc(o) for o in order])
    return out.limit(threshold) if threshold > 0 else out


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def ordered_merge(parts: Iterable[DataFrame], order: list) -> DataFrame:
    return union_all(parts).orderBy(*order)
