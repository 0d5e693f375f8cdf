"""Positions and running values over ordered groups of any size.

A window partitioned by one key puts that whole key into one task. Here the rows are range
partitioned by (group, order) instead, so a group that holds a third of the data spreads over many
tasks; each task works on its own slice and the slices are joined by small per-slice totals.
The order must be total: add a tiebreak, otherwise equal rows cannot be split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspan.session import materialise

SLICE = "_slice"
SPOT = "_spot"


@dataclass(frozen=True)
class Desc:
    """A sort key in descending order; plain keys are ascending with nulls first."""

    key: str | Column


def sort_columns(order: list) -> list[Column]:
    """Keys (names, columns, or ``Desc`` of either) as sort columns."""
    return [_column(o.key).desc() if isinstance(o, Desc) else _column(o).asc() for o in order]


def _column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def place(df: DataFrame, group: list[str], order: list) -> DataFrame:
    """Range-partition by (group, order) and fix each row's slice and spot in it.

    Written once, when called, because slice numbers must not change between the two uses of the result.
    Computed sort keys become columns first: a sort would evaluate an expression at each comparison.
    """
    columns = df.columns
    named = []
    for i, o in enumerate(order):
        key = o.key if isinstance(o, Desc) else o
        if not isinstance(key, str):
            df = df.withColumn(f"_key{i}", key)
            key = f"_key{i}"
        named.append(Desc(key) if isinstance(o, Desc) else key)
    keys = sort_columns([*group, *named])
    spot = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialise(placed.select(*columns, F.spark_partition_id().alias(SLICE), spot.alias(SPOT)), "placed")


def slice_totals(placed: DataFrame, group: list[str], **aggs: Column) -> DataFrame:
    """One row per (group, slice): bounded by slices + groups, not by rows."""
    return placed.groupBy(*group, SLICE).agg(*[a.alias(n) for n, a in aggs.items()])


def slices_before(group: list[str]):
    return Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def with_position(df: DataFrame, group: list[str], order: list, name: str = "position") -> DataFrame:
    """0-based position of every row inside its group. Writes the rows when called (see ``place``)."""
    placed = place(df, group, order)
    starts = slice_totals(placed, group, _n=F.count(F.lit(1)), _first=F.min(SPOT)).select(
        *group, SLICE, "_first", F.coalesce(F.sum("_n").over(slices_before(group)), F.lit(0)).alias("_skip")
    )
    return join_slices(placed, starts, group).withColumn(
        name, F.col("_skip") + F.col(SPOT) - F.col("_first")
    ).drop(SLICE, SPOT, "_first", "_skip")


def join_slices(placed: DataFrame, totals: DataFrame, group: list[str]) -> DataFrame:
    keys = [*group, SLICE]
    right = totals.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in totals.columns if c not in keys])
    on = None
    for k in keys:
        same = placed[k].eqNullSafe(right[f"_r_{k}"])
        on = same if on is None else on & same
    return placed.join(right, on).drop(*[f"_r_{k}" for k in keys])


def with_running(
    df: DataFrame,
    group: list[str],
    order: list,
    name: str,
    value: Column,
    how: str = "sum",
    inclusive: bool = True,
) -> DataFrame:
    """Running ``sum`` or ``max`` of ``value`` inside each group, up to (or before) the row. Writes the rows when called."""
    fold = {"sum": F.sum, "max": F.max}[how]
    join2 = {
        "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
        "max": lambda a, b: F.greatest(a, b),
    }[how]
    placed = place(df.withColumn("_v", value), group, order)
    carried = slice_totals(placed, group, _t=fold("_v")).select(
        *group, SLICE, fold("_t").over(slices_before(group)).alias("_carried")
    )
    inside = Window.partitionBy(*group, SLICE).orderBy(SPOT).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    return (
        join_slices(placed, carried, group)
        .withColumn("_inside", fold("_v").over(inside))
        .withColumn(name, join2(F.col("_carried"), F.col("_inside")))
        .drop(SLICE, SPOT, "_v", "_carried", "_inside")
    )
