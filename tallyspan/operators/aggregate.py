"""Aggregators as (partial, combine, finish) column factories.

``partial`` works on raw rows, ``combine`` merges already aggregated rows of the same name, and
``finish`` turns a state into the value shown. Batch, re-rollup and stream share them. Spark's own
aggregation runs the partial step before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# What an empty or null-only minimum or maximum starts from.
LONG_MAX = 9223372036854775807
LONG_MIN = -9223372036854775808

# Fixed value: log2 of the registers of a distinct sketch.
SKETCH_LOG2 = 11

# Fixed value: stands for null among the values of a cardinality count.
NULL_MARK = "\u0000"


@dataclass(frozen=True)
class Aggregator:
    name: str
    partial: Column
    combine: Callable[[Column], Column]
    finish: Callable[[Column], Column] = lambda c: c
    guard: Callable[[Column], Column] | None = None  # rebuilds ``partial`` over matching rows only

    def final(self) -> Column:
        return self.finish(F.col(self.name))


def _make(name: str, build: Callable[[Callable[[Column], Column]], Column], combine, finish=lambda c: c) -> Aggregator:
    """``build`` gets a function that nulls its input on rows that do not match."""
    return Aggregator(
        name,
        build(lambda c: c),
        combine,
        finish,
        guard=lambda p: build(lambda c: F.when(p, c)),
    )


def count(name: str) -> Aggregator:
    return _make(name, lambda on: F.count(on(F.lit(1))), lambda c: F.coalesce(F.sum(c), F.lit(0)))


def _sum(name, value, kind):
    zero = F.lit(0).cast(kind)
    wide = "double" if kind == "float" else kind

    def total(c):
        return F.coalesce(F.sum(c.cast(wide)), zero.cast(wide)).cast(kind)

    return _make(name, lambda on: total(on(F.coalesce(value.cast(kind), zero))), total)


def long_sum(name: str, value: Column) -> Aggregator:
    return _sum(name, value, "long")


def double_sum(name: str, value: Column) -> Aggregator:
    return _sum(name, value, "double")


def float_sum(name: str, value: Column) -> Aggregator:
    return _sum(name, value, "float")


def _extreme(name, value, kind, fold, empty):
    start = F.lit(empty).cast(kind)

    def best(c):
        found = F.coalesce(fold(c), start)
        if kind == "long":
            return found
        # one NaN makes the result NaN; Spark's minimum would take it for the largest value
        return F.when(F.coalesce(F.max(F.isnan(c)), F.lit(False)), F.lit(float("nan")).cast(kind)).otherwise(found)

    return _make(name, lambda on: best(on(F.coalesce(value.cast(kind), start))), best)


def long_min(name: str, value: Column) -> Aggregator:
    return _extreme(name, value, "long", F.min, LONG_MAX)


def long_max(name: str, value: Column) -> Aggregator:
    return _extreme(name, value, "long", F.max, LONG_MIN)


def double_min(name: str, value: Column) -> Aggregator:
    return _extreme(name, value, "double", F.min, float("inf"))


def double_max(name: str, value: Column) -> Aggregator:
    return _extreme(name, value, "double", F.max, float("-inf"))


def float_min(name: str, value: Column) -> Aggregator:
    return _extreme(name, value, "float", F.min, float("inf"))


def float_max(name: str, value: Column) -> Aggregator:
    return _extreme(name, value, "float", F.max, float("-inf"))


def _edge(name, value, ts, tiebreak, kind, pick, state):
    """First or last by (time, tiebreak). As a state it keeps its time, so that it can be merged."""
    # a row without a time is neither first nor last
    at = F.when(F.col(ts).isNotNull(), F.struct(F.col(ts).alias("ts"), F.col(tiebreak).alias("tie")))
    v = F.coalesce(value.cast(kind), F.lit(0).cast(kind))
    if not state:
        zero = F.lit(0).cast(kind)
        return _make(name, lambda on: F.coalesce(pick(v, on(at)), zero), _unmergeable)

    def merge(c):
        return pick(c, F.struct(c["ts"], c["tie"]))

    whole = F.struct(F.col(ts).alias("ts"), F.col(tiebreak).alias("tie"), v.alias("value"))
    return _make(name, lambda on: pick(whole, on(at)), merge, lambda c: F.coalesce(c["value"], F.lit(0).cast(kind)))


def _unmergeable(_: Column) -> Column:
    raise ValueError("a first or last value is merged by its time: build it with state=True")


def _edge_factory(kind, pick):
    def make(name: str, value: Column, ts: str, tiebreak: str, state: bool = False) -> Aggregator:
        return _edge(name, value, ts, tiebreak, kind, pick, state)

    return make


long_first = _edge_factory("long", F.min_by)
double_first = _edge_factory("double", F.min_by)
float_first = _edge_factory("float", F.min_by)
long_last = _edge_factory("long", F.max_by)
double_last = _edge_factory("double", F.max_by)
float_last = _edge_factory("float", F.max_by)


def filtered(inner: Aggregator, predicate: Column) -> Aggregator:
    """``inner`` over the rows where the predicate is true; null is not true."""
    p = F.coalesce(predicate, F.lit(False))
    return replace(inner, partial=inner.guard(p), guard=lambda q: inner.guard(p & q))


def _present(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NULL_MARK))


def _sketched(name, value_of, rounded):
    def finish(c):
        estimate = F.hll_sketch_estimate(c)
        return F.round(estimate).cast("long") if rounded else estimate.cast("double")

    return _make(
        name,
        lambda on: F.hll_sketch_agg(on(value_of), F.lit(SKETCH_LOG2)),
        lambda c: F.hll_union_agg(c),
        finish,
    )


def list_text(c: Column) -> Column:
    """A list dimension as one text for ``cardinality_by_row``: its elements sorted, nulls as a value; no list is null."""
    return F.to_json(F.array_sort(F.transform(c, _present)))


def row_key_text(columns: list[Column]) -> Column:
    """One text per combination of values; null counts as a value. Lists are given as their ``list_text``."""
    return F.to_json(F.struct(*[_present(c).alias(f"c{i}") for i, c in enumerate(columns)]))


def cardinality_by_row(name: str, columns: list[Column], rounded: bool = False) -> Aggregator:
    """Approximate number of distinct combinations."""
    return _sketched(name, row_key_text(columns), rounded)


def cardinality_by_value(name: str, columns: list[Column], rounded: bool = False) -> Aggregator:
    """Approximate number of distinct values pooled over several columns; null counts as a value.

    One sketch per column, united in the same pass, so rows are not multiplied.
    """
    one = _sketched(name, _present(columns[0]), rounded)

    def state(on):
        sketches = [F.hll_sketch_agg(on(_present(c)), F.lit(SKETCH_LOG2)) for c in columns]
        return reduce(lambda a, b: F.hll_union(a, b), sketches)

    return _make(name, state, one.combine, one.finish)


def pooled_cardinality(df: DataFrame, keys: list[str], name: str, scalars: list[str], lists: list[str], rounded: bool = False) -> DataFrame:
    """(keys, name): distinct values pooled over scalar and list dimensions per group; null counts as a value.

    Elements of lists count one by one; an empty or missing list is one null. A sketch takes no lists, so their
    elements become rows of a second branch whose sketch is united with that of the scalars.
    """
    parts = []
    if scalars:
        state = cardinality_by_value("_s", [F.col(x) for x in scalars])
        parts.append(df.groupBy(*keys).agg(state.partial.alias("_s")))
    for x in lists:
        rows = df.select(*keys, F.explode_outer(x).alias("_x"))
        parts.append(rows.groupBy(*keys).agg(F.hll_sketch_agg(_present(F.col("_x")), F.lit(SKETCH_LOG2)).alias("_s")))
    whole = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.hll_union_agg("_s").alias("_s"))
    estimate = F.hll_sketch_estimate("_s")
    return whole.select(*keys, (F.round(estimate).cast("long") if rounded else estimate.cast("double")).alias(name))


def hyper_unique(name: str, value: Column, rounded: bool = False) -> Aggregator:
    """Approximate number of distinct non-null values; the sketch is kept until it is finished."""
    return _sketched(name, value.cast("string"), rounded)


def histogram_bin(value: Column, breaks: list[float]) -> Column:
    """Bin number of a value compared as a 32-bit float; a value equal to a break is in the lower bin."""
    v = value.cast("float")
    bin_no = F.lit(len(breaks))
    for i in reversed(range(len(breaks))):
        bin_no = F.when(v <= F.lit(breaks[i]).cast("float"), F.lit(i)).otherwise(bin_no)
    return bin_no


def histogram(name: str, value: Column, breaks: list[float]) -> Aggregator:
    """Counts per bin as one array of sums: no second grouping and no list of values."""
    cuts = F.array(*[F.lit(float(b)) for b in breaks])
    v = F.coalesce(value, F.lit(0)).cast("float")
    b = histogram_bin(v, breaks)

    def state(on):
        return F.struct(
            F.array(*[F.count(on(F.when(b == i, 1))) for i in range(len(breaks) + 1)]).alias("bins"),
            F.min(on(v)).alias("min"),
            F.max(on(v)).alias("max"),
        )

    def merge(c):
        return F.struct(
            F.array(*[F.sum(c["bins"][i]) for i in range(len(breaks) + 1)]).alias("bins"),
            F.min(c["min"]).alias("min"),
            F.max(c["max"]).alias("max"),
        )

    def finish(c):
        inner = F.slice(c["bins"], 2, len(breaks) - 1)
        return F.struct(
            cuts.alias("breaks"),
            F.transform(inner, lambda n: n.cast("double")).alias("counts"),
            F.array(c["min"].cast("double"), c["max"].cast("double")).alias("quantiles"),
        )

    return _make(name, state, merge, finish)
