"""Post-aggregators: columns over aggregated rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F


def _d(c: Column) -> Column:
    return c.cast("double")


def _quotient(a: Column, b: Column) -> Column:
    """IEEE division: ±infinity or NaN over zero instead of an error."""
    return (
        F.when(b != 0, a / F.when(b != 0, b))
        .when(F.isnan(a) | (a == 0), F.lit(float("nan")))
        .when(a > 0, F.lit(float("inf")))
        .when(a < 0, F.lit(float("-inf")))
    )


STEPS = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    "/": lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / F.when(b != 0, b)),
    "quotient": _quotient,
}


def arithmetic(fn: str, fields: list[Column]) -> Column:
    """Left fold of ``+ - * / quotient`` over at least two fields, as doubles; ``x / 0`` is 0."""
    if fn not in STEPS:
        raise ValueError(f"unknown function {fn}")
    if len(fields) < 2:
        raise ValueError("arithmetic needs at least two fields")
    return reduce(STEPS[fn], [_d(f) for f in fields])


def constant(value: float) -> Column:
    return F.lit(value)


def field_access(name: str) -> Column:
    """The raw state."""
    return F.col(name)


def finalizing_access(aggregator) -> Column:
    """The finished value of an aggregator's state column."""
    return aggregator.final()


def hyper_unique_cardinality(name: str) -> Column:
    return F.hll_sketch_estimate(name).cast("double")


def _fold(fn, kind, empty):
    def make(fields: list[Column]) -> Column:
        return F.coalesce(fn(*[f.cast(kind) for f in fields]) if len(fields) > 1 else fields[0].cast(kind), F.lit(empty).cast(kind))

    return make


double_greatest = _fold(F.greatest, "double", float("-inf"))
double_least = _fold(F.least, "double", float("inf"))
long_greatest = _fold(F.greatest, "long", -9223372036854775808)
long_least = _fold(F.least, "long", 9223372036854775807)


def validate(aggregators: Iterable, post: dict[str, Iterable[str]], others: Iterable[str] = ()) -> None:
    """Names are unique and every name a post-aggregator needs is there before it.

    ``post`` maps each post-aggregator, in order, to the names it reads.
    """
    known = list(others)
    for a in aggregators:
        if a.name in known:
            raise ValueError(f"two columns are named {a.name}")
        known.append(a.name)
    for name, needs in post.items():
        missing = [n for n in needs if n not in known]
        if missing:
            raise ValueError(f"{name} reads columns that are not there: {missing}")
        if name in known:
            raise ValueError(f"two columns are named {name}")
        known.append(name)
