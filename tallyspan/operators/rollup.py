"""Rollup of event rows by time bucket and dimensions, in batch and on streams alike."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from tallyspan.functions.granularity import Granularity
from tallyspan.operators.aggregate import Aggregator

BUCKET = "bucket"


def bucketed(df: DataFrame, ts: str, gran: Granularity, min_time: str | None = None) -> DataFrame:
    """Every row with its bucket start; never below the minimum time."""
    start = gran.start(F.col(ts))
    if min_time is not None:
        start = F.greatest(start, F.lit(min_time).cast("timestamp"))
    return df.withColumn(BUCKET, start)


def split_by_min_time(df: DataFrame, ts: str, min_time: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows older than the minimum time are rejected."""
    early = F.col(ts) < F.lit(min_time).cast("timestamp")
    return df.where(~early), df.where(early)


def rollup(
    df: DataFrame,
    ts: str,
    gran: Granularity,
    dims: list[str],
    aggregators: Iterable[Aggregator],
    min_time: str | None = None,
    finish: bool = True,
) -> DataFrame:
    """One row per (bucket, dimension values). With ``finish=False`` the states are kept."""
    aggs = list(aggregators)
    if min_time is not None:
        df, _ = split_by_min_time(df, ts, min_time)
    out = bucketed(df, ts, gran, min_time).groupBy(BUCKET, *dims).agg(*[a.partial.alias(a.name) for a in aggs])
    return finished(out, aggs) if finish else out


def finished(states: DataFrame, aggregators: Iterable[Aggregator]) -> DataFrame:
    return states.withColumns({a.name: a.final() for a in aggregators})


def re_rollup(
    parts: Iterable[DataFrame] | DataFrame,
    dims: list[str],
    aggregators: Iterable[Aggregator],
    gran: Granularity | None = None,
    finish: bool = True,
) -> DataFrame:
    """Merge rolled tables (states) with the combining form of each aggregator."""
    aggs = list(aggregators)
    if not isinstance(parts, DataFrame):
        first, *rest = list(parts)
        for p in rest:
            first = first.unionByName(p)
        parts = first
    if gran is not None:
        parts = parts.withColumn(BUCKET, gran.start(F.col(BUCKET)))
    out = parts.groupBy(BUCKET, *dims).agg(*[a.combine(F.col(a.name)).alias(a.name) for a in aggs])
    return finished(out, aggs) if finish else out


def discover_dims(df: DataFrame, ts: str, metrics: Iterable[str], exclusions: Iterable[str] = ()) -> DataFrame:
    """Schemaless ingest: every other column becomes a text dimension (lists of texts stay lists)."""
    skip = {ts, *metrics, *exclusions}
    return df.select(
        ts,
        *metrics,
        *[
            F.col(f.name).cast("array<string>" if isinstance(f.dataType, T.ArrayType) else "string").alias(f.name)
            for f in df.schema.fields
            if f.name not in skip
        ],
    )
