"""The rollup over a stream: the batch operator behind a watermark and the minimum-time rule."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tallyspan.functions.granularity import Granularity
from tallyspan.operators.aggregate import Aggregator
from tallyspan.operators.rollup import BUCKET, bucketed, finished, split_by_min_time
from tallyspan.session import scratch_path
from tallyspan.streaming.sinks import latest, read_batches, run_available


def rollup_stream(
    stream: DataFrame,
    ts: str,
    gran: Granularity,
    dims: list[str],
    aggregators: Iterable[Aggregator],
    min_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Streaming states of the rollup. Late rows are rejected by the minimum time, as in a batch.

    Without a delay every row counts however late it comes, and the state is as large as the result.
    With one, the watermark is on the bucket: an endless stream can be written in append mode, where
    a bucket is emitted once it is complete, and rows for emitted buckets no longer count.
    """
    if min_time is not None:
        stream, _ = split_by_min_time(stream, ts, min_time)
    rows = bucketed(stream, ts, gran, min_time)
    if delay is not None:
        rows = rows.withWatermark(BUCKET, delay)
    aggs = list(aggregators)
    return rows.groupBy(BUCKET, *dims).agg(*[a.partial.alias(a.name) for a in aggs])


def rollup_available(
    stream: DataFrame, ts: str, gran: Granularity, dims: list[str], aggregators: Iterable[Aggregator], min_time: str | None = None,
) -> DataFrame:
    """Run the streaming rollup over what is there and return the finished rows.

    Files come in any order of time, so no watermark is set: the result is that of the batch.
    """
    aggs = list(aggregators)
    spark = stream.sparkSession
    states = rollup_stream(stream, ts, gran, dims, aggs, min_time)
    out = scratch_path(spark, "rollup-stream")
    run_available(states, out, "update")
    written = read_batches(spark, states.schema, out)
    return finished(latest(written, [BUCKET, *dims]), aggs)
