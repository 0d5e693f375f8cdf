"""The alert outbox over a stream of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyspan.operators.alerts import outbox
from tallyspan.session import scratch_path
from tallyspan.streaming.sinks import BATCH, read_batches, run_available


def outbox_available(requests: DataFrame, keep: list[str] = ("request_id",)) -> DataFrame:
    """One outbox write per micro-batch; returns the rows written."""
    spark = requests.sparkSession
    rows = outbox(requests, keep)
    out = scratch_path(spark, "outbox-stream")
    run_available(rows, out, "append")
    return read_batches(spark, rows.schema, out).drop(BATCH)
