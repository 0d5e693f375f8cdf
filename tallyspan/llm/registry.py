"""Where the operator modules' queries are registered, and how tasks find this package."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspan.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES_PER_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Settings of the allocators of Python workers: large arrays, Arrow's too, go back to the system when they are freed.
ALLOCATOR = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "MALLOC_ARENA_MAX": "2"}
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it is not installed: they start with its folder on their path.

    Workers outlive a stage, so what a stage freed must not stay with them. Batches of whole texts
    are large, and packed rows are larger, so unless the session says otherwise they get fewer rows and bytes than Spark's defaults: a batch is held by
    the JVM and by the worker at once.
    """
    path = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in path:
        spark.sparkContext.environment.setdefault("PYTHONPATH", os.pathsep.join([ROOT, *filter(None, path)]))
    for name, value in ALLOCATOR.items():
        spark.sparkContext.environment.setdefault(name, value)
    if spark.conf.get(ROWS_PER_BATCH) == "10000":
        spark.conf.set(ROWS_PER_BATCH, "1000")
    if spark.conf.get(BYTES_PER_BATCH, "67108864b") == "67108864b":
        spark.conf.set(BYTES_PER_BATCH, "4m")
    return use_utc(spark)


def query(key: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(reachable(spark), sf_dir)

        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register
