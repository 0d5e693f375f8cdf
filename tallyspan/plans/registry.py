"""Where the plan modules register their queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyspan.session import use_utc
from tallyspan.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Attribute access to the tables of one scale folder: ``t.events``, ``t.orders`` …"""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key``.

    Instants leave as zone-free timestamps, the type the SQL side works in.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(Tables(use_utc(spark), sf_dir))
            return out.select(
                *[
                    F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                    if isinstance(f.dataType, T.TimestampType)
                    else F.col(f"`{f.name}`")
                    for f in out.schema.fields
                ]
            )

        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
