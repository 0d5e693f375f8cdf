"""Relational reads and writes through Spark's JDBC source.

Reads are split by predicates from ``ranges``; every partition opens its own connection on its
executor. Nothing passes through the driver but the two numbers of the range probe.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from tallyspan.functions.hivetypes import database_type
from tallyspan.sources.ranges import default_split_key, hash_predicates, range_predicates, ranges

# Fixed value: the export date that stands for "yesterday".
YESTERDAY = "1970-01-01"


def range_scan(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    tasks: int,
    split_key: str | None = None,
    primary_keys: list[str] = (),
    fields: list[str] | None = None,
    hashed: str | None = None,
) -> DataFrame:
    """Partitioned scan on a numeric key, or without one on the remainder of the first primary key (or of its hash)."""
    key = default_split_key(split_key, list(primary_keys))
    if key:
        probe = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) probe"
        lo, hi = spark.read.jdbc(url, probe, properties=properties).first()
        parts = ranges(int(lo), int(hi), tasks) if lo is not None else []
        predicates = range_predicates(key, parts)
    elif primary_keys:
        predicates = hash_predicates(primary_keys[0], tasks, hashed)
    else:
        predicates = ["1 = 1"]
    df = spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    return df.select(*fields) if fields else df


def column_types(df: DataFrame) -> str:
    """Database column types of a table, for ``createTableColumnTypes``."""
    return ", ".join(f"{f.name} {database_type(f.dataType.simpleString())}" for f in df.schema.fields)


def replace_export(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Drop and recreate the target from the source schema, then write all rows."""
    df.write.option("createTableColumnTypes", column_types(df)).jdbc(url, table, mode="overwrite", properties=properties)


def export_date(day: str, today: date | None = None) -> str:
    if day == YESTERDAY:
        return str((today or date.today()) - timedelta(days=1))
    return day


def dated_rows(spark: SparkSession, sql: str, day: str, **tables: DataFrame) -> DataFrame:
    """The rows to export: user SQL with ``:date`` as a parameter."""
    return spark.sql(sql, args={"date": export_date(day)}, **tables)


def dated_export(
    spark: SparkSession, rows: DataFrame, url: str, table: str, clean_sql: str, day: str, properties: dict[str, str], batch: int = 1000
) -> None:
    """Idempotent export of one date: one DELETE with the date as a parameter, then an append."""
    jvm = spark.sparkContext._jvm
    options = jvm.java.util.Properties()
    for k, v in properties.items():
        options.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, options)
    try:
        statement = connection.prepareStatement(clean_sql)
        statement.setString(1, export_date(day))
        statement.executeUpdate()
        statement.close()
    finally:
        connection.close()
    rows.write.option("batchsize", batch).jdbc(url, table, mode="append", properties=properties)
