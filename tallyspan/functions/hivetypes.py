"""Type maps between databases, table columns and exported tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Source column type → table type; every other type is a string.
SOURCE_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "TINYINT": "int",
    "SMALLINT": "int",
    "DOUBLE": "decimal",
    "DECIMAL": "decimal",
    "FLOAT": "decimal",
    "TIMESTAMP": "timestamp",
    "TIME_WITH_TIMEZONE": "timestamp",
    "TIMESTAMP_WITH_TIMEZONE": "timestamp",
    "DATE": "date",
}

# Table type → database type; decimals are kept, every other type is VARCHAR(200).
DATABASE_TYPES = {"string": "VARCHAR(200)", "bigint": "BIGINT", "int": "INT", "tinyint": "INT", "timestamp": "DATETIME", "date": "DATETIME"}


def table_type(source: str, precision: int = 38, scale: int = 4) -> str:
    t = SOURCE_TYPES.get(source.upper(), "string")
    return f"decimal({precision},{scale})" if t == "decimal" else t


def database_type(table: str) -> str:
    if table.lower().startswith("decimal"):
        return table.upper()
    return DATABASE_TYPES.get(table.lower(), "VARCHAR(200)")


def as_table(df: DataFrame, source_types: dict[str, tuple]) -> DataFrame:
    """Columns cast to their table types; ``source_types`` gives (type, precision, scale) per column."""
    return df.select(*[F.col(n).cast(table_type(*t)).alias(n) for n, t in source_types.items()])


def as_event_table(df: DataFrame, dims: list[str], metrics: list[str], others: list[str | Column] = ()) -> DataFrame:
    """Exported event tables: dimensions are strings, metrics are bigint."""
    return df.select(*others, *[F.col(d).cast("string").alias(d) for d in dims], *[F.col(m).cast("bigint").alias(m) for m in metrics])
