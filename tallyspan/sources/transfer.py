"""Table transfer: row keys, cleaned lines, partitioned and audited writes, replace by partition or table."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# Field separator and null marker of exported lines, and the zone of exported times.
SEPARATOR = "\u0001"
NULL_MARKER = "\\N"
EXPORT_ZONE = "+08:00"


def row_key(keys: list[str]) -> Column:
    """Key columns joined by ``_``; null when any of them is null."""
    parts = [x for k in keys for x in (F.lit("_"), F.col(k).cast("string"))][1:]
    return F.concat(*parts).alias("table_pk")


def with_row_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(row_key(keys), *keys, *[c for c in df.columns if c not in keys])


def clean_text(c: Column) -> Column:
    """Null and the text "null" in any case become the null marker; line breaks are removed."""
    text = c.cast("string")
    return F.when(text.isNull() | (F.lower(text) == "null"), F.lit(NULL_MARKER)).otherwise(F.translate(text, "\r\n", ""))


def encode_row(df: DataFrame, keys: list[str]) -> Column:
    """One line per row: row key, the keys as they are, then the cleaned fields."""
    as_is = [F.coalesce(c.cast("string"), F.lit("null")) for c in (row_key(keys), *[F.col(k) for k in keys])]
    return F.concat_ws(SEPARATOR, *as_is, *[clean_text(F.col(c)) for c in df.columns if c not in keys])


def encode_event(ts: str, columns: list[str]) -> Column:
    """One line per event: export time fields, then values with nulls marked."""
    return F.concat_ws(
        SEPARATOR,
        *[c.cast("string") for c in event_time(F.col(ts)).values()],
        *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARKER)) for c in columns],
    )


def event_time(ts: Column) -> dict[str, Column]:
    """Epoch milliseconds, and the calendar fields in the export zone."""
    local = F.from_utc_timestamp(ts, EXPORT_ZONE)
    return {
        "timestamp": F.unix_millis(ts),
        "year": F.year(local),
        "month": F.month(local),
        "day": F.dayofmonth(local),
        "hour": F.hour(local),
        "minute": F.minute(local),
    }


def with_export_date_hour(df: DataFrame, ts: str) -> DataFrame:
    """Partition columns ``date`` (yyyy-MM-dd) and ``hour`` (HH) in the export zone."""
    local = F.from_utc_timestamp(F.col(ts), EXPORT_ZONE)
    return df.withColumns({"date": F.date_format(local, "yyyy-MM-dd"), "hour": F.date_format(local, "HH")})


def write_partitioned(df: DataFrame, path: str, parts: list[str], mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """Partitioned write with few files per partition value.

    The rebalance hint gathers each value's rows but splits a value that is too large for one task.
    """
    df.hint("rebalance", *[F.col(p) for p in parts]).write.mode(mode).format(fmt).partitionBy(*parts).save(path)


def write_audited(df: DataFrame, path: str, parts: list[str]) -> int:
    """Partitioned write that counts its rows while it writes; no second pass over the data."""
    seen = Observation()
    write_partitioned(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, parts)
    return seen.get["rows"]


def replace_partitions(df: DataFrame, path: str, parts: list[str], values: list[tuple] = ()) -> None:
    """Replace the partitions that ``df`` has rows for and those named in ``values``; the others stay.

    A named partition that gets no rows is dropped, so a reload without rows leaves nothing of the earlier load.
    """
    spark = df.sparkSession
    named = {"/".join(f"{p}={v}" for p, v in zip(parts, value)) for value in values}
    (
        df.hint("rebalance", *[F.col(p) for p in parts])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )
    if named:
        filled = {"/".join(f"{p}={r[p]}" for p in parts) for r in df.where(_any_of(parts, values)).select(*parts).distinct().collect()}
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for name in sorted(named - filled):
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, name), True)


def _any_of(parts: list[str], values: list[tuple]) -> Column:
    """Rows of the named partitions."""
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(p).cast("string") == F.lit(str(v)) for p, v in zip(parts, value)]) for value in values])


def write_targets(parts: list[tuple[str, str, DataFrame]], path: str) -> None:
    """One job that routes encoded lines of many (target, source, lines) to ``target/source`` folders."""
    tagged = [
        d.select("line", F.lit(target).alias("target_table"), F.lit(source).alias("source_table")) for target, source, d in parts
    ]
    write_partitioned(reduce(DataFrame.unionByName, tagged), path, ["target_table", "source_table"], fmt="text")


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, target_table string, source_table string").text(path)


def replace_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Replace a table as a whole: stage the rows in a new folder, then point the table at it.

    Until the switch readers see the old rows, after it the new ones; a job that fails while it
    stages leaves the table as it was.
    """
    spark = df.sparkSession
    df.write.parquet(path)
    if spark.catalog.tableExists(name):
        if spark.table(name).schema.simpleString() == df.schema.simpleString():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return spark.table(name)
        spark.sql(f"DROP TABLE {name}")
    return spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)


def audit(df: DataFrame) -> DataFrame:
    """Row counts per source, and per source, date and hour with date totals, from one pass."""
    return df.groupingSets(
        [["source"], ["source", "date"], ["source", "date", "hour"]], "source", "date", "hour"
    ).agg(F.grouping_id().cast("int").alias("_level"), F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("_level") == 3, "source").when(F.col("_level") == 1, "date").otherwise("hour").alias("level"), "source", "date", "hour", "n"
    )


def like_pattern(name: str, pattern: str) -> bool:
    """SQL LIKE on a table name, with ``%`` as the only wildcard; case does not matter."""
    return re.fullmatch(".*".join(map(re.escape, pattern.lower().split("%"))), name.lower(), re.S) is not None


def wildcard_union(spark: SparkSession, pattern: str, names: list[str] | None = None, read=None) -> DataFrame:
    """Every table whose name matches the ``%`` pattern, unioned by column name with its source table."""
    names = names if names is not None else [t.name for t in spark.catalog.listTables()]
    hits = sorted(n for n in names if like_pattern(n, pattern))
    if not hits:
        raise ValueError(f"no table matches {pattern}")
    read = read or spark.table
    return reduce(DataFrame.unionByName, [read(n).withColumn("source_table", F.lit(n)) for n in hits])
