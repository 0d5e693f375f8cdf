"""Segment catalog and job configuration queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Identifier delimiter, ISO printing of times in identifiers, zone of "on a date".
DELIMITER = "_"
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
CATALOG_ZONE = "+08:00"

PAYLOAD = "interval string, dimensions string, metrics string, identifier string, size long, loadSpec struct<type: string, path: string>"
MAPPERS = "array<struct<sourceTable: string, splitKey: string, targetTable: string, source: struct<tableName: string, fields: array<string>>>>"


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_PATTERN)


def with_payload(df: DataFrame, column: str = "payload") -> DataFrame:
    """JSON payload → start, end, dimension and metric lists, size and load path."""
    p = F.from_json(F.col(column), PAYLOAD)
    ends = F.split(p["interval"], "/")
    return df.select(
        *[c for c in df.columns if c not in (column, "start", "end")],
        F.try_to_timestamp(F.get(ends, 0)).alias("start"),
        F.try_to_timestamp(F.get(ends, 1)).alias("end"),
        F.split(p["dimensions"], ",").alias("dimensions"),
        F.split(p["metrics"], ",").alias("metrics"),
        p["identifier"].alias("identifier"),
        p["size"].alias("size"),
        p["loadSpec"]["path"].alias("path"),
    )


def used_on(df: DataFrame, source: str, day: str, start: str = "start") -> DataFrame:
    """Used segments of a source whose start falls on a date of the catalog zone, by start and id.

    The date is turned into a range of the bare start column, which the scan can prune by.
    """
    first = F.to_utc_timestamp(F.lit(day).cast("timestamp"), CATALOG_ZONE)
    after = first + F.expr("interval 1 day")
    on = (F.col("used") == 1) & (F.col("datasource") == source) & (F.col(start) >= first) & (F.col(start) < after)
    return df.where(on).orderBy(start, "id")


def latest_per_source(df: DataFrame, start: str = "start") -> DataFrame:
    """Newest segment of every source: a maximum per source, not a sorted window."""
    newest = F.max_by(F.struct(*df.columns), F.struct(start, "id")).alias("_s")
    return df.where("used = 1").groupBy("datasource").agg(newest).select("_s.*")


def grouped(df: DataFrame) -> DataFrame:
    """Segments with the count and total size of their (source, interval), whatever its number of segments."""
    totals = df.groupBy("datasource", "start", "end").agg(F.count(F.lit(1)).alias("segments"), F.sum("size").alias("total_size"))
    return df.join(totals, ["datasource", "start", "end"])


def month_order(start: str = "start", identifier: str = "identifier") -> list[Column]:
    return [F.date_trunc("month", F.col(start)), F.col(identifier)]


def make_identifier(source: Column, start: Column, end: Column, version: Column, partition: Column) -> Column:
    """``source_start_end_version[_partition]``; partition 0 is left out."""
    tail = F.when(partition != 0, F.concat(F.lit(DELIMITER), partition.cast("string"))).otherwise("")
    return F.concat(F.concat_ws(DELIMITER, source, iso(start), iso(end), version), tail)


def parse_identifier(source: Column, identifier: Column) -> Column:
    """Identifier → struct(start, end, version, trail); null when it does not fit the source."""
    fits = identifier.startswith(F.concat(source, F.lit(DELIMITER)))
    rest = F.split(F.substring(identifier, F.length(source) + 2, F.length(identifier)), DELIMITER)
    start, end = (F.try_to_timestamp(F.get(rest, i)) for i in (0, 1))
    trail = F.when(F.size(rest) > 3, F.array_join(F.slice(rest, 4, F.greatest(F.size(rest) - 3, F.lit(1))), DELIMITER))
    parts = F.struct(start.alias("start"), end.alias("end"), F.get(rest, 2).alias("version"), trail.alias("trail"))
    return F.when(fits & (F.size(rest) >= 3) & start.isNotNull() & end.isNotNull(), parts)


def with_interval(source: Column, identifier: Column, start: Column, end: Column) -> Column:
    """The identifier rewritten for another interval; one that does not parse is kept."""
    p = parse_identifier(source, identifier)
    again = F.concat_ws(DELIMITER, source, iso(start), iso(end), p["version"], p["trail"])
    return F.when(p.isNotNull(), again).otherwise(identifier)


def compare(left: DataFrame, right: DataFrame, lists: list[str] = ()) -> DataFrame:
    """Rows whose number of copies differs between two tables; no rows means the tables are equal.

    One grouped count over both: repeats are summed before the shuffle. An empty list equals a single null.
    """
    columns = left.columns

    def side(df, sign):
        shown = [
            F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.col(c)).otherwise(F.array(F.lit(None).cast("string"))).alias(c)
            if c in lists
            else F.col(c)
            for c in columns
        ]
        return df.select(*shown, F.lit(sign).alias("_sign"))

    both = side(left, 1).unionByName(side(right, -1))
    return both.groupBy(*columns).agg(F.sum("_sign").alias("surplus")).where("surplus <> 0")


def agreed(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Per group and column: the common value when all rows have it, else null."""
    out = [
        F.when((F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1))), F.min(c)).alias(c) for c in columns
    ]
    return df.groupBy(*group).agg(*out)


def column_stats(df: DataFrame, ts: str, dims: list[str]) -> DataFrame:
    """Per dimension: cardinality, smallest and largest value; with rows and time range of the table.

    Values are counted per (dimension, value) first, so no task holds one dimension's values.
    """
    pairs = df.select(
        ts, F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims])).alias("_p")
    ).select(ts, "_p.*")
    values = pairs.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    return values.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("cardinality"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.sum("_n").alias("rows"),
        F.min("_lo").alias("min_time"),
        F.max("_hi").alias("max_time"),
    )


# job configuration ---------------------------------------------------------------------------------


def resolve_jobs(jobs: DataFrame, sources: DataFrame, outputs: DataFrame, output_type: str = "HADOOP", name: str | None = None) -> DataFrame:
    """Inner join of job definition, source and output, for one output type and optionally one job."""
    wanted = jobs.where(F.col("output_type") == output_type)
    if name is not None:
        wanted = wanted.where(F.col("define_name") == name)
    s = sources.select(F.col("id").alias("input_source_id"), "source_code", "source_url", "source_type")
    o = outputs.select(F.col("id").alias("output_source_id"), "object_type", "data_path", "hive_schema")
    return wanted.join(s, "input_source_id").join(o, "output_source_id")


def mappings(jobs: DataFrame, column: str = "table_mappers") -> DataFrame:
    """Table-mapping JSON array → one row per mapping."""
    m = F.explode(F.from_json(F.col(column), MAPPERS))
    rows = jobs.withColumn("_m", m)
    return rows.select(
        *[c for c in jobs.columns if c != column],
        F.coalesce("_m.source.tableName", "_m.sourceTable").alias("source_table"),
        F.col("_m.splitKey").alias("split_key"),
        F.col("_m.targetTable").alias("target_table"),
        F.col("_m.source.fields").alias("fields"),
    )


def source_by_code(sources: DataFrame, code: str) -> DataFrame:
    """One data source; a code that is not there is an error."""
    hit = sources.where(F.col("source_code") == code)
    if not hit.take(1):
        raise ValueError(f"no data source with code {code}")
    return hit


def table_columns(dbs: DataFrame, tbls: DataFrame, sds: DataFrame, columns: DataFrame) -> DataFrame:
    """Columns of every table in ordinal order, through a chain of left joins from the databases."""
    return (
        dbs.join(tbls, "db_id", "left")
        .join(sds, "sd_id", "left")
        .join(columns, "cd_id", "left")
        .select("db_name", "tbl_name", "column_name", "type_name", "integer_idx")
    )
