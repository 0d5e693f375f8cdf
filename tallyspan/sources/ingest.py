"""Text ingest: delimited, JSON, regex and map rows as Spark jobs over text DataFrames."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from tallyspan.functions.expr import number_text

# Default delimiters between fields and between list elements.
TAB = "\t"
CTRL_A = "\u0001"

REASON = "_reason"


def check_names(names: list[str]) -> None:
    """Duplicate field names, in any case, are an error."""
    twice = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if twice:
        raise ValueError(f"columns named twice: {sorted(twice)}")


def generated_names(width: int) -> list[str]:
    return [f"column_{i}" for i in range(1, width + 1)]


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def multivalue(c: Column, delimiter: str = CTRL_A) -> Column:
    """A field as a list: split when it holds the delimiter; empty parts are null."""
    parts = F.split(c, re.escape(delimiter), -1)
    return F.transform(parts, null_if_empty)


def delimited(
    lines: DataFrame,
    column: str,
    names: list[str] | None = None,
    width: int | None = None,
    delimiter: str = TAB,
    lists: list[str] = (),
    list_delimiter: str = CTRL_A,
) -> DataFrame:
    """Delimited lines → columns; short rows leave nulls, empty fields are null."""
    names = names or generated_names(width)
    check_names(names)
    parts = F.split(F.col(column), re.escape(delimiter), -1)
    kept = [c for c in lines.columns if c != column]
    out = []
    for i, n in enumerate(names):
        field = F.get(F.col("_parts"), i)
        out.append((multivalue(field, list_delimiter) if n in lists else null_if_empty(field)).alias(n))
    return lines.withColumn("_parts", parts).select(*kept, *out)


def read_delimited_files(
    spark: SparkSession, path: str, skip: int = 0, has_header: bool = True, names: list[str] | None = None, delimiter: str = TAB
) -> DataFrame:
    """Files whose first ``skip`` rows are no data and whose next row may hold the names.

    The place of a line in its file comes from the scan: line numbers rise inside a task, so the
    lowest one of a file's first block tells where the file begins. No line is shuffled.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    begins = lines.where("_block = 0").groupBy("_file").agg(F.min("_id").alias("_begin"))
    placed = lines.join(begins, "_file").withColumn("_line", F.when(F.col("_block") == 0, F.col("_id") - F.col("_begin")))
    if has_header:
        heads = placed.where(F.col("_line") == skip).select("value").distinct().limit(2).collect()
        if len(heads) != 1:
            raise ValueError("the files do not share one header row")
        names = heads[0][0].split(delimiter)
    data = placed.where(F.col("_line").isNull() | (F.col("_line") >= skip + (1 if has_header else 0)))
    return delimited(data.select("value"), "value", names=names, delimiter=delimiter)


# JSON -----------------------------------------------------------------------------------------------


def json_field_table(lines: DataFrame, column: str) -> DataFrame:
    """(key, a_list, a_scalar, all_long, all_number) of every field: scalars and flat lists; nested and null values
    are left out. One row per field, in Spark: where keys are data there may be many."""
    kv = lines.select(F.try_parse_json(F.col(column)).alias("_v"))
    parts = kv.lateralJoin(kv.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    # only a list of mixed parts has to be looked into
    fields = parts.select("key", "value", F.schema_of_variant("value").alias("kind")).select(
        "key", "kind", F.when(F.col("kind") == "ARRAY<VARIANT>", _is_flat_list(F.col("value"))).alias("mixed_flat")
    )
    kinds = F.col("kind")
    number = kinds.rlike("^(DECIMAL|DOUBLE|FLOAT)")
    flat_list = F.coalesce("mixed_flat", kinds.rlike("^ARRAY<") & ~kinds.rlike("^ARRAY<(ARRAY|OBJECT)"))
    scalar = ~kinds.rlike("^(OBJECT|ARRAY|VOID|NULL)")
    return (
        fields.distinct()
        .groupBy("key")
        .agg(
            F.max(flat_list).alias("a_list"),
            F.max(scalar).alias("a_scalar"),
            F.min(F.when(scalar, kinds == "BIGINT")).alias("all_long"),
            F.min(F.when(scalar, (kinds == "BIGINT") | number)).alias("all_number"),
        )
        .where("a_list or a_scalar")
    )


def discover_json_fields(lines: DataFrame, column: str, most: int = 2000) -> dict[str, str]:
    """Field name → type over all rows. Runs a job when called.

    Whole numbers are long, other numbers double, mixed kinds string. More than ``most`` fields fail: keys are then
    data rather than columns, and the caller picks from ``json_field_table``.
    """
    rows = json_field_table(lines, column).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} fields: choose some of json_field_table")
    out = {}
    for r in sorted(rows, key=lambda r: r["key"]):
        if r["a_list"]:
            out[r["key"]] = "array<string>"
        else:
            out[r["key"]] = "bigint" if r["all_long"] else "double" if r["all_number"] else "string"
    return out


def json_rows(lines: DataFrame, column: str, fields: dict[str, str] | None = None) -> DataFrame:
    """JSON lines → columns, by a given or discovered field list; nested values read as null."""
    fields = discover_json_fields(lines, column) if fields is None else fields
    check_names(list(fields))
    v = F.try_parse_json(F.col(column))
    kept = [c for c in lines.columns if c != column]
    return lines.withColumn("_v", v).select(*kept, *[_variant(F.col("_v"), _root_path(k), t).alias(k) for k, t in fields.items()])


def _is_flat_list(v: Column) -> Column:
    """A list without lists or objects in it."""
    parts = F.try_variant_get(F.when(F.schema_of_variant(v).startswith("ARRAY"), v), "$", "array<variant>")
    nested = F.exists(parts, lambda x: F.coalesce(F.schema_of_variant(x).rlike("^(OBJECT|ARRAY)"), F.lit(False)))
    return F.coalesce(~nested, F.lit(False))


def _root_path(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


def _variant(v: Column, path: str, kind: str) -> Column:
    """A root field by type; text and list fields are null where the value is nested."""
    got = F.try_variant_get(v, path, kind)
    if kind not in ("string", "array<string>"):
        return got
    # only text that looks nested is looked at again
    value = F.try_variant_get(v, path, "variant")
    if kind == "string":
        nested = _looks_nested(got) & F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
        return F.when(~nested, got)
    return F.when(~(F.exists(got, _looks_nested) & ~_is_flat_list(value)), got)


def _looks_nested(text: Column) -> Column:
    return F.coalesce(text.startswith("{") | text.startswith("["), F.lit(False))


def flatten_root(c: Column, key: str, kind: str = "string") -> Column:
    """Named field from a root key."""
    return F.try_variant_get(F.try_parse_json(c), _root_path(key), kind)


def flatten_path(c: Column, path: str, kind: str = "string") -> Column:
    """Named field from a JSON path."""
    return F.try_variant_get(F.try_parse_json(c), path, kind)


_JQ = re.compile(r"^(\.[A-Za-z_]\w*|\.?\[\d*\])+$")


def flatten_jq(c: Column, expr: str, kind: str = "string") -> Column:
    """First result of a jq query made of field and array steps (``.a.b[2]``, ``.a[]``)."""
    if not _JQ.match(expr):
        raise ValueError(f"not a path of field and array steps: {expr}")
    path = "$" + expr.replace(".[", "[").replace("[]", "[0]")
    return flatten_path(c, path, kind)


# regex, map, rejects ------------------------------------------------------------------------------------


def regex_rows(
    lines: DataFrame, column: str, pattern: str, names: list[str] | None = None, lists: list[str] = (), list_delimiter: str = CTRL_A
) -> DataFrame:
    """Groups of a full match → columns; a line that does not match carries a reason."""
    width = re.compile(re.sub(r"\(\?<([A-Za-z])", r"(?P<\1", pattern)).groups
    names = names or generated_names(width)
    check_names(names)
    whole = f"^(?:{pattern})$"
    c = F.col(column)
    kept = [n for n in lines.columns if n != column]
    out = []
    for i, n in enumerate(names, start=1):
        group = F.when(c.rlike(whole), F.regexp_extract(c, whole, i))
        out.append((multivalue(group, list_delimiter) if n in lists else null_if_empty(group)).alias(n))
    reason = F.when(~F.coalesce(c.rlike(whole), F.lit(False)), F.lit("no match")).alias(REASON)
    return lines.select(*kept, c.alias("_raw"), *out, reason)


def map_rows(df: DataFrame, ts: str, dims: list[str] = (), metrics: list[str] = (), exclusions: list[str] = ()) -> DataFrame:
    """Time, named dimensions or every column less the exclusions, and metrics."""
    skip = {ts, *metrics, *exclusions}
    chosen = list(dims) or [c for c in df.columns if c not in skip]
    return df.select(ts, *chosen, *metrics)


def split_rejects(df: DataFrame, reasons: dict[str, Column], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the first reason that holds); ``strict`` fails the job instead."""
    reason = F.lit(None).cast("string")
    for name, bad in reversed(list(reasons.items())):
        reason = F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(reason)
    tagged = df.withColumn(REASON, reason)
    if strict:
        checked = F.when(F.col(REASON).isNotNull(), F.raise_error(F.concat(F.lit("row rejected: "), F.col(REASON))))
        tagged = tagged.withColumn(REASON, checked.cast("string"))
    return tagged.where(F.col(REASON).isNull()).drop(REASON), tagged.where(F.col(REASON).isNotNull())


def decode_text(c: Column, charset: str = "UTF-8") -> Column:
    """Bytes → text with malformed bytes replaced by U+FFFD."""
    if charset.upper() in ("UTF-8", "UTF8"):
        return F.make_valid_utf8(c.cast("string"))
    if charset.upper() in ("ISO-8859-1", "LATIN1"):  # every byte is a character: nothing can be malformed
        return F.decode(c, "ISO-8859-1")
    return _decoder(charset)(c)


def _decoder(charset: str):
    @pandas_udf(T.StringType())
    def decode(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else bytes(b).decode(charset, errors="replace"))

    return decode


# numbers in text ------------------------------------------------------------------------------------------


def _number_text(c: Column) -> Column:
    text = F.regexp_replace(F.trim(c), ",", "")
    return F.when(text.rlike(r"^\+\d"), F.substring(text, 2, 2147483647)).otherwise(text)


def text_to_number(c: Column) -> Column:
    """Metric text as a double: commas dropped; null is 0; text that is no number is null (a reject)."""
    return F.when(c.isNull(), F.lit(0.0)).otherwise(number_text(_number_text(c)).try_cast("double"))


def text_to_long(c: Column) -> Column:
    """The same where the text is a whole number, else null."""
    text = _number_text(c)
    return F.when(c.isNull(), F.lit(0).cast("long")).when(text.rlike(r"^-?\d+$"), text.try_cast("long"))


def exact_long(c: Column) -> Column:
    """Text → long if it is integral and in range, else null.

    The range is checked on the digits before the cast: a cast that fails costs an exception per row.
    """
    text = F.substring_index(F.when(c.rlike(r"^[+-]?\d+(\.0*)?$"), c), ".", 1)
    digits = F.regexp_replace(text, "^[+-]?0*", "")
    largest = F.when(text.startswith("-"), "9223372036854775808").otherwise("9223372036854775807")
    fits = (F.length(text) <= 18) | (F.length(digits) < 19) | ((F.length(digits) == 19) & (digits <= largest))
    d = F.when(c.rlike(r"^[+-]?[\d.]+[eE][+-]?\d+$"), c).try_cast("decimal(38,18)")
    return F.when(fits, F.when(fits, text).cast("long")).when(d == F.floor(d), d.try_cast("long"))
