"""Dimension transforms: text in, text out; empty text is null. Lists are transformed per element."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyspan.functions.expr import empty_to_null, null_to_empty, number_text
from tallyspan.functions.granularity import Granularity

Transform = Callable[[Column], Column]

# Fixed value: the ISO pattern of a printed time, in date_format letters.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


def regex(pattern: str, index: int = 1, replace_missing: bool = False, replacement: str | None = None) -> Transform:
    """Group ``index`` of the first match; no match keeps the value, or gives ``replacement``."""

    def run(c: Column) -> Column:
        text = null_to_empty(c)
        missing = F.lit(replacement).cast("string") if replace_missing else c
        return empty_to_null(F.when(text.rlike(pattern), F.regexp_extract(text, pattern, index)).otherwise(missing))

    return run


def partial(pattern: str) -> Transform:
    """The value where the pattern is found, else null."""
    return lambda c: empty_to_null(F.when(null_to_empty(c).rlike(pattern), c))


def identity() -> Transform:
    return lambda c: empty_to_null(c.cast("string"))


def substring(index: int, length: int | None = None) -> Transform:
    """0-based. A zero length at index 0 acts like no length; past the end gives null."""
    if index < 0 or (length is not None and length < 0):
        raise ValueError("index and length must not be negative")
    end = index + length if length is not None else -1

    def run(c: Column) -> Column:
        cut = F.substring(c, index + 1, end - index if end > 0 else 2147483647)
        return F.when(F.length(c) > index, empty_to_null(cut))

    return run


def cascade(*steps: Transform) -> Transform:
    def run(c: Column) -> Column:
        for step in steps:
            c = step(c)
        return c

    return run


def string_format(pattern: str, nulls: str = "nullString") -> Transform:
    """printf of the value; nulls print as ``null``, as empty text, or give null."""
    if nulls not in ("nullString", "emptyString", "returnNull"):
        raise ValueError(f"unknown null handling {nulls}")

    def run(c: Column) -> Column:
        if nulls == "returnNull":
            return F.when(c.isNotNull(), empty_to_null(F.format_string(pattern, c)))
        return empty_to_null(F.format_string(pattern, F.coalesce(c, F.lit("null" if nulls == "nullString" else ""))))

    return run


# Languages with a dotted and a dotless i.
DOTTED = ("tr", "az")


def upper(locale: str | None = None) -> Transform:
    """Capital letters, by the rules of a locale's language (``tr``, ``az-Latn`` …)."""
    if _language(locale) in DOTTED:
        return lambda c: empty_to_null(F.upper(F.translate(c, "i", "\u0130")))
    return lambda c: empty_to_null(F.upper(c))


def lower(locale: str | None = None) -> Transform:
    """Small letters, by the rules of a locale's language."""
    if _language(locale) in DOTTED:
        return lambda c: empty_to_null(F.lower(F.translate(F.replace(c, F.lit("I\u0307"), F.lit("i")), "\u0130I", "i\u0131")))
    return lambda c: empty_to_null(F.lower(c))


def _language(locale: str | None) -> str:
    return (locale or "").replace("_", "-").split("-")[0].lower()


def bucket(size: float = 1.0, offset: float = 0.0) -> Transform:
    """Lower edge of the bucket of a number, as text; whole edges print without a fraction."""

    def run(c: Column) -> Column:
        v = number_text(c.cast("string")).try_cast("double")
        edge = F.floor((v - F.lit(float(offset))) / F.lit(float(size))) * F.lit(float(size)) + F.lit(float(offset))
        whole = edge.try_cast("long")
        return F.when(edge == whole.cast("double"), whole.cast("string")).otherwise(edge.cast("string"))

    return run


def strlen() -> Transform:
    return lambda c: F.coalesce(F.length(c), F.lit(0)).cast("string")


def time_format(
    pattern: str | None = None,
    zone: str = "UTC",
    gran: Granularity | None = None,
    as_millis: bool = False,
    locale: str | None = None,
) -> Transform:
    """A time column as text, cut to a granularity first; or its epoch milliseconds as text.

    Patterns use date_format letters; month and day names are English, or those of ``locale`` (``fr-FR``).
    """
    if as_millis and pattern is None and zone != "UTC":
        raise ValueError("a time zone requires a format")

    def run(c: Column) -> Column:
        at = gran.start(c) if gran is not None else c
        if as_millis and pattern is None:
            return F.unix_millis(at).cast("string")
        local = at if zone == "UTC" else F.from_utc_timestamp(at, zone)
        if locale is None:
            return F.date_format(local, pattern or ISO_PATTERN)
        # the only built-in that takes a locale; quotes are switched off by a character no text holds
        options = {"timestampFormat": pattern or ISO_PATTERN, "locale": locale, "quote": "\u0000", "sep": "\u0001", "emptyValue": "", "nullValue": ""}
        return F.when(local.isNotNull(), F.to_csv(F.struct(local.cast("timestamp").alias("t")), options))

    return run


def each(step: Transform) -> Transform:
    """The transform applied to every element of a multi-value dimension."""
    return lambda c: F.transform(c, step)


def lookup(
    df: DataFrame,
    column: str,
    mapping: DataFrame,
    key: str,
    value: str,
    name: str,
    retain_missing: bool = False,
    replace_with: str | None = None,
) -> DataFrame:
    """Value from a mapping table, with unmatched values kept, replaced or null.

    A plain left join: a small mapping is broadcast by its measured size, a large one is shuffled. A key that the
    mapping gives two different values fails the job.
    """
    if retain_missing and replace_with:
        raise ValueError("cannot retain missing values and replace them")
    m = mapping.select(F.col(key).cast("string").alias("_k"), F.col(value).cast("string").alias("_v"))
    clash = F.raise_error(F.concat(F.lit("two values for the key "), F.col("_k"))).cast("string")
    m = m.groupBy("_k").agg(F.min(F.coalesce("_v", F.lit(""))).alias("_v"), F.max(F.coalesce("_v", F.lit(""))).alias("_w"))
    m = m.select("_k", F.when(F.col("_v") == F.col("_w"), F.col("_v")).otherwise(clash).alias("_v"))
    text = F.col(column).cast("string")
    missing = text if retain_missing else F.lit(replace_with).cast("string")
    return df.join(m, text == m["_k"], "left").withColumn(name, F.coalesce(empty_to_null(F.col("_v")), missing)).drop("_k", "_v")
