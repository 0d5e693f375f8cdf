"""Text and numbers to instants, cut to milliseconds; text that cannot be read gives null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: a zone name after the last space. It only sets how the time would be shown.
ZONE_SUFFIX = r" ([A-Za-z]+/[A-Za-z_/]+|[A-Z]{3,4}|[+-]\d{2}:\d{2})$"


def strip_quotes(c: Column) -> Column:
    text = F.trim(c)
    quoted = (F.length(text) > 1) & text.startswith('"') & text.endswith('"')
    return F.when(quoted, F.trim(F.substring(text, F.lit(2), F.length(text) - 2))).otherwise(text)


def _to_millis(c: Column) -> Column:
    return F.date_trunc("millisecond", c)


def parse_iso(c: Column) -> Column:
    """ISO date or date-time, quotes stripped; no zone means UTC."""
    text = strip_quotes(c)
    return _to_millis(F.when(text.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?([T ]|$)"), text).try_cast("timestamp"))


def parse_auto(c: Column) -> Column:
    """All digits are epoch milliseconds; otherwise ISO text, with a zone name at the end ignored."""
    digits = c.rlike("^[0-9]+$")
    millis = F.timestamp_millis(F.when(digits, c).try_cast("long"))
    return F.when(digits, millis).otherwise(parse_iso(F.regexp_replace(strip_quotes(c), ZONE_SUFFIX, "")))


def parse_numeric(c: Column, fmt: str) -> Column:
    """``posix`` seconds, ``millis``, ``nano``, or ``ruby`` (seconds with a fraction that is dropped)."""
    if fmt == "ruby":
        return F.timestamp_seconds(c.try_cast("double").cast("long"))
    n = c.try_cast("long")
    if fmt == "posix":
        return F.timestamp_seconds(n)
    if fmt == "nano":
        return F.timestamp_millis(F.call_function("div", n, F.lit(1000000)))
    if fmt == "millis":
        return F.timestamp_millis(n)
    raise ValueError(f"unknown numeric time format {fmt}")


def parse_format(c: Column, pattern: str) -> Column:
    """Custom pattern in Spark's pattern letters."""
    return F.try_to_timestamp(strip_quotes(c), F.lit(pattern))


def timestamp_parser(fmt: str):
    """Column function for a format name: auto, iso, posix, millis, nano, ruby, or a pattern."""
    name = fmt.lower()
    if name == "auto":
        return parse_auto
    if name == "iso":
        return parse_iso
    if name in ("posix", "millis", "nano", "ruby"):
        return lambda c: parse_numeric(strip_quotes(c.cast("string")), name)
    return lambda c: parse_format(c, fmt)


def with_default(ts: Column, missing: str | None) -> Column:
    """A missing time takes the configured default; without one it stays null and is rejected."""
    return ts if missing is None else F.coalesce(ts, F.lit(missing).cast("timestamp"))
