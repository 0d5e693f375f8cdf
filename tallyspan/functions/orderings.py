"""Sort keys that reproduce each named ordering with native ascending sorting; nulls come first.

Add a key as a column before a large sort: a sort evaluates expressions at each comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Digits that count as digits besides 0-9, each run from zero to nine.
OTHER_DIGITS = (
    "٠١٢٣٤٥٦٧٨٩"
    "۰۱۲۳۴۵۶۷۸۹"
    "०१२३४५६७८९"
    "０１２３４５６７８９"
)

# Fixed value: the shape of a decimal number in text.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def lexicographic(c: Column) -> Column:
    """UTF-8 byte order is the native order of strings."""
    return c


def natural(c: Column) -> Column:
    return c


def strlen(c: Column) -> Column:
    """Length, then text."""
    return F.when(c.isNotNull(), F.struct(F.length(c).alias("n"), c.alias("t")))


def numeric(c: Column) -> Column:
    """Text as numbers: null, then unparseable text in byte order, then the numbers by value."""
    # 38 digits with 12 after the point: exact for longs and for common decimals; longer numbers use the double
    # text that cannot be a number is sorted out by its shape first: a failing cast is slow
    text = F.when(c.rlike(NUMBER), c)
    exact = text.try_cast("decimal(38,12)")
    finite = text.try_cast("double")
    return F.when(
        c.isNotNull(),
        F.struct(
            finite.isNotNull().alias("is_number"),
            finite.alias("approx"),
            exact.alias("exact"),
            F.when(finite.isNull(), c).alias("text"),
        ),
    )


def alphanumeric(c: Column) -> Column:
    """Runs of digits by value and runs of other text without case, digits first.

    Each run is a struct: (is text, count of digits without leading zeros, those digits, leading
    zeros, folded text). Total length decides between texts whose runs are all equal.
    """
    plain = F.translate(c, OTHER_DIGITS, "0123456789" * 4)
    runs = F.regexp_extract_all(plain, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))

    def run(r: Column) -> Column:
        is_text = ~F.substring(r, 1, 1).rlike("[0-9]")
        digits = F.regexp_replace(r, "^0+", "")
        return F.struct(
            is_text.alias("is_text"),
            F.when(is_text, 0).otherwise(F.length(digits)).alias("size"),
            F.when(is_text, "").otherwise(digits).alias("digits"),
            F.when(is_text, 0).otherwise(F.length(r) - F.length(digits)).alias("zeros"),
            F.when(is_text, F.lower(F.upper(r))).otherwise("").alias("text"),
        )

    return F.when(c.isNotNull(), F.struct(F.transform(runs, run).alias("runs"), F.length(c).alias("n")))


def numeric_first(c: Column) -> list[Column]:
    """Non-finite doubles before finite ones."""
    finite = ~F.isnan(c) & (F.abs(c) < float("inf"))
    return [F.coalesce(finite, F.lit(False)), c]


def time_dims(ts: Column, *dims: tuple[Column, bool]) -> list[Column]:
    """Time, then dimensions in declared order; a list (flag set) goes by length, then by elements."""
    out = [ts]
    for c, is_list in dims:
        if is_list:
            out.append(F.coalesce(F.size(c), F.lit(0)))
        out.append(c)
    return out
