"""Hand-worked cases of the null, zero, truth and type rules."""

import math

import pytest
from pyspark.sql import functions as F

from tallyspan.functions import expr as e

INF, NAN = math.inf, math.nan


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


CASES = [
    # arithmetic
    (lambda: e.long(7) / e.long(2), 3),
    (lambda: e.long(-7) / e.long(2), -3),
    (lambda: e.long(7) / e.double(2.0), 3.5),
    (lambda: e.double(1.0) / 0.0, INF),
    (lambda: e.double(-1.0) / 0.0, -INF),
    (lambda: e.double(0.0) / 0.0, NAN),
    (lambda: e.double(5.5) % 2.0, 1.5),
    (lambda: e.double(5.5) % 0.0, NAN),
    (lambda: e.long(2) ** e.long(10), 1024),
    (lambda: -e.long(3), -3),
    # null is 0 in mixed arithmetic, text is a number or 0
    (lambda: e.double(F.lit(None)) + 2.5, 2.5),
    (lambda: e.text("x") * 3, 0.0),
    (lambda: e.text("4") * 3, 12.0),
    # text plus
    (lambda: e.text("a") + e.text("b"), "ab"),
    (lambda: e.text(None) + e.text("b"), "b"),
    (lambda: e.text(None) + e.text(None), None),
    # comparison
    (lambda: e.long(1) < 2, 1),
    (lambda: e.double(1.0) < 2.0, 1.0),
    (lambda: e.text(None) < "a", 1),
    (lambda: e.text(None).equals(e.text(None)), 1),
    (lambda: e.text("b") >= "a", 1),
    (lambda: e.long(1).differs(1), 0),
    # logic gives an operand
    (lambda: e.long(3).and_(e.long(-5)), -5),
    (lambda: e.long(0).and_(e.long(9)), 0),
    (lambda: e.long(-1).or_(e.long(9)), 9),
    (lambda: e.long(2).or_(e.long(9)), 2),
    (lambda: e.text("TRUE").not_(), 0),
    (lambda: e.text("yes").not_(), 1),
    (lambda: e.double(0.5).not_(), 0.0),
    # functions
    (lambda: e.fn("log", e.double(0.0)), -INF),
    (lambda: e.fn("log", e.double(-1.0)), NAN),
    (lambda: e.fn("acos", e.double(2.0)), NAN),
    (lambda: e.fn("sqrt", e.double(-4.0)), NAN),
    (lambda: e.fn("round", e.double(2.5)), 3),
    (lambda: e.fn("round", e.double(-2.5)), -2),
    (lambda: e.fn("rint", e.double(2.5)), 2.0),
    (lambda: e.fn("ceil", e.double(1.2)), 2.0),
    (lambda: e.fn("floor", e.double(-1.2)), -2.0),
    (lambda: e.fn("abs", e.long(-4)), 4),
    (lambda: e.fn("cos", e.text("1")), None),
    (lambda: e.fn2("remainder", e.double(5.0), e.double(3.0)), -1.0),
    (lambda: e.fn2("max", e.long(2), e.long(5)), 5),
    (lambda: e.fn2("min", e.long(2), e.double(5.5)), 2.0),
    (lambda: e.fn2("div", e.double(7.9), e.double(2.9)), 3),
    (lambda: e.fn2("copySign", e.double(3.0), e.double(-0.5)), -3.0),
    (lambda: e.fn2("scalb", e.double(3.0), e.long(4)), 48.0),
    (lambda: e.fn2("nextAfter", e.double(1.0), 2.0), math.nextafter(1.0, 2.0)),
    (lambda: e.fn_bits("nextUp", e.double(1.0)), math.nextafter(1.0, INF)),
    (lambda: e.fn_bits("ulp", e.double(-8.0)), math.ulp(8.0)),
    (lambda: e.fn_bits("getExponent", e.double(0.0)), -1023),
    (lambda: e.fn_bits("getExponent", e.double(INF)), 1024),
    (lambda: e.fn_bits("getExponent", e.double(0.75)), -1),
    # choice
    (lambda: e.if_(e.long(1), "a", "b"), "a"),
    (lambda: e.case_searched(e.long(0), "a", e.long(1), "b", "c"), "b"),
    (lambda: e.case_searched(e.long(0), "a"), None),
    (lambda: e.case_simple(e.text("x"), "y", 1, "x", 2, 3), 2),
    # casts
    (lambda: e.cast(e.text("1.5"), "LONG"), 0),
    (lambda: e.cast(e.text("15"), "LONG"), 15),
    (lambda: e.cast(e.text("1.5"), "DOUBLE"), 1.5),
    (lambda: e.cast(e.double(2.9), "LONG"), 2),
    (lambda: e.cast(e.double(1e300), "LONG"), 2**63 - 1),
    (lambda: e.nvl(e.text(""), "z"), "z"),
    (lambda: e.nvl(e.long(5), 7), 5),
    # time and text
    (lambda: e.timestamp(e.text("2024-01-02T03:04:05Z")), 1704164645000),
    (lambda: e.unix_timestamp(e.text("02.01.2024"), "dd.MM.yyyy"), 1704153600),
    (lambda: e.concat(e.text("a"), e.text(None), e.text("b")), "ab"),
    (lambda: e.concat(e.text(None)), None),
    (lambda: e.strlen(e.text(None)), 0),
    (lambda: e.strpos(e.text("hello"), "l"), 2),
    (lambda: e.strpos(e.text("hello"), "z"), -1),
    (lambda: e.substring(e.text("hello"), 1, 3), "ell"),
    (lambda: e.substring(e.text("hello"), 2, -1), "llo"),
    (lambda: e.substring(e.text("hello"), 5, 2), None),
    (lambda: e.replace(e.text("aaa"), "a", ""), None),
    (lambda: e.upper(e.text("")), None),
    (lambda: e.single_value(F.array(F.lit("a"), F.lit("b"))), None),
    (lambda: e.single_value(F.array(F.lit("a"))), "a"),
]


def test_cases(spark):
    made = [make() for make, _ in CASES]
    row = spark.range(1).select(*[m.col.alias(f"c{i}") for i, m in enumerate(made)]).first()
    wrong = [(i, row[i], want) for i, (_, want) in enumerate(CASES) if not same(row[i], want)]
    assert not wrong


def test_long_division_by_zero_fails(spark):
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        spark.range(1).select((e.long("id") / 0).col).collect()


def test_macros_reject_duplicates(spark):
    m = e.Macros()
    m.add("twice", lambda x: x * 2)
    with pytest.raises(ValueError):
        m.add("TWICE", lambda x: x)
    assert spark.range(3).select(m.call("Twice", e.long("id")).col).collect()[2][0] == 4
