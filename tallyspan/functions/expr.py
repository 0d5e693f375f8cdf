"""Typed expression columns: LONG, DOUBLE and STRING with the null, zero and truth rules.

``long("a") + double("b")`` compiles to native expressions. A null operand reads as 0 in
arithmetic, truth is ``> 0`` (or the text "true"), comparisons give 0 or 1 in the operand type, and
an empty text is null.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import pandas_udf

LONG, DOUBLE, STRING = "long", "double", "string"

# Fixed value: the shape of a double in text.
NUMBER = r"^\s*[+-]?(NaN|Infinity|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)\s*$"


def _nan() -> Column:
    return F.lit(float("nan"))


def _inf(sign: int = 1) -> Column:
    return F.lit(sign * float("inf"))


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def number_text(c: Column) -> Column:
    """The text if it has the shape of a number, else null.

    Tested before a cast, because a cast that fails costs an exception per row.
    """
    return F.when(c.rlike(NUMBER), c)


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def ieee_divide(a: Column, b: Column) -> Column:
    """Double division that gives ±infinity or NaN over zero."""
    # a negative zero is seen in its text only
    side = F.when(b.cast("string").startswith("-"), -1.0).otherwise(1.0)
    return (
        F.when(b != 0, a / F.when(b != 0, b))
        .when(F.isnan(a) | (a == 0), _nan())
        .otherwise(F.signum(a) * side * _inf())
    )


_WORD = Decimal(1 << 64)


def _wrapped_product(a: Column, b: Column) -> Column:
    """``a * b`` modulo 2^64 for decimals in [0, 2^64), in halves that fit 38 digits."""
    wide, half = "decimal(38,0)", F.lit(1 << 32).cast("decimal(10,0)")
    a, b = a.cast("decimal(20,0)"), b.cast("decimal(20,0)")
    low, high = (b % half).cast("decimal(10,0)"), F.call_function("div", b, half).cast("decimal(10,0)")
    upper = ((a * high).cast(wide) % half).cast("decimal(10,0)") * half
    return (((a * low).cast(wide) + upper.cast(wide)).cast(wide) % F.lit(_WORD).cast("decimal(20,0)")).cast(wide)


def long_power(a: Column, n: Column) -> Column:
    """The exact power of longs. It wraps around at 64 bits; a negative exponent gives the whole part of the
    fraction, and fails for 0."""
    small = F.aggregate(F.sequence(F.lit(1).cast("long"), n), F.lit(1).cast("long"), lambda acc, _: acc * a)
    # past the long range: squares and products modulo 2^64, one step per bit of the exponent
    wide = "decimal(38,0)"
    start = F.struct(F.lit(1).cast(wide).alias("out"), F.when(a < 0, a.cast(wide) + F.lit(_WORD).cast(wide)).otherwise(a.cast(wide)).cast(wide).alias("square"))
    step = lambda acc, k: F.struct(
        F.when(F.call_function("shiftright", n, k).bitwiseAND(1) == 1, _wrapped_product(acc["out"], acc["square"])).otherwise(acc["out"]).alias("out"),
        _wrapped_product(acc["square"], acc["square"]).alias("square"),
    )
    wrapped = F.aggregate(F.sequence(F.lit(0), F.lit(62)), start, step, lambda acc: acc["out"])
    signed = F.when(wrapped >= F.lit(_WORD / 2).cast("decimal(20,0)"), wrapped - F.lit(_WORD).cast("decimal(20,0)")).otherwise(wrapped).cast("long")
    one, odd = F.lit(1).cast("long"), n % 2 != 0
    return (
        F.when(n == 0, one)
        .when(a == 1, one)
        .when(a == -1, F.when(odd, -one).otherwise(one))
        .when((a == 0) & (n < 0), F.call_function("div", one, a))
        .when((a == 0) | (n < 0), one - one)
        .when(F.pow(F.abs(a.cast("double")), n.cast("double")) < 9.0e18, small)
        .otherwise(signed)
    )


@dataclass(frozen=True, eq=False)
class Typed:
    col: Column
    kind: str

    # conversions -------------------------------------------------------------------------
    def as_long(self) -> Typed:
        if self.kind == LONG:
            return self
        if self.kind == STRING:
            # text is a long only when all of it is: "1.5" is 0
            whole = F.when(self.col.rlike("^[+-]?[0-9]+$"), self.col)
            return Typed(F.coalesce(whole.try_cast("long"), F.lit(0).cast("long")), LONG)
        top, low = F.lit(9223372036854775807), F.lit(-9223372036854775808)
        d = self.col
        cut = F.when(d >= F.lit(9.223372036854775807e18), top).when(d <= F.lit(-9.223372036854775808e18), low).otherwise(
            F.when(~F.isnan(d), d).try_cast("long")
        )
        return Typed(F.coalesce(cut, F.lit(0).cast("long")), LONG)

    def as_double(self) -> Typed:
        if self.kind == DOUBLE:
            return self
        c = number_text(self.col).try_cast("double") if self.kind == STRING else self.col.cast("double")
        return Typed(F.coalesce(c, F.lit(0.0)), DOUBLE)

    def as_string(self) -> Typed:
        return self if self.kind == STRING else Typed(self.col.cast("string"), STRING)

    def _zeroed(self) -> Column:
        return F.coalesce(self.col, F.lit(0).cast(self.kind))

    def truth(self) -> Column:
        if self.kind == STRING:
            return F.coalesce(F.lower(self.col) == "true", F.lit(False))
        return F.coalesce(self.col > 0, F.lit(False))

    # arithmetic --------------------------------------------------------------------------
    def _both(self, other, longs: Callable, doubles: Callable) -> Typed:
        other = typed(other)
        if self.kind == LONG and other.kind == LONG:
            return Typed(longs(self._zeroed(), other._zeroed()), LONG)
        return Typed(doubles(self.as_double()._zeroed(), other.as_double()._zeroed()), DOUBLE)

    def __add__(self, other):
        other = typed(other)
        if self.kind == STRING and other.kind == STRING:
            return Typed(empty_to_null(F.concat(null_to_empty(self.col), null_to_empty(other.col))), STRING)
        return self._both(other, lambda a, b: a + b, lambda a, b: a + b)

    def __sub__(self, other):
        return self._both(other, lambda a, b: a - b, lambda a, b: a - b)

    def __mul__(self, other):
        return self._both(other, lambda a, b: a * b, lambda a, b: a * b)

    def __truediv__(self, other):
        return self._both(other, lambda a, b: F.call_function("div", a, b), ieee_divide)

    def __mod__(self, other):
        return self._both(other, lambda a, b: a % b, lambda a, b: F.when(b != 0, a % F.when(b != 0, b)).otherwise(_nan()))

    def __pow__(self, other):
        return self._both(other, long_power, F.pow)

    def __neg__(self):
        return Typed(-self._zeroed(), self.kind)

    # comparison --------------------------------------------------------------------------
    def _compare(self, other, op) -> Typed:
        other = typed(other)
        if self.kind == STRING and other.kind == STRING:
            # null is below every text; rank it and compare both parts
            a, b = (F.struct(x.col.isNotNull().alias("some"), null_to_empty(x.col).alias("text")) for x in (self, other))
            return Typed(op(a, b).cast("long"), LONG)
        kind = LONG if self.kind == LONG and other.kind == LONG else DOUBLE
        pair = (self, other) if kind == LONG else (self.as_double(), other.as_double())
        return Typed(op(pair[0]._zeroed(), pair[1]._zeroed()).cast(kind), kind)

    def __lt__(self, other):
        return self._compare(other, lambda a, b: a < b)

    def __le__(self, other):
        return self._compare(other, lambda a, b: a <= b)

    def __gt__(self, other):
        return self._compare(other, lambda a, b: a > b)

    def __ge__(self, other):
        return self._compare(other, lambda a, b: a >= b)

    def equals(self, other):
        return self._compare(other, lambda a, b: a == b)

    def differs(self, other):
        return self._compare(other, lambda a, b: a != b)

    # logic: && and || give one of their operands --------------------------------------------
    def and_(self, other):
        a, b = same_kind(self, typed(other))
        return Typed(F.when(self.truth(), b.col).otherwise(a.col), a.kind)

    def or_(self, other):
        a, b = same_kind(self, typed(other))
        return Typed(F.when(self.truth(), a.col).otherwise(b.col), a.kind)

    def not_(self):
        kind = LONG if self.kind == STRING else self.kind
        return Typed((~self.truth()).cast("int").cast(kind), kind)


def _make(kind):
    def build(x) -> Typed:
        """A column name, a Column, or (for numbers) a literal."""
        if isinstance(x, Column):
            return Typed(x.cast(kind), kind)
        if isinstance(x, str):
            return Typed(F.col(x).cast(kind), kind)
        return Typed(F.lit(x).cast(kind), kind)

    return build


long, double, string = _make(LONG), _make(DOUBLE), _make(STRING)


def text(value: str | None) -> Typed:
    return Typed(F.lit(value).cast("string"), STRING)


def typed(x) -> Typed:
    if isinstance(x, Typed):
        return x
    if isinstance(x, bool):
        return long(int(x))
    if isinstance(x, int):
        return long(x)
    if isinstance(x, float):
        return double(x)
    return text(x)


def same_kind(*values: Typed) -> list[Typed]:
    """The values in their common type: text if one is text, else double if one is, else long."""
    kinds = {v.kind for v in values}
    if len(kinds) == 1:
        return list(values)
    if STRING in kinds:
        return [v.as_string() for v in values]
    return [v if v.kind == DOUBLE else Typed(v.col.cast("double"), DOUBLE) for v in values]


# functions of one number --------------------------------------------------------------------


def _log(fn):
    return lambda x: F.when(x > 0, fn(x)).when(x == 0, _inf(-1)).otherwise(_nan())


def _inside(fn, ok):
    return lambda x: F.when(ok(x), fn(x)).otherwise(_nan())


UNARY = {
    "acos": _inside(F.acos, lambda x: F.abs(x) <= 1),
    "asin": _inside(F.asin, lambda x: F.abs(x) <= 1),
    "atan": F.atan,
    "cbrt": F.cbrt,
    "cos": F.cos,
    "cosh": F.cosh,
    "exp": F.exp,
    "expm1": F.expm1,
    "log": _log(F.log),
    "log10": _log(F.log10),
    "log1p": lambda x: F.when(x > -1, F.log1p(x)).when(x == -1, _inf(-1)).otherwise(_nan()),
    "rint": F.rint,
    "signum": F.signum,
    "sin": F.sin,
    "sinh": F.sinh,
    "sqrt": _inside(F.sqrt, lambda x: x >= 0),
    "tan": F.tan,
    "tanh": F.tanh,
    "toDegrees": F.degrees,
    "toRadians": F.radians,
    # whole results stay doubles and keep values beyond the long range
    "ceil": lambda x: F.when(F.abs(x) < 2.0**53, F.ceil(x).cast("double")).otherwise(x),
    "floor": lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x),
}


def fn(name: str, x) -> Typed:
    """A function of one number; text input gives null."""
    x = typed(x)
    if x.kind == STRING:
        return Typed(F.lit(None).cast("double"), DOUBLE)
    if name == "abs":
        return Typed(F.abs(x._zeroed()), x.kind)
    if name == "round":  # half up, to long
        v = x.as_double()._zeroed()
        return Typed(F.floor(v) + F.when(v - F.floor(v) >= 0.5, 1).otherwise(0), LONG)
    return Typed(UNARY[name](x.as_double()._zeroed()), DOUBLE)


# functions of two numbers -------------------------------------------------------------------


def fn2(name: str, x, y) -> Typed:
    """``atan2 hypot remainder max min pow div copySign scalb`` of two numbers."""
    x, y = typed(x), typed(y)
    if name in ("max", "min"):
        pick = F.greatest if name == "max" else F.least
        return x._both(y, pick, pick)
    if name == "div":
        a, b = x.as_long()._zeroed(), y.as_long()._zeroed()
        return Typed(F.call_function("div", a, b), LONG)
    a, b = x.as_double()._zeroed(), y.as_double()._zeroed()
    out = {
        "atan2": lambda: F.atan2(a, b),
        "hypot": lambda: F.hypot(a, b),
        "pow": lambda: F.pow(a, b),
        # distance to the nearest multiple, ties to even
        "remainder": lambda: F.when(b != 0, a - b * F.rint(a / F.when(b != 0, b))).otherwise(_nan()),
        "copySign": lambda: F.abs(a) * F.when(b < 0, -1.0).otherwise(1.0),
        "scalb": lambda: a * F.pow(F.lit(2.0), b),
        "nextAfter": lambda: next_after(a, b),
    }[name]()
    return Typed(out, DOUBLE)


@pandas_udf(T.DoubleType())
def next_after(x: pd.Series, toward: pd.Series) -> pd.Series:
    return pd.Series(np.nextafter(x.to_numpy(), toward.to_numpy()))


@pandas_udf(T.DoubleType())
def next_up(x: pd.Series) -> pd.Series:
    return pd.Series(np.nextafter(x.to_numpy(), np.inf))


@pandas_udf(T.DoubleType())
def ulp(x: pd.Series) -> pd.Series:
    return pd.Series(np.abs(np.spacing(np.abs(x.to_numpy()))))


@pandas_udf(T.LongType())
def get_exponent(x: pd.Series) -> pd.Series:
    v = x.to_numpy()
    e = np.frexp(v)[1].astype("int64") - 1
    e = np.where((v == 0) | (e < -1022), -1023, e)
    return pd.Series(np.where(np.isfinite(v), e, 1024))


def fn_bits(name: str, x) -> Typed:
    """``ulp nextUp getExponent``: no built-in has the bits, so these go through Arrow batches."""
    x = typed(x).as_double()._zeroed()
    if name == "getExponent":
        return Typed(get_exponent(x), LONG)
    return Typed({"ulp": ulp, "nextUp": next_up}[name](x), DOUBLE)


# choice ---------------------------------------------------------------------------------------


def if_(cond, then, other) -> Typed:
    then, other = same_kind(typed(then), typed(other))
    return Typed(F.when(typed(cond).truth(), then.col).otherwise(other.col), then.kind)


def case_searched(*args) -> Typed:
    """``c1, r1, c2, r2, …`` with an optional last value."""
    args = [typed(a) for a in args]
    pairs, last = args[: len(args) // 2 * 2], args[len(args) // 2 * 2 :]
    values = same_kind(*pairs[1::2], *last)
    out = F
    for cond, value in zip(pairs[::2], values):
        out = out.when(cond.truth(), value.col)
    return Typed(out.otherwise(values[-1].col) if last else out, values[0].kind)


def case_simple(x, *args) -> Typed:
    """``x, v1, r1, v2, r2, …`` with an optional last value."""
    x = typed(x)
    swapped = []
    pairs = len(args) // 2 * 2
    for v, r in zip(args[:pairs:2], args[1:pairs:2]):
        swapped += [x.equals(v), r]
    return case_searched(*swapped, *args[pairs:])


def cast(x, kind: str) -> Typed:
    x = typed(x)
    return {"LONG": x.as_long, "DOUBLE": x.as_double, "STRING": x.as_string}[kind.upper()]()


def nvl(x, y) -> Typed:
    x, y = typed(x), typed(y)
    c = empty_to_null(x.col) if x.kind == STRING else x.col
    return Typed(F.coalesce(c, y.col), x.kind)


# time -----------------------------------------------------------------------------------------


def timestamp(x, fmt: str | None = None) -> Typed:
    """ISO or patterned text → epoch milliseconds."""
    c = typed(x).col
    return Typed(F.unix_millis(F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)), LONG)


def unix_timestamp(x, fmt: str | None = None) -> Typed:
    c = typed(x).col
    return Typed(F.unix_seconds(F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)), LONG)


# text -----------------------------------------------------------------------------------------


def concat(*xs) -> Typed:
    return Typed(empty_to_null(F.concat_ws("", *[typed(x).as_string().col for x in xs])), STRING)


def strlen(x) -> Typed:
    return Typed(F.coalesce(F.length(typed(x).as_string().col), F.lit(0)).cast("long"), LONG)


def strpos(haystack, needle) -> Typed:
    a, b = null_to_empty(typed(haystack).as_string().col), null_to_empty(typed(needle).as_string().col)
    return Typed((F.position(b, a) - 1).cast("long"), LONG)


def substring(x, index: int, length: int) -> Typed:
    """0-based; a negative length takes the rest; past the end gives null."""
    c = typed(x).as_string().col
    cut = F.substring(c, index + 1, length if length >= 0 else 2147483647)
    return Typed(F.when(F.length(c) > index, empty_to_null(cut)), STRING)


def replace(x, pattern, replacement) -> Typed:
    a, p, r = (null_to_empty(typed(v).as_string().col) for v in (x, pattern, replacement))
    return Typed(empty_to_null(F.replace(a, p, r)), STRING)


def lower(x) -> Typed:
    return Typed(empty_to_null(F.lower(typed(x).as_string().col)), STRING)


def upper(x) -> Typed:
    return Typed(empty_to_null(F.upper(typed(x).as_string().col)), STRING)


# multi-value ------------------------------------------------------------------------------------


def single_value(c: Column) -> Typed:
    """A row with one value reads as that value, any other row as null."""
    return Typed(F.when(F.size(c) == 1, F.element_at(c, 1)), STRING)


class Macros:
    """User functions by name, checked for duplicates like built-in ones."""

    def __init__(self):
        self._fns: dict[str, Callable[..., Typed]] = {}

    def add(self, name: str, function: Callable[..., Typed]) -> None:
        if name.lower() in self._fns:
            raise ValueError(f"function {name} is already defined")
        self._fns[name.lower()] = function

    def call(self, name: str, *args) -> Typed:
        return self._fns[name.lower()](*args)
