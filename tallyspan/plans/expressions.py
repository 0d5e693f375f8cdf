"""Expression columns over whole tables."""

from pyspark.sql import functions as F

from tallyspan.functions import expr as e
from tallyspan.plans.registry import query

c = F.col
LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
LINE_SQL = ", ".join(LINE)


def _lines(t, **cols):
    return t.lineitem.select(*LINE, *[x.col.alias(n) for n, x in cols.items()])


@query(
    "expr_arith",
    f"""
    SELECT {LINE_SQL}, l_orderkey + l_linenumber AS plus, l_orderkey - l_partkey AS minus, l_partkey * l_linenumber AS times,
      l_partkey // l_linenumber AS whole, l_partkey % l_linenumber AS rest, (l_linenumber::BIGINT * l_linenumber)::BIGINT AS squared,
      l_extendedprice / l_quantity AS per_unit, l_quantity + l_linenumber AS mixed, -l_quantity AS negated
    FROM lineitem
    """,
)
def expr_arith(t):
    ok, pk, ln, q, x = e.long("l_orderkey"), e.long("l_partkey"), e.long("l_linenumber"), e.double("l_quantity"), e.double("l_extendedprice")
    return _lines(
        t, plus=ok + ln, minus=ok - pk, times=pk * ln, whole=pk / ln, rest=pk % ln, squared=ln**2,
        per_unit=x / q, mixed=q + ln, negated=-q,
    )


@query(
    "expr_string_plus",
    """
    SELECT c_custkey, c_name || c_mktsegment AS both_given, CASE WHEN c_custkey % 7 = 0 THEN c_name ELSE c_name || c_mktsegment END AS one_null,
      NULL::VARCHAR AS both_null
    FROM customer
    """,
)
def expr_string_plus(t):
    some = F.when(c("c_custkey") % 7 != 0, c("c_mktsegment"))
    return t.customer.select(
        "c_custkey",
        (e.string("c_name") + e.string("c_mktsegment")).col.alias("both_given"),
        (e.string("c_name") + e.string(some)).col.alias("one_null"),
        (e.text(None) + e.text("")).col.alias("both_null"),
    )


@query(
    "expr_compare",
    f"""
    SELECT {LINE_SQL}, (l_linenumber < 4)::BIGINT AS lt, (l_quantity >= 25)::INTEGER::DOUBLE AS ge, (l_orderkey = l_partkey)::BIGINT AS eq,
      (l_returnflag <> 'R')::BIGINT AS ne, (l_returnflag > 'N')::BIGINT AS gt_text,
      (l_linenumber = 3)::BIGINT AS null_first
    FROM lineitem
    """,
)
def expr_compare(t):
    flag = e.string("l_returnflag")
    # a null text is below every other text
    some = e.string(F.when(c("l_linenumber") != 3, c("l_returnflag")))
    return _lines(
        t, lt=e.long("l_linenumber") < 4, ge=e.double("l_quantity") >= 25.0, eq=e.long("l_orderkey").equals(e.long("l_partkey")),
        ne=flag.differs("R"), gt_text=flag > "N", null_first=some < "",
    )


@query(
    "expr_logic",
    f"""
    SELECT {LINE_SQL}, CASE WHEN l_linenumber - 3 > 0 THEN l_partkey ELSE l_linenumber::BIGINT - 3 END AS and_value,
      CASE WHEN l_linenumber - 3 > 0 THEN l_linenumber::BIGINT - 3 ELSE l_partkey END AS or_value,
      (l_linenumber <= 3)::BIGINT AS not_value
    FROM lineitem
    """,
)
def expr_logic(t):
    x = e.long("l_linenumber") - 3
    return _lines(t, and_value=x.and_(e.long("l_partkey")), or_value=x.or_(e.long("l_partkey")), not_value=x.not_())


@query(
    "expr_null_mixed",
    f"""
    WITH x AS (SELECT *, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END AS q,
      CASE WHEN l_linenumber = 5 THEN 'n/a' ELSE l_partkey::VARCHAR END AS s FROM lineitem)
    SELECT {LINE_SQL}, coalesce(q, 0) + l_linenumber AS with_null, coalesce(TRY_CAST(s AS DOUBLE), 0) * 2 AS with_text,
      coalesce(q, 0) - l_extendedprice AS minus_null
    FROM x
    """,
)
def expr_null_mixed(t):
    q = e.double(F.when(c("l_linenumber") != 2, c("l_quantity")))
    s = e.string(F.when(c("l_linenumber") == 5, "n/a").otherwise(c("l_partkey").cast("string")))
    return _lines(t, with_null=q + e.long("l_linenumber"), with_text=s * 2, minus_null=q - e.double("l_extendedprice"))


def _nine(v):
    """Nine decimal places: the last bits of these functions differ between math libraries."""
    return F.floor(v * 1e9 + 0.5) / 1e9


UNARY = ["acos", "asin", "atan", "cbrt", "cos", "cosh", "exp", "expm1", "log", "log10", "log1p", "sin", "sinh", "sqrt", "tan", "tanh", "toDegrees", "toRadians"]


@query(
    "expr_math_unary",
    f"""
    WITH x AS (SELECT *, l_discount - 0.05 AS d, CASE WHEN l_linenumber > 3 THEN l_quantity / 25 - 1 ELSE l_tax END AS u FROM lineitem)
    SELECT {LINE_SQL}, abs(l_linenumber::BIGINT - 4) AS v_abs, abs(d) AS v_abs_double, floor((acos(greatest(least(u, 1), -1))) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_acos,
      floor((asin(greatest(least(u, 1), -1))) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_asin, floor((atan(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_atan, floor((cbrt(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_cbrt, floor((cos(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_cos,
      floor((cosh(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_cosh, floor((exp(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_exp, floor((exp(u) - 1) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_expm1,
      CASE WHEN u > 0 THEN floor((ln(greatest(u, 1e-300))) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE WHEN u = 0 THEN '-infinity'::DOUBLE ELSE 'nan'::DOUBLE END AS v_log,
      CASE WHEN u > 0 THEN floor((log10(greatest(u, 1e-300))) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE WHEN u = 0 THEN '-infinity'::DOUBLE ELSE 'nan'::DOUBLE END AS v_log10,
      floor((ln(1 + u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_log1p, floor((sin(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_sin, floor((sinh(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_sinh,
      CASE WHEN u >= 0 THEN floor((sqrt(greatest(u, 0))) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE ELSE 'nan'::DOUBLE END AS v_sqrt, floor((tan(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_tan,
      floor((tanh(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS "v_tanh", floor((degrees(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS "v_toDegrees", floor((radians(u)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS "v_toRadians",
      ceil(l_extendedprice / 7) AS v_ceil, floor(l_extendedprice / 7) AS v_floor, sign(l_linenumber - 4)::DOUBLE AS v_signum,
      NULL::DOUBLE AS v_text
    FROM x
    """,
)
def expr_math_unary(t):
    u = F.when(c("l_linenumber") > 3, c("l_quantity") / 25 - 1).otherwise(c("l_tax"))
    x = {"u": e.double(u)}
    bounded = e.double(F.greatest(F.least(u, F.lit(1)), F.lit(-1)))
    shown = {}
    for name in UNARY:
        v = e.fn(name, bounded if name in ("acos", "asin") else x["u"])
        r = F.when(F.isnan(v.col) | (F.abs(v.col) == float("inf")), v.col).otherwise(_nine(v.col))
        shown[f"v_{name}"] = e.Typed(r, e.DOUBLE)
    seventh = e.double("l_extendedprice") / 7.0
    return _lines(
        t, v_abs=e.fn("abs", e.long("l_linenumber") - 4), v_abs_double=e.fn("abs", e.double("l_discount") - 0.05), **shown,
        v_ceil=e.fn("ceil", seventh), v_floor=e.fn("floor", seventh), v_signum=e.fn("signum", e.long("l_linenumber") - 4),
        v_text=e.fn("sqrt", e.text("4")),
    )


@query(
    "expr_round",
    f"SELECT {LINE_SQL}, floor(l_extendedprice / 8 + 0.5)::BIGINT AS rounded, round_even(l_quantity / 2, 0) AS even FROM lineitem",
)
def expr_round(t):
    return _lines(t, rounded=e.fn("round", e.double("l_extendedprice") / 8.0), even=e.fn("rint", e.double("l_quantity") / 2.0))


@query(
    "expr_math_binary",
    f"""
    SELECT {LINE_SQL}, floor((atan2(l_quantity, l_linenumber)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_atan2, floor((sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber)) * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS v_hypot,
      l_extendedprice - l_quantity * round_even(l_extendedprice / l_quantity, 0) AS v_remainder,
      greatest(l_partkey, l_suppkey) AS v_max, least(l_quantity, l_linenumber::DOUBLE) AS v_min, power(l_quantity, 2) AS v_pow,
      (trunc(l_extendedprice)::BIGINT // trunc(l_quantity)::BIGINT) AS v_div
    FROM lineitem
    """,
)
def expr_math_binary(t):
    q, ln, x = e.double("l_quantity"), e.long("l_linenumber"), e.double("l_extendedprice")
    rounded = lambda v: e.Typed(_nine(v.col), e.DOUBLE)
    return _lines(
        t, v_atan2=rounded(e.fn2("atan2", q, ln)), v_hypot=rounded(e.fn2("hypot", q, ln)), v_remainder=e.fn2("remainder", x, q),
        v_max=e.fn2("max", e.long("l_partkey"), e.long("l_suppkey")), v_min=e.fn2("min", q, ln), v_pow=e.fn2("pow", q, 2),
        v_div=e.fn2("div", x, q),
    )


@query(
    "expr_float_bits",
    f"""
    WITH x AS (SELECT *, power(2, floor(log2(l_quantity)) - 52) AS u FROM lineitem)
    SELECT {LINE_SQL}, CASE WHEN l_linenumber < 4 THEN -l_quantity ELSE l_quantity END AS v_copysign, floor(log2(l_quantity))::BIGINT AS v_exponent,
      nextafter(l_quantity, 0::DOUBLE) AS v_nextafter, l_quantity + u AS v_nextup, l_quantity * power(2, l_linenumber) AS v_scalb, u AS v_ulp
    FROM x
    """,
)
def expr_float_bits(t):
    q = e.double("l_quantity")
    return _lines(
        t, v_copysign=e.fn2("copySign", q, e.long("l_linenumber") - 3.5), v_exponent=e.fn_bits("getExponent", q),
        v_nextafter=e.fn2("nextAfter", q, 0.0), v_nextup=e.fn_bits("nextUp", q), v_scalb=e.fn2("scalb", q, e.long("l_linenumber")),
        v_ulp=e.fn_bits("ulp", q),
    )


@query(
    "expr_if",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'big' ELSE 'small' END AS size_text, CASE WHEN o_custkey > 100 THEN o_custkey ELSE 0 END AS v FROM orders",
)
def expr_if(t):
    return t.orders.select(
        "o_orderkey",
        e.if_(e.double("o_totalprice") > 200000.0, "big", "small").col.alias("size_text"),
        e.if_(e.long("o_custkey") > 100, e.long("o_custkey"), 0).col.alias("v"),
    )


@query(
    "expr_case_searched",
    """
    SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'low' END AS band,
      CASE WHEN o_orderstatus = 'F' THEN 1::BIGINT END AS no_else
    FROM orders
    """,
)
def expr_case_searched(t):
    x = e.double("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        e.case_searched(x > 300000.0, "high", x > 100000.0, "middle", "low").col.alias("band"),
        e.case_searched(e.string("o_orderstatus").equals("F"), 1).col.alias("no_else"),
    )


@query(
    "expr_case_simple",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'other' END AS status FROM orders",
)
def expr_case_simple(t):
    status = e.case_simple(e.string("o_orderstatus"), "F", "filled", "O", "open", "other")
    return t.orders.select("o_orderkey", status.col.alias("status"))


@query(
    "expr_cast",
    f"""
    SELECT {LINE_SQL}, trunc(l_extendedprice)::BIGINT AS d2l, l_partkey::DOUBLE AS l2d, l_partkey::VARCHAR AS l2s, l_partkey AS s2l,
      0::BIGINT AS dotted, 0::DOUBLE AS bad, l_quantity AS s2d
    FROM lineitem
    """,
)
def expr_cast(t):
    quantity_text = e.string(c("l_quantity").cast("string"))
    return _lines(
        t, d2l=e.cast(e.double("l_extendedprice"), "LONG"), l2d=e.cast(e.long("l_partkey"), "DOUBLE"), l2s=e.cast(e.long("l_partkey"), "STRING"),
        s2l=e.cast(e.string("l_partkey"), "LONG"), dotted=e.cast(quantity_text, "LONG"), bad=e.cast(e.string("l_returnflag"), "DOUBLE"),
        s2d=e.cast(quantity_text, "DOUBLE"),
    )


@query(
    "expr_nvl",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN 'none' ELSE c_mktsegment END AS segment,
      CASE WHEN c_custkey % 7 = 0 THEN -1 ELSE c_acctbal END AS balance
    FROM customer
    """,
)
def expr_nvl(t):
    k = c("c_custkey")
    segment = F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, "").otherwise(c("c_mktsegment"))
    return t.customer.select(
        "c_custkey",
        e.nvl(e.string(segment), "none").col.alias("segment"),
        e.nvl(e.double(F.when(k % 7 != 0, c("c_acctbal"))), -1.0).col.alias("balance"),
    )


@query(
    "expr_timestamp",
    "SELECT o_orderkey, epoch_ms(o_orderdate) AS from_iso, epoch_ms(o_orderdate) AS from_pattern FROM orders",
)
def expr_timestamp(t):
    iso = e.string(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    pattern = e.string(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm"))
    return t.orders.select("o_orderkey", e.timestamp(iso).col.alias("from_iso"), e.timestamp(pattern, "dd/MM/yyyy HH:mm").col.alias("from_pattern"))


@query(
    "expr_unix_timestamp",
    "SELECT o_orderkey, (epoch_ms(o_orderdate) // 1000)::BIGINT AS seconds FROM orders",
)
def expr_unix_timestamp(t):
    iso = e.string(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", e.unix_timestamp(iso).col.alias("seconds"))


@query(
    "expr_concat",
    """
    SELECT c_custkey, concat(c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END, '-', c_custkey::VARCHAR) AS joined,
      NULL::VARCHAR AS nothing
    FROM customer
    """,
)
def expr_concat(t):
    some = e.string(F.when(c("c_custkey") % 7 != 0, c("c_mktsegment")))
    return t.customer.select(
        "c_custkey",
        e.concat(e.string("c_name"), some, "-", e.long("c_custkey")).col.alias("joined"),
        e.concat(e.text(None), e.text("")).col.alias("nothing"),
    )


NULL_NAME = "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN '' ELSE p_name END"


def _null_name():
    k = c("p_partkey")
    return e.string(F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, "").otherwise(c("p_name")))


@query("expr_strlen", f"SELECT p_partkey, coalesce(length({NULL_NAME}), 0)::BIGINT AS n FROM part")
def expr_strlen(t):
    return t.part.select("p_partkey", e.strlen(_null_name()).col.alias("n"))


@query(
    "expr_strpos",
    f"SELECT p_partkey, (instr(coalesce({NULL_NAME}, ''), 'i') - 1)::BIGINT AS p, (instr(p_name, 'ring') - 1)::BIGINT AS word FROM part",
)
def expr_strpos(t):
    return t.part.select("p_partkey", e.strpos(_null_name(), "i").col.alias("p"), e.strpos(e.string("p_name"), "ring").col.alias("word"))


@query(
    "expr_substring",
    """
    SELECT p_partkey, substr(p_name, 1, 3) AS head, nullif(substr(p_name, 3), '') AS rest,
      CASE WHEN length(p_name) > 9 THEN substr(p_name, 10, 2) END AS past, NULL::VARCHAR AS empty
    FROM part
    """,
)
def expr_substring(t):
    n = e.string("p_name")
    cuts = {"head": (0, 3), "rest": (2, -1), "past": (9, 2), "empty": (0, 0)}
    return t.part.select("p_partkey", *[e.substring(n, i, k).col.alias(a) for a, (i, k) in cuts.items()])


@query(
    "expr_replace",
    f"SELECT p_partkey, nullif(replace(coalesce({NULL_NAME}, ''), 'i', 'ii'), '') AS doubled, replace(p_name, ' ', '') AS joined FROM part",
)
def expr_replace(t):
    return t.part.select(
        "p_partkey", e.replace(_null_name(), "i", "ii").col.alias("doubled"), e.replace(e.string("p_name"), " ", None).col.alias("joined")
    )


@query("expr_lower", f"SELECT p_partkey, nullif(lower({NULL_NAME}), '') AS v, lower(p_type) AS kind FROM part")
def expr_lower(t):
    return t.part.select("p_partkey", e.lower(_null_name()).col.alias("v"), e.lower(e.string("p_type")).col.alias("kind"))


@query("expr_upper", f"SELECT p_partkey, nullif(upper({NULL_NAME}), '') AS v FROM part")
def expr_upper(t):
    return t.part.select("p_partkey", e.upper(_null_name()).col.alias("v"))


@query(
    "expr_macro",
    f"SELECT {LINE_SQL}, l_extendedprice * (1 - l_discount) AS net, l_quantity * 2 + 1 AS odd FROM lineitem",
)
def expr_macro(t):
    macros = e.Macros()
    macros.add("net", lambda price, cut: price * (e.double(1.0) - cut))
    macros.add("odd", lambda x: x * 2.0 + 1.0)
    return _lines(
        t, net=macros.call("NET", e.double("l_extendedprice"), e.double("l_discount")), odd=macros.call("odd", e.double("l_quantity"))
    )


@query(
    "expr_multivalue_null",
    """
    WITH w AS (SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 THEN [lang] WHEN doc_id % 3 = 1 THEN [lang, source] ELSE [] END AS v FROM documents)
    SELECT doc_id, CASE WHEN len(v) = 1 THEN v[1] END AS v, concat('x', CASE WHEN len(v) = 1 THEN v[1] END) AS tagged FROM w
    """,
)
def expr_multivalue_null(t):
    k = c("doc_id") % 3
    values = F.when(k == 0, F.array("lang")).when(k == 1, F.array("lang", "source")).otherwise(F.array().cast("array<string>"))
    v = e.single_value(values)
    return t.documents.select("doc_id", v.col.alias("v"), e.concat("x", v).col.alias("tagged"))
