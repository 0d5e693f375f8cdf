"""Post-aggregators over grouped rows."""

from pyspark.sql import functions as F

from tallyspan.operators import aggregate as a
from tallyspan.operators import postagg as p
from tallyspan.plans.registry import query

c = F.col

# one grouped table serves these queries: lines per ship mode flags, with a sum that can be zero
GROUPS = """g AS (SELECT l_suppkey, count(*)::BIGINT AS n, sum(trunc(l_quantity))::BIGINT AS qty,
  sum(CASE WHEN l_returnflag = 'R' AND l_linenumber > 6 THEN l_linenumber ELSE 0 END)::BIGINT AS late,
  round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1)"""


def _groups(t):
    late = F.when((c("l_returnflag") == "R") & (c("l_linenumber") > 6), c("l_linenumber"))
    aggs = [
        a.count("n"),
        a.long_sum("qty", c("l_quantity").cast("long")),
        a.long_sum("late", late),
        a.double_sum("price", c("l_extendedprice")),
    ]
    out = t.lineitem.groupBy("l_suppkey").agg(*[x.partial.alias(x.name) for x in aggs])
    return out.withColumn("price", F.round("price", 2))


@query(
    "post_arithmetic",
    f"""
    WITH {GROUPS}
    SELECT l_suppkey, n::DOUBLE + qty + late AS plus, qty::DOUBLE - n AS minus, n::DOUBLE * qty AS times,
      CASE WHEN n = 0 THEN 0 ELSE price / n END AS mean, CASE WHEN late = 0 THEN 0.0 ELSE price / late END AS per_late
    FROM g
    """,
)
def post_arithmetic(t):
    return _groups(t).select(
        "l_suppkey",
        p.arithmetic("+", [c("n"), c("qty"), c("late")]).alias("plus"),
        p.arithmetic("-", [c("qty"), c("n")]).alias("minus"),
        p.arithmetic("*", [c("n"), c("qty")]).alias("times"),
        p.arithmetic("/", [c("price"), c("n")]).alias("mean"),
        p.arithmetic("/", [c("price"), c("late")]).alias("per_late"),
    )


@query(
    "post_quotient",
    f"""
    WITH {GROUPS}, h AS (SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN 0.0 WHEN l_suppkey % 3 = 1 THEN price ELSE -price END AS x,
      CASE WHEN l_suppkey % 2 = 0 THEN 0.0 ELSE n END AS y FROM g)
    SELECT l_suppkey, CASE WHEN y <> 0 THEN x / y WHEN x > 0 THEN 'infinity'::DOUBLE WHEN x < 0 THEN '-infinity'::DOUBLE ELSE 'nan'::DOUBLE END AS q FROM h
    """,
)
def post_quotient(t):
    x = F.when(c("l_suppkey") % 3 == 0, 0.0).when(c("l_suppkey") % 3 == 1, c("price")).otherwise(-c("price"))
    y = F.when(c("l_suppkey") % 2 == 0, 0.0).otherwise(c("n"))
    return _groups(t).select("l_suppkey", p.arithmetic("quotient", [x, y]).alias("q"))


@query("post_constant", f"WITH {GROUPS} SELECT l_suppkey, n, 12.5::DOUBLE AS k FROM g")
def post_constant(t):
    return _groups(t).select("l_suppkey", "n", p.constant(12.5).alias("k"))


def _event_aggregators():
    return [
        a.count("n"),
        a.double_last("last", c("value"), "ts", "event_id", state=True),
        a.hyper_unique("users", c("user_id")),
    ]


def _event_states(t):
    return t.events.groupBy("event_type").agg(*[x.partial.alias(x.name) for x in _event_aggregators()])


@query(
    "post_field_access",
    "SELECT event_type, count(*)::BIGINT AS n, max(ts) AS last_ts, arg_max(value, (ts, event_id)) AS last_value FROM events GROUP BY 1",
)
def post_field_access(t):
    state = p.field_access("last")
    return _event_states(t).select(
        "event_type", p.field_access("n").alias("n"), state["ts"].alias("last_ts"), state["value"].alias("last_value")
    )


@query(
    "post_finalizing_access",
    "SELECT event_type, count(*)::BIGINT AS n, arg_max(value, (ts, event_id)) AS last_value, true AS close FROM events GROUP BY 1",
)
def post_finalizing_access(t):
    count, last, users = _event_aggregators()
    # the number of users is bounded by the number of rows, and by the sketch error
    exact = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    out = _event_states(t).join(exact, "event_type")
    return out.select(
        "event_type",
        p.finalizing_access(count).alias("n"),
        p.finalizing_access(last).alias("last_value"),
        (F.abs(p.finalizing_access(users) - c("exact")) <= c("exact") * 0.05).alias("close"),
    )


@query(
    "post_double_greatest",
    f"WITH {GROUPS} SELECT l_suppkey, greatest(n * 1500.0::DOUBLE, price / 25, qty::DOUBLE) AS v FROM g",
)
def post_double_greatest(t):
    return _groups(t).select("l_suppkey", p.double_greatest([c("n") * 1500.0, c("price") / 25, c("qty")]).alias("v"))


@query(
    "post_double_least",
    f"WITH {GROUPS} SELECT l_suppkey, least(n * 1500.0::DOUBLE, price / 25, qty * 60.5::DOUBLE) AS v FROM g",
)
def post_double_least(t):
    return _groups(t).select("l_suppkey", p.double_least([c("n") * 1500.0, c("price") / 25, c("qty") * 60.5]).alias("v"))


@query("post_long_greatest", f"WITH {GROUPS} SELECT l_suppkey, greatest(n, trunc(price / 50000)::BIGINT, late) AS v FROM g")
def post_long_greatest(t):
    return _groups(t).select("l_suppkey", p.long_greatest([c("n"), c("price") / 50000, c("late")]).alias("v"))


@query("post_long_least", f"WITH {GROUPS} SELECT l_suppkey, least(n, trunc(price / 50000)::BIGINT, late * 5) AS v FROM g")
def post_long_least(t):
    return _groups(t).select("l_suppkey", p.long_least([c("n"), c("price") / 50000, c("late") * 5]).alias("v"))


@query(
    "post_expression",
    f"WITH {GROUPS} SELECT l_suppkey, (price - n * 100) / (qty + 1) AS v FROM g ORDER BY v, l_suppkey",
)
def post_expression(t):
    from tallyspan.functions.expr import double, long

    v = (double("price") - long("n") * long(100)) / (long("qty") + long(1)).as_double()
    return _groups(t).select("l_suppkey", v.col.alias("v")).orderBy("v", "l_suppkey")


@query(
    "post_hyper_unique",
    "SELECT event_type, count(DISTINCT user_id)::BIGINT AS exact, true AS close FROM events GROUP BY 1",
)
def post_hyper_unique(t):
    exact = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    est = p.hyper_unique_cardinality("users")
    return _event_states(t).join(exact, "event_type").select(
        "event_type", "exact", (F.abs(est - c("exact")) <= c("exact") * 0.05).alias("close")
    )


@query(
    "post_validate",
    "SELECT event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total, round(sum(value), 4) / count(*) AS mean FROM events GROUP BY 1",
)
def post_validate(t):
    aggs = [a.count("n"), a.double_sum("total", c("value"))]
    p.validate(aggs, {"mean": ["total", "n"]}, ["event_type"])
    out = t.events.groupBy("event_type").agg(*[x.partial.alias(x.name) for x in aggs]).withColumn("total", F.round("total", 4))
    return out.withColumn("mean", p.arithmetic("/", [c("total"), c("n")]))
