"""One query per aggregator."""

import pandas as pd
from pyspark.sql import functions as F

from tallyspan.operators import aggregate as a
from tallyspan.operators.scripted import scripted_aggregate
from tallyspan.plans.registry import query

c = F.col


def _agg(df, keys, *aggs):
    states = df.groupBy(*keys).agg(*[x.partial.alias(x.name) for x in aggs])
    return states.withColumns({x.name: x.final() for x in aggs})


@query("agg_count", "SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1")
def agg_count(t):
    return _agg(t.events, ["event_type"], a.count("n"))


@query(
    "agg_long_sum",
    """
    SELECT l_returnflag, sum(CASE WHEN l_linenumber = 3 THEN 0 ELSE l_linenumber END)::BIGINT AS s,
      sum(trunc(l_quantity)::BIGINT * 2)::BIGINT AS twice
    FROM lineitem GROUP BY 1
    """,
)
def agg_long_sum(t):
    some = F.when(c("l_linenumber") != 3, c("l_linenumber"))
    return _agg(t.lineitem, ["l_returnflag"], a.long_sum("s", some), a.long_sum("twice", c("l_quantity").cast("long") * 2))


@query("agg_double_sum", "SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 4) AS s FROM lineitem GROUP BY 1, 2")
def agg_double_sum(t):
    out = _agg(t.lineitem, ["l_returnflag", "l_linestatus"], a.double_sum("s", c("l_extendedprice")))
    return out.withColumn("s", F.round("s", 4))


@query(
    "agg_float_sum",
    "SELECT l_returnflag, round(sum(l_quantity::FLOAT::DOUBLE)::FLOAT::DOUBLE, 2) AS s FROM lineitem GROUP BY 1",
)
def agg_float_sum(t):
    out = _agg(t.lineitem, ["l_returnflag"], a.float_sum("s", c("l_quantity")))
    return out.withColumn("s", F.round(c("s").cast("double"), 2))


def _extreme_query(key, kind, fold, table, group, column, empty, sql_type):
    """The same shape for every minimum and maximum: whole groups, and one group column of nulls only."""
    make = getattr(a, f"{kind}_{fold}")
    shown = "double" if kind == "float" else kind
    out_sql = "BIGINT" if kind == "long" else "DOUBLE"
    sql = f"""
    SELECT {group}, {fold}({column}::{sql_type})::{out_sql} AS v, {empty}::{out_sql} AS over_nulls
    FROM {table} GROUP BY 1
    """

    @query(key, sql)
    def run(t):
        out = _agg(getattr(t, table), [group], make("v", c(column)), make("over_nulls", F.lit(None)))
        if fold == "min" or fold == "max":
            out = out.withColumns({n: c(n).cast(shown) for n in ("v", "over_nulls")})
        return out

    return run


# the identity takes part in the fold, so a null never beats a value
agg_long_min = _extreme_query("agg_long_min", "long", "min", "orders", "o_orderstatus", "o_custkey", "9223372036854775807", "BIGINT")
agg_long_max = _extreme_query("agg_long_max", "long", "max", "orders", "o_orderstatus", "o_custkey", "(-9223372036854775808)", "BIGINT")
agg_double_min = _extreme_query("agg_double_min", "double", "min", "lineitem", "l_returnflag", "l_extendedprice", "'infinity'", "DOUBLE")
agg_double_max = _extreme_query("agg_double_max", "double", "max", "lineitem", "l_returnflag", "l_extendedprice", "'-infinity'", "DOUBLE")
agg_float_min = _extreme_query("agg_float_min", "float", "min", "lineitem", "l_returnflag", "l_discount", "'infinity'", "FLOAT")
agg_float_max = _extreme_query("agg_float_max", "float", "max", "lineitem", "l_returnflag", "l_discount", "'-infinity'", "FLOAT")


@query(
    "agg_expression",
    """
    SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 3) AS revenue,
      max(l_linenumber * 10 + 1)::BIGINT AS top, min(l_quantity / 2) AS low
    FROM lineitem GROUP BY 1
    """,
)
def agg_expression(t):
    out = _agg(
        t.lineitem,
        ["l_returnflag"],
        a.double_sum("revenue", c("l_extendedprice") * (1 - c("l_discount"))),
        a.long_max("top", c("l_linenumber") * 10 + 1),
        a.double_min("low", c("l_quantity") / 2),
    )
    return out.withColumn("revenue", F.round("revenue", 3))


def _edge_query(kind, side, sql_type):
    make = getattr(a, f"{kind}_{side}")
    fn = "arg_min" if side == "first" else "arg_max"
    shown, shown_sql = ("bigint", "BIGINT") if kind == "long" else ("double", "DOUBLE")
    value = "user_id" if kind == "long" else "value"

    @query(
        f"agg_{kind}_{side}",
        f"SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, {fn}({value}, (ts, event_id))::{sql_type}::{shown_sql} AS v FROM events GROUP BY 1, 2",
    )
    def run(t):
        rows = t.events.withColumn("day", F.date_trunc("day", "ts"))
        out = _agg(rows, ["event_type", "day"], make("v", c(value), "ts", "event_id"))
        return out.withColumn("v", c("v").cast(shown))

    return run


for _kind, _type in (("long", "BIGINT"), ("double", "DOUBLE"), ("float", "FLOAT")):
    for _side in ("first", "last"):
        _edge_query(_kind, _side, _type)


@query(
    "agg_filtered",
    """
    SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT AS n_f,
      round(coalesce(sum(o_totalprice) FILTER (WHERE o_totalprice > 200000), 0), 2) AS big,
      max(o_custkey) FILTER (WHERE o_orderstatus = 'P')::BIGINT AS top_p,
      count(*) FILTER (WHERE o_orderstatus = 'F' AND o_custkey % 2 = 0)::BIGINT AS n_nested
    FROM orders GROUP BY 1
    """,
)
def agg_filtered(t):
    out = _agg(
        t.orders,
        ["o_orderpriority"],
        a.filtered(a.count("n_f"), c("o_orderstatus") == "F"),
        a.filtered(a.double_sum("big", c("o_totalprice")), c("o_totalprice") > 200000),
        a.filtered(a.long_max("top_p", c("o_custkey")), c("o_orderstatus") == "P"),
        a.filtered(a.filtered(a.count("n_nested"), c("o_orderstatus") == "F"), c("o_custkey") % 2 == 0),
    )
    return out.withColumn("big", F.round("big", 2))


def _close(estimate, exact):
    """Within four standard errors of a sketch of 2^11 registers (1.04 / sqrt(2048) each), or one value."""
    return F.abs(estimate - exact) <= F.greatest(exact * 0.092, F.lit(1.0))


@query(
    "agg_cardinality_row",
    """
    SELECT o_orderstatus, count(DISTINCT (o_custkey, coalesce(nullif(o_orderpriority, '5-LOW'), '')))::BIGINT AS exact, true AS close
    FROM orders GROUP BY 1
    UNION ALL SELECT lang, count(DISTINCT list_sort(regexp_split_to_array(text, '[ \\n]+')[1:2]))::BIGINT, true FROM documents GROUP BY 1
    """,
)
def agg_cardinality_row(t):
    rows = t.orders.withColumn("prio", F.when(c("o_orderpriority") != "5-LOW", c("o_orderpriority")))
    fields = [c("o_custkey"), c("prio")]
    states = rows.groupBy("o_orderstatus").agg(
        a.cardinality_by_row("estimate", fields).partial.alias("estimate"),
        F.count_distinct(F.struct(*fields)).alias("exact"),
    )
    # the first two words of a text, in any order
    texts = t.documents.select("lang", F.slice(F.split("text", "[ \\n]+"), 1, 2).alias("words"))
    listed = texts.groupBy(c("lang").alias("o_orderstatus")).agg(
        a.cardinality_by_row("estimate", [a.list_text(c("words"))]).partial.alias("estimate"), F.count_distinct(F.array_sort("words")).alias("exact")
    )
    return states.unionByName(listed).select("o_orderstatus", "exact", _close(F.hll_sketch_estimate("estimate"), c("exact")).alias("close"))


@query(
    "agg_cardinality_value",
    """
    SELECT p_size::VARCHAR AS p_size, count(DISTINCT v)::BIGINT AS exact, true AS close
    FROM (SELECT p_size, unnest([p_brand, p_type, p_name]) AS v FROM part) GROUP BY 1
    UNION ALL SELECT lang, count(DISTINCT v)::BIGINT, true
    FROM (SELECT lang, unnest(regexp_split_to_array(text, '[ \\n]+') || [source]) AS v FROM documents) GROUP BY 1
    """,
)
def agg_cardinality_value(t):
    names = ["p_brand", "p_type", "p_name"]
    n = a.cardinality_by_value("estimate", [c(x) for x in names])
    states = t.part.groupBy("p_size").agg(n.partial.alias(n.name))
    values = t.part.select("p_size", F.explode(F.array(*names)).alias("value"))
    exact = values.groupBy("p_size").agg(F.count_distinct("value").alias("exact"))
    scalars = states.join(exact, "p_size").select(c("p_size").cast("string").alias("p_size"), "exact", _close(n.final(), c("exact")).alias("close"))
    # every word of a text and its source, pooled
    texts = t.documents.select("lang", "source", F.split("text", "[ \\n]+").alias("words"))
    pooled = a.pooled_cardinality(texts, ["lang"], "estimate", ["source"], ["words"])
    words = texts.select("lang", F.explode(F.concat("words", F.array("source"))).alias("v")).groupBy("lang").agg(F.count_distinct("v").alias("exact"))
    lists = pooled.join(words, "lang").select(c("lang").alias("p_size"), "exact", _close(c("estimate"), c("exact")).alias("close"))
    return scalars.unionByName(lists)


@query(
    "agg_hyper_unique",
    "SELECT event_type, count(DISTINCT user_id)::BIGINT AS exact, true AS close FROM events GROUP BY 1",
)
def agg_hyper_unique(t):
    # sketches per day first, then their union per type: the form in which stored rollups are merged
    users = a.hyper_unique("users", c("user_id"))
    days = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(users.partial.alias("users"))
    merged = days.groupBy("event_type").agg(users.combine(c("users")).alias("users"))
    exact = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    return merged.join(exact, "event_type").select("event_type", "exact", _close(users.final(), c("exact")).alias("close"))


BREAKS = [5.0, 10.0, 20.0, 40.0]


@query(
    "agg_histogram",
    """
    SELECT l_returnflag, '5.0,10.0,20.0,40.0' AS breaks,
      concat_ws(',', (count(*) FILTER (WHERE l_quantity > 5 AND l_quantity <= 10))::DOUBLE,
                (count(*) FILTER (WHERE l_quantity > 10 AND l_quantity <= 20))::DOUBLE,
                (count(*) FILTER (WHERE l_quantity > 20 AND l_quantity <= 40))::DOUBLE) AS counts,
      min(l_quantity) AS low, max(l_quantity) AS high
    FROM lineitem GROUP BY 1
    """,
)
def agg_histogram(t):
    out = _agg(t.lineitem, ["l_returnflag"], a.histogram("h", c("l_quantity"), BREAKS))
    return out.select(
        "l_returnflag",
        F.array_join(c("h.breaks").cast("array<string>"), ",").alias("breaks"),
        F.array_join(c("h.counts").cast("array<string>"), ",").alias("counts"),
        c("h.quantiles")[0].alias("low"),
        c("h.quantiles")[1].alias("high"),
    )


@query(
    "agg_scripted",
    """
    SELECT l_returnflag, l_linestatus, 10.0::DOUBLE + sum(l_linenumber * l_quantity) AS score FROM lineitem GROUP BY 1, 2
    """,
)
def agg_scripted(t):
    def fold(state: float, rows: pd.DataFrame) -> float:
        return state + float((rows["l_linenumber"] * rows["l_quantity"]).sum())

    def combine(x: float, y: float) -> float:
        return x + y

    out = scripted_aggregate(
        t.lineitem, ["l_returnflag", "l_linestatus"], ["l_linenumber", "l_quantity"], "score", lambda: 0.0, fold, combine
    )
    return out.withColumn("score", c("score") + 10.0)
