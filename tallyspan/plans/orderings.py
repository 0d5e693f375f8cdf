"""Orderings: each query returns every row with its 0-based place in the order.

Places come from range-partitioned slices, so ordering a whole table is not one task's work.
"""

from pyspark.sql import functions as F

from tallyspan.functions import orderings as o
from tallyspan.operators.ordered import with_position
from tallyspan.plans.registry import query

c = F.col


def _placed(df, order, keep):
    return with_position(df, [], order, "place").select(*keep, "place")


PLACE = "(row_number() OVER (ORDER BY {}) - 1)::BIGINT AS place"


@query(
    "order_lexicographic",
    "WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS v FROM customer) SELECT c_custkey, v, "
    + PLACE.format("v NULLS FIRST, c_custkey") + " FROM r",
)
def order_lexicographic(t):
    r = t.customer.select("c_custkey", F.when(c("c_custkey") % 7 != 0, c("c_mktsegment")).alias("v"))
    return _placed(r, [o.lexicographic(c("v")), "c_custkey"], ["c_custkey", "v"])


@query(
    "order_strlen",
    "WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END AS v FROM part) SELECT p_partkey, v, "
    + PLACE.format("length(v) NULLS FIRST, v, p_partkey") + " FROM r",
)
def order_strlen(t):
    r = t.part.select("p_partkey", F.when(c("p_partkey") % 7 != 0, c("p_name")).alias("v"))
    return _placed(r, [o.strlen(c("v")), "p_partkey"], ["p_partkey", "v"])


MIX = """r AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority WHEN 1 THEN o_custkey::VARCHAR
  WHEN 2 THEN (o_custkey % 97 + 0.5)::VARCHAR END AS v FROM orders)"""


@query(
    "order_numeric",
    f"WITH {MIX} SELECT o_orderkey, v, "
    + PLACE.format("v IS NOT NULL, TRY_CAST(v AS DOUBLE) IS NOT NULL, TRY_CAST(v AS DOUBLE), v, o_orderkey") + " FROM r",
)
def order_numeric(t):
    k = c("o_orderkey") % 4
    v = (
        F.when(k == 0, c("o_orderpriority"))
        .when(k == 1, c("o_custkey").cast("string"))
        .when(k == 2, (c("o_custkey") % 97 + 0.5).cast("decimal(10,1)").cast("string"))
    )
    r = t.orders.select("o_orderkey", v.alias("v"))
    return _placed(r, [o.numeric(c("v")), "o_orderkey"], ["o_orderkey", "v"])


@query(
    "order_alphanumeric",
    """
    WITH r AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN lower(p_brand) ELSE (p_partkey % 50)::VARCHAR || 'x' END AS v FROM part),
    s AS (SELECT *, regexp_matches(v, '^[0-9]') AS digits_first, TRY_CAST(regexp_extract(v, '(\\d+)', 1) AS BIGINT) AS num FROM r)
    SELECT p_partkey, v, """
    + PLACE.format("CASE WHEN digits_first THEN 0 ELSE 1 END, num, p_partkey") + " FROM s",
)
def order_alphanumeric(t):
    k = c("p_partkey") % 3
    v = F.when(k == 0, c("p_brand")).when(k == 1, F.lower("p_brand")).otherwise(F.concat((c("p_partkey") % 50).cast("string"), F.lit("x")))
    r = t.part.select("p_partkey", v.alias("v"))
    return _placed(r, [o.alphanumeric(c("v")), "p_partkey"], ["p_partkey", "v"])


@query(
    "order_numeric_first",
    """
    WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'infinity'::DOUBLE WHEN o_orderkey % 10 = 1 THEN '-infinity'::DOUBLE
      WHEN o_orderkey % 10 = 2 THEN 'nan'::DOUBLE ELSE o_totalprice END AS v FROM orders)
    SELECT o_orderkey, v, """
    + PLACE.format("isfinite(v), v, o_orderkey") + " FROM r",
)
def order_numeric_first(t):
    k = c("o_orderkey") % 10
    v = (
        F.when(k == 0, F.lit(float("inf"))).when(k == 1, F.lit(float("-inf"))).when(k == 2, F.lit(float("nan"))).otherwise(c("o_totalprice"))
    )
    r = t.orders.select("o_orderkey", v.alias("v"))
    return _placed(r, [*o.numeric_first(c("v")), "o_orderkey"], ["o_orderkey", "v"])


@query(
    "order_nulls_first",
    "WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 13 <> 0 THEN c_acctbal END AS v FROM customer) SELECT c_custkey, v, "
    + PLACE.format("v NULLS FIRST, c_custkey") + " FROM r",
)
def order_nulls_first(t):
    r = t.customer.select("c_custkey", F.when(c("c_custkey") % 13 != 0, c("c_acctbal")).alias("v"))
    return _placed(r, [o.natural(c("v")), "c_custkey"], ["c_custkey", "v"])


@query(
    "order_time_dims",
    """
    WITH r AS (SELECT date_trunc('day', ts)::TIMESTAMP AS bucket, CASE WHEN event_type <> 'view' THEN event_type END AS kind,
      CASE WHEN user_id % 2 = 0 THEN [event_type] ELSE [event_type, (user_id % 5)::VARCHAR] END AS tags FROM events),
    g AS (SELECT bucket, kind, tags, count(*)::BIGINT AS n FROM r GROUP BY ALL)
    SELECT bucket, kind, array_to_string(tags, '|') AS tags, n, """
    + PLACE.format("bucket, kind NULLS FIRST, len(tags), tags") + " FROM g",
)
def order_time_dims(t):
    kind = F.when(c("event_type") != "view", c("event_type"))
    tags = F.when(c("user_id") % 2 == 0, F.array("event_type")).otherwise(F.array("event_type", (c("user_id") % 5).cast("string")))
    g = t.events.groupBy(F.date_trunc("day", "ts").alias("bucket"), kind.alias("kind"), tags.alias("tags")).agg(F.count(F.lit(1)).alias("n"))
    out = with_position(g, [], o.time_dims(c("bucket"), (c("kind"), False), (c("tags"), True)), "place")
    return out.select("bucket", "kind", F.array_join("tags", "|").alias("tags"), "n", "place")
