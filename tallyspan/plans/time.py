"""Granularity and interval queries."""

from pyspark.sql import functions as F

from tallyspan.functions import granularity as g
from tallyspan.operators import intervals as iv
from tallyspan.plans.registry import query

NY = "America/New_York"


@query(
    "gran_standard",
    """
    SELECT event_id, date_trunc('second', ts) AS b_second, date_trunc('minute', ts) AS b_minute,
      date_trunc('hour', ts) AS b_hour, date_trunc('day', ts)::TIMESTAMP AS b_day,
      date_trunc('week', ts)::TIMESTAMP AS b_week, date_trunc('month', ts)::TIMESTAMP AS b_month,
      date_trunc('quarter', ts)::TIMESTAMP AS b_quarter, date_trunc('year', ts)::TIMESTAMP AS b_year
    FROM events
    """,
)
def gran_standard(t):
    names = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]
    return t.events.select("event_id", *[g.granularity(n).start(F.col("ts")).alias(f"b_{n}") for n in names])


@query(
    "gran_multi",
    """
    SELECT event_id, time_bucket(INTERVAL '5 minutes', ts) AS b_5m, time_bucket(INTERVAL '10 minutes', ts) AS b_10m,
      time_bucket(INTERVAL '15 minutes', ts) AS b_15m, time_bucket(INTERVAL '30 minutes', ts) AS b_30m,
      time_bucket(INTERVAL '6 hours', ts) AS b_6h
    FROM events
    """,
)
def gran_multi(t):
    names = {"b_5m": "five_minute", "b_10m": "ten_minute", "b_15m": "fifteen_minute", "b_30m": "thirty_minute", "b_6h": "six_hour"}
    return t.events.select("event_id", *[g.granularity(n).start(F.col("ts")).alias(a) for a, n in names.items()])


@query(
    "gran_period_zone",
    """
    WITH o AS (SELECT o_orderkey, o_orderdate + INTERVAL (o_orderkey % 1440) MINUTE AS ts FROM orders),
    l AS (SELECT *, ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS w FROM o)
    SELECT o_orderkey,
      date_trunc('day', w)::TIMESTAMP AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC' AS ny_day,
      ts - (w - date_trunc('hour', w)) AS ny_hour,
      date_trunc('week', w)::TIMESTAMP AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC' AS ny_week,
      TIMESTAMP '1995-02-15' + to_months(((datediff('month', TIMESTAMP '1995-02-15', ts)
         - CASE WHEN day(ts) < 15 THEN 1 ELSE 0 END) // 2 * 2
         - CASE WHEN (datediff('month', TIMESTAMP '1995-02-15', ts) - CASE WHEN day(ts) < 15 THEN 1 ELSE 0 END) < 0
                 AND (datediff('month', TIMESTAMP '1995-02-15', ts) - CASE WHEN day(ts) < 15 THEN 1 ELSE 0 END) % 2 <> 0 THEN 2 ELSE 0 END)::INTEGER) AS two_months,
      time_bucket(INTERVAL '10 days', ts, TIMESTAMP '1970-01-01') AS ten_days,
      date_trunc('year', ts)::TIMESTAMP - to_years(((year(ts) - 1970) % 2)::INTEGER) AS two_years
    FROM l
    """,
)
def gran_period_zone(t):
    ts = F.col("o_orderdate") + F.make_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    o = t.orders.select("o_orderkey", ts.alias("ts"))
    c = F.col("ts")
    return o.select(
        "o_orderkey",
        g.Period("P1D", NY).start(c).alias("ny_day"),
        g.Period("PT1H", NY).start(c).alias("ny_hour"),
        g.Period("P1W", NY).start(c).alias("ny_week"),
        g.Period("P2M", origin="1995-02-15 00:00:00").start(c).alias("two_months"),
        g.Period("P10D").start(c).alias("ten_days"),
        g.Period("P2Y").start(c).alias("two_years"),
    )


@query(
    "gran_compound",
    """
    WITH RECURSIVE steps(s) AS (
      SELECT TIMESTAMP '2023-12-10' UNION ALL SELECT s + INTERVAL '1 month' + INTERVAL '2 days' FROM steps WHERE s < TIMESTAMP '2030-01-01')
    SELECT event_id, time_bucket(INTERVAL '30 hours', ts, TIMESTAMP '1970-01-01') AS exact_bucket,
      (SELECT max(s) FROM steps WHERE s <= ts) AS stepped_bucket
    FROM events
    """,
)
def gran_compound(t):
    rows = t.events.select("event_id", "ts").withColumn("exact_bucket", g.Period("P1DT6H").start(F.col("ts")))
    stepped = g.with_stepped_bucket(rows, "ts", g.Period("P1M2D", origin="2023-12-10 00:00:00"), "stepped_bucket")
    return stepped.drop("ts")


@query(
    "gran_duration",
    """
    SELECT event_id, time_bucket(INTERVAL '7 minutes', ts, TIMESTAMP '2024-01-01 00:03:00') AS b_seven,
      time_bucket(INTERVAL '90 minutes', ts, TIMESTAMP '1970-01-01') AS b_ninety
    FROM events
    """,
)
def gran_duration(t):
    seven = g.granularity({"type": "duration", "duration": 420000, "origin": "2024-01-01 00:03:00"})
    return t.events.select(
        "event_id", seven.start(F.col("ts")).alias("b_seven"), g.Duration(5400000).start(F.col("ts")).alias("b_ninety")
    )


@query(
    "gran_all",
    "SELECT TIMESTAMP '0001-01-01' AS bucket, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL",
)
def gran_all(t):
    return t.events.groupBy(g.granularity("all").start(F.col("ts")).alias("bucket"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "gran_none",
    "SELECT date_trunc('milliseconds', ts) AS bucket, count(*)::BIGINT AS n FROM events GROUP BY ALL",
)
def gran_none(t):
    return t.events.groupBy(g.granularity("none").start(F.col("ts")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "bucket_bounds",
    """
    WITH b AS (SELECT o_orderkey, o_orderdate AS ts, date_trunc('month', o_orderdate)::TIMESTAMP AS s FROM orders)
    SELECT o_orderkey, s AS bucket_start, s + INTERVAL '1 month' AS bucket_end, ts + INTERVAL '1 month' AS next_time,
      ts - INTERVAL '1 month' AS previous_time FROM b
    """,
)
def bucket_bounds(t):
    bounds = g.granularity("month").bounds(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in bounds.items()])


@query(
    "bucket_series",
    """
    WITH s AS (SELECT o_orderstatus, min(o_orderdate) AS lo, max(o_orderdate) + INTERVAL '1 day' AS hi FROM orders GROUP BY 1)
    SELECT o_orderstatus, unnest(generate_series(date_trunc('week', lo)::TIMESTAMP, hi - INTERVAL '1 microsecond', INTERVAL '7 days')) AS bucket_start
    FROM s
    """,
)
def bucket_series(t):
    spans = t.orders.groupBy("o_orderstatus").agg(F.min("o_orderdate").alias("lo"), F.expr("max(o_orderdate) + interval 1 day").alias("hi"))
    starts = g.granularity("week").covering(F.col("lo"), F.col("hi"))
    return spans.select("o_orderstatus", F.explode(starts).alias("bucket_start"))


@query(
    "finer_granularities",
    """
    WITH g AS (SELECT * FROM (VALUES (1,'second'),(2,'minute'),(3,'five_minute'),(4,'ten_minute'),(5,'fifteen_minute'),
      (6,'thirty_minute'),(7,'hour'),(8,'six_hour'),(9,'day'),(10,'week'),(11,'month'),(12,'quarter'),(13,'year')) v(i, name)),
    w AS (SELECT event_id, CASE WHEN value < 10 THEN 4 WHEN value < 30 THEN 7 WHEN value < 100 THEN 9 ELSE 12 END AS i FROM events),
    l AS (SELECT w.i, string_agg(g.name, ',' ORDER BY g.i DESC) AS finer FROM (SELECT DISTINCT i FROM w) w JOIN g ON g.i <= w.i GROUP BY w.i)
    SELECT event_id, finer FROM w JOIN l USING (i)
    """,
)
def finer_granularities(t):
    v = F.col("value")
    name = F.when(v < 10, "ten_minute").when(v < 30, "hour").when(v < 100, "day").otherwise("quarter")
    return t.events.select("event_id", F.array_join(g.finer_granularities_of(name), ",").alias("finer"))


@query(
    "time_to_path",
    """
    SELECT event_id, strftime(ts, 'y=%Y/m=%m/d=%d/H=%H') AS hour_path, strftime(ts, 'y=%Y/m=%m/d=%d/h=%H/m=%M') AS minute_lower,
      strftime(ts, 'dt=%Y-%m-%d-%H') AS hour_hive, strftime(ts, 'dt=%Y-%m-%d-%H-%M-%S') AS second_hive,
      strftime(ts, 'y=%Y/m=%m') AS quarter_path
    FROM events
    """,
)
def time_to_path(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        g.time_to_path(ts, "hour").alias("hour_path"),
        g.time_to_path(ts, "fifteen_minute", "lower").alias("minute_lower"),
        g.time_to_path(ts, "hour", "hive").alias("hour_hive"),
        g.time_to_path(ts, "second", "hive").alias("second_hive"),
        g.time_to_path(ts, "quarter").alias("quarter_path"),
    )


@query(
    "path_to_time",
    """
    SELECT event_id, date_trunc('hour', ts) AS from_hour, date_trunc('minute', ts) AS from_hive,
      date_trunc('quarter', ts)::TIMESTAMP AS from_quarter, NULL::TIMESTAMP AS too_short
    FROM events
    """,
)
def path_to_time(t):
    ts = F.col("ts")
    under = lambda p: F.concat(F.lit("/lake/events/"), p, F.lit("/part-0.parquet"))
    hour = under(g.time_to_path(ts, "hour"))
    return t.events.select(
        "event_id",
        g.path_to_time(hour, "hour").alias("from_hour"),
        g.path_to_time(under(g.time_to_path(ts, "second", "hive")), "minute", "hive").alias("from_hive"),
        g.path_to_time(under(g.time_to_path(ts, "day", "lower")), "quarter", "lower").alias("from_quarter"),
        g.path_to_time(under(g.time_to_path(ts, "day")), "hour").alias("too_short"),
    )


def _order_intervals(t):
    return t.orders.select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("start"), F.expr("o_orderdate + interval 3 days").alias("end")
    )


ORDER_INTERVALS = "i AS (SELECT o_custkey, o_orderkey, o_orderdate AS s, o_orderdate + INTERVAL '3 days' AS e FROM orders)"


@query(
    "intervals_condense",
    f"""
    WITH {ORDER_INTERVALS},
    p AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
    n AS (SELECT *, sum(CASE WHEN s <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM p)
    SELECT o_custkey, min(s) AS "start", max(e) AS "end" FROM n GROUP BY o_custkey, island
    """,
)
def intervals_condense(t):
    return iv.condense(_order_intervals(t), ["o_custkey"], cell="quarter")


@query(
    "intervals_umbrella",
    f'WITH {ORDER_INTERVALS} SELECT o_custkey, min(s) AS "start", max(e) AS "end" FROM i GROUP BY 1',
)
def intervals_umbrella(t):
    return iv.umbrella(_order_intervals(t), ["o_custkey"])


@query(
    "intervals_overlap",
    f"""
    WITH {ORDER_INTERVALS}
    SELECT o_custkey, o_orderkey FROM i WHERE EXISTS (
      SELECT 1 FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
      WHERE o.o_custkey = i.o_custkey AND l.l_shipdate < i.e AND i.s < l.l_shipdate + INTERVAL '60 days')
    """,
)
def intervals_overlap(t):
    shipped = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select("o_custkey", F.col("l_shipdate").alias("start"), F.expr("l_shipdate + interval 60 days").alias("end"))
    return iv.overlapping(_order_intervals(t), shipped, ["o_custkey"], cell="quarter").select("o_custkey", "o_orderkey")


@query(
    "intervals_clip",
    f"""
    WITH {ORDER_INTERVALS}
    SELECT o_orderkey, greatest(s, TIMESTAMP '1996-02-01 06:00:00') AS "start", least(e, TIMESTAMP '1997-03-05 18:00:00') AS "end"
    FROM i WHERE s < TIMESTAMP '1997-03-05 18:00:00' AND e > TIMESTAMP '1996-02-01 06:00:00'
    """,
)
def intervals_clip(t):
    return iv.clip(_order_intervals(t), "1996-02-01 06:00:00", "1997-03-05 18:00:00").select("o_orderkey", "start", "end")


@query(
    "intervals_order",
    """
    WITH i AS (SELECT o_orderkey, o_orderdate AS s, o_orderdate + to_days((o_orderkey % 5)::INTEGER) AS e FROM orders)
    SELECT o_orderkey, s AS "start", e AS "end",
      (row_number() OVER (ORDER BY s, e, o_orderkey) - 1)::BIGINT AS by_start, (row_number() OVER (ORDER BY e, s, o_orderkey) - 1)::BIGINT AS by_end
    FROM i
    """,
)
def intervals_order(t):
    from tallyspan.operators.ordered import with_position

    rows = t.orders.select(
        "o_orderkey",
        F.col("o_orderdate").alias("start"),
        (F.col("o_orderdate") + F.make_interval(days=(F.col("o_orderkey") % 5).cast("int"))).alias("end"),
    )
    ranked = with_position(rows, [], ["start", "end", "o_orderkey"], "by_start")
    return with_position(ranked, [], ["end", "start", "o_orderkey"], "by_end")
