"""Rollup queries over events."""

from pyspark.sql import functions as F

from tallyspan.functions.granularity import granularity
from tallyspan.operators import aggregate as a
from tallyspan.operators import postagg as p
from tallyspan.operators import rollup as r
from tallyspan.plans.registry import query

c = F.col


@query(
    "rollup",
    """
    WITH e AS (SELECT *, CASE WHEN user_id % 2 = 0 THEN [event_type] ELSE [event_type, (user_id % 3)::VARCHAR] END AS tags FROM events)
    SELECT date_trunc('hour', ts) AS bucket, array_to_string(tags, '|') AS tags, count(*)::BIGINT AS n, round(sum(value), 4) AS total,
      min(user_id) AS low_user, max(value) AS top FROM e GROUP BY 1, 2
    """,
)
def rollup(t):
    tags = F.when(c("user_id") % 2 == 0, F.array("event_type")).otherwise(F.array("event_type", (c("user_id") % 3).cast("string")))
    aggs = [a.count("n"), a.double_sum("total", c("value")), a.long_min("low_user", c("user_id")), a.double_max("top", c("value"))]
    # a multi-value dimension is grouped as a whole list
    out = r.rollup(t.events.withColumn("tags", tags), "ts", granularity("hour"), ["tags"], aggs)
    return out.withColumns({"tags": F.array_join("tags", "|"), "total": F.round("total", 4)})


@query("no_rollup", "SELECT date_trunc('hour', ts) AS bucket, event_id, event_type, value FROM events")
def no_rollup(t):
    return r.bucketed(t.events, "ts", granularity("hour")).select("bucket", "event_id", "event_type", "value")


@query(
    "rollup_min_time",
    """
    SELECT greatest(date_trunc('day', ts)::TIMESTAMP, TIMESTAMP '2024-01-08 15:30:00') AS bucket, event_type, count(*)::BIGINT AS n, false AS rejected
    FROM events WHERE ts >= TIMESTAMP '2024-01-08 15:30:00' GROUP BY 1, 2
    UNION ALL SELECT NULL, event_type, count(*)::BIGINT, true FROM events WHERE ts < TIMESTAMP '2024-01-08 15:30:00' GROUP BY 2
    """,
)
def rollup_min_time(t):
    floor = "2024-01-08 15:30:00"
    kept = r.rollup(t.events, "ts", granularity("day"), ["event_type"], [a.count("n")], min_time=floor)
    _, late = r.split_by_min_time(t.events, "ts", floor)
    lost = late.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return kept.withColumn("rejected", F.lit(False)).unionByName(
        lost.select(F.lit(None).cast("timestamp").alias("bucket"), "event_type", "n", F.lit(True).alias("rejected"))
    )


@query(
    "rollup_discover_dims",
    "SELECT date_trunc('day', ts)::TIMESTAMP AS bucket, user_id::VARCHAR AS user_id, event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2, 3",
)
def rollup_discover_dims(t):
    rows = r.discover_dims(t.events, "ts", ["value"], ["event_id", "props"])
    dims = [d for d in rows.columns if d not in ("ts", "value")]
    out = r.rollup(rows, "ts", granularity("day"), dims, [a.count("n"), a.double_sum("total", c("value"))])
    return out.withColumn("total", F.round("total", 4))


@query(
    "rollup_rows_desc",
    """
    SELECT date_trunc('day', ts)::TIMESTAMP AS bucket, event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total, round(sum(value), 4) / count(*) AS mean
    FROM events GROUP BY 1, 2 ORDER BY bucket DESC, event_type DESC
    """,
)
def rollup_rows_desc(t):
    out = r.rollup(t.events, "ts", granularity("day"), ["event_type"], [a.count("n"), a.double_sum("total", c("value"))])
    out = out.withColumn("total", F.round("total", 4)).withColumn("mean", p.arithmetic("/", [c("total"), c("n")]))
    return out.orderBy(F.desc("bucket"), F.desc("event_type"))


@query("max_ingested_time", "SELECT event_type, max(ts) AS max_time FROM events GROUP BY 1")
def max_ingested_time(t):
    return t.events.groupBy("event_type").agg(F.max("ts").alias("max_time"))


@query(
    "re_rollup",
    """
    SELECT date_trunc('day', ts)::TIMESTAMP AS bucket, event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total, max(user_id) AS top_user,
      arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value,
      concat_ws(',', (count(*) FILTER (WHERE value > 10 AND value <= 50)), (count(*) FILTER (WHERE value > 50 AND value <= 100))) AS middle_bins
    FROM events GROUP BY 1, 2
    """,
)
def re_rollup(t):
    aggs = [
        a.count("n"),
        a.double_sum("total", c("value")),
        a.long_max("top_user", c("user_id")),
        a.double_first("first_value", c("value"), "ts", "event_id", state=True),
        a.double_last("last_value", c("value"), "ts", "event_id", state=True),
        a.histogram("bins", c("value"), [10.0, 50.0, 100.0]),
    ]
    # hourly states of two halves, merged to days
    half = c("ts") < F.lit("2024-01-15").cast("timestamp")
    parts = [r.rollup(t.events.where(w), "ts", granularity("hour"), ["event_type"], aggs, finish=False) for w in (half, ~half)]
    out = r.re_rollup(parts, ["event_type"], aggs, gran=granularity("day"))
    bins = F.array_join(F.transform("bins.counts", lambda n: n.cast("long").cast("string")), ",")
    return out.select("bucket", "event_type", "n", F.round("total", 4).alias("total"), "top_user", "first_value", "last_value", bins.alias("middle_bins"))
