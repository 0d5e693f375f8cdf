"""Streaming queries: the tables arrive as a file stream that is run until all of it is read."""

from pyspark.sql import functions as F

from tallyspan.functions.granularity import granularity
from tallyspan.operators import aggregate as a
from tallyspan.plans.alerts import requests_of
from tallyspan.plans.registry import query
from tallyspan.session import scratch_path
from tallyspan.streaming.outbox import outbox_available
from tallyspan.streaming.rollup import rollup_available
from tallyspan.streaming.sinks import BATCH, set_arrival_times, stream_table
from tallyspan.streaming.watermark import rollup_appended
from tallyspan.tables import SCHEMAS

c = F.col


@query(
    "rollup_stream",
    """
    SELECT date_trunc('hour', ts) AS bucket, event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total, arg_max(value, (ts, event_id)) AS last_value,
      count(*) FILTER (WHERE value > 100)::BIGINT AS n_high
    FROM events WHERE ts >= TIMESTAMP '2024-01-03' GROUP BY 1, 2
    """,
)
def rollup_stream(t):
    aggs = [
        a.count("n"),
        a.double_sum("total", c("value")),
        a.double_last("last_value", c("value"), "ts", "event_id", state=True),
        a.filtered(a.count("n_high"), c("value") > 100),
    ]
    stream = stream_table(t.spark, t.sf_dir, "events")
    out = rollup_available(stream, "ts", granularity("hour"), ["event_type"], aggs, min_time="2024-01-03 00:00:00")
    return out.withColumn("total", F.round("total", 4))


@query(
    "alert_outbox_stream",
    """
    WITH r AS (SELECT event_id AS request_id, '[' || upper(CASE event_type WHEN 'error' THEN 'fatal' WHEN 'purchase' THEN 'warn' ELSE 'info' END) || '] event ' || event_id AS subject,
      CASE user_id % 3 WHEN 0 THEN ['ops@example.com'] WHEN 1 THEN ['ops@example.com', 'user' || user_id || '@example.com'] ELSE [] END AS tos
      FROM events)
    SELECT request_id, subject, unnest(tos) AS recipient, false AS missing_recipient FROM r
    UNION ALL SELECT request_id, subject, NULL, true FROM r WHERE len(tos) = 0
    """,
)
def alert_outbox_stream(t):
    stream = stream_table(t.spark, t.sf_dir, "events")
    return outbox_available(requests_of(stream)).drop("body")


# rows arrive in six files, by time, but every seventh up to nine days after its time
ARRIVALS = 6
ARRIVED_SQL = """
    e AS (SELECT *, least(5, (date_diff('day', TIMESTAMP '2024-01-01', ts) + CASE WHEN event_id % 7 = 0 THEN event_id % 10 ELSE 0 END) // 6) AS arrived FROM events),
    w AS (SELECT arrived, max(max(ts)) OVER (ORDER BY arrived) - INTERVAL '36 hours' AS after FROM e GROUP BY arrived),
    j AS (SELECT e.*, b.after AS mark, date_trunc('hour', ts) + INTERVAL '1 hour' AS ends, ts < TIMESTAMP '2024-01-02' AS early
      FROM e LEFT JOIN w b ON b.arrived = (SELECT max(arrived) FROM w x WHERE x.arrived < e.arrived)),
    kept AS (SELECT * FROM j WHERE NOT early AND (mark IS NULL OR ends > mark))
"""


def _arriving(t):
    """The events as a stream of small files, one per micro-batch, in the order of arrival."""
    day = F.datediff(c("ts"), F.lit("2024-01-01").cast("date"))
    late = F.when(c("event_id") % 7 == 0, c("event_id") % 10).otherwise(0)
    rows = t.events.withColumn("arrived", F.least(F.lit(ARRIVALS - 1), F.floor((day + late) / 6)).cast("int"))
    folder = scratch_path(t.spark, "arrivals")
    rows.repartition("arrived").write.partitionBy("arrived").parquet(folder)
    set_arrival_times(t.spark, folder)
    schema = f"{SCHEMAS['events']}, arrived int"
    return t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _appended(t):
    aggs = [a.count("n"), a.double_sum("total", c("value")), a.double_last("last_value", c("value"), "ts", "event_id", state=True)]
    job = rollup_appended(scratch_path(t.spark, "appended"), "ts", granularity("hour"), ["event_type"], aggs, "36 hours", "2024-01-02 00:00:00")
    stream = _arriving(t)
    job.run(stream, scratch_path(t.spark, "appended-stream"))
    return job, t.spark.createDataFrame([], stream.schema)


@query(
    "rollup_stream_append",
    f"""
    WITH {ARRIVED_SQL}
    SELECT date_trunc('hour', ts) AS bucket, event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total, arg_max(value, (ts, event_id)) AS last_value
    FROM kept WHERE ends <= (SELECT max(after) FROM w) GROUP BY 1, 2
    """,
)
def rollup_stream_append(t):
    job, rows = _appended(t)
    return job.emitted(rows).drop(BATCH).withColumn("total", F.round("total", 4))


@query(
    "rollup_stream_late",
    f"""
    WITH {ARRIVED_SQL}
    SELECT event_id, ts, arrived::INTEGER AS arrived, CASE WHEN early THEN 'before the minimum time' ELSE 'late' END AS reason
    FROM j WHERE early OR ends <= mark
    """,
)
def rollup_stream_late(t):
    job, rows = _appended(t)
    return job.rejected(rows).select("event_id", "ts", "arrived", "reason")
