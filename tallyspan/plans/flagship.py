"""The hourly rollup of events: interval filter, bucket, aggregate, post-aggregate, newest first."""

from pyspark.sql import functions as F

from tallyspan.functions.granularity import granularity
from tallyspan.operators.aggregate import count, double_last, double_sum, filtered
from tallyspan.operators.intervals import within
from tallyspan.operators.postagg import arithmetic
from tallyspan.operators.rollup import rollup
from tallyspan.plans.registry import query


@query(
    "hourly_rollup",
    """
    WITH b AS (
      SELECT date_trunc('hour', ts) AS bucket, event_type, count(*)::BIGINT AS n,
             round(sum(value), 4) AS total, arg_max(value, (ts, event_id)) AS last_value,
             count(*) FILTER (WHERE value > 100)::BIGINT AS n_high
      FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-29'
      GROUP BY ALL)
    SELECT *, total / n AS mean FROM b ORDER BY bucket DESC, event_type
    """,
)
def hourly_rollup(t):
    rows = t.events.where(within(F.col("ts"), "2024-01-02", "2024-01-29"))
    rolled = rollup(
        rows,
        "ts",
        granularity("hour"),
        ["event_type"],
        [
            count("n"),
            double_sum("total", F.col("value")),
            double_last("last_value", F.col("value"), "ts", "event_id"),
            filtered(count("n_high"), F.col("value") > 100),
        ],
    )
    rolled = rolled.withColumn("total", F.round("total", 4))
    return rolled.withColumn("mean", arithmetic("/", [F.col("total"), F.col("n")])).orderBy(F.desc("bucket"), "event_type")
