"""Catalog queries. The catalog is derived from events: one segment per event type and six hours."""

from pyspark.sql import functions as F

from tallyspan.functions.granularity import granularity
from tallyspan.operators import catalog as k
from tallyspan.operators.ordered import with_position
from tallyspan.plans.registry import query

c = F.col
ISO = "'%Y-%m-%dT%H:%M:%S.%g'"

SEGMENTS = f"""seg AS (
  SELECT event_type AS datasource, time_bucket(INTERVAL '6 hours', ts) AS s, time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours' AS e,
    count(*)::BIGINT AS size, min(event_id) AS part FROM events GROUP BY ALL),
cat AS (SELECT datasource, s, e, size, CASE WHEN part % 3 = 0 THEN 0 ELSE 1 END AS used, part % 4 AS part,
    datasource || '_' || strftime(s, {ISO}) || 'Z_' || strftime(e, {ISO}) || 'Z_v1' || CASE WHEN part % 4 <> 0 THEN '_' || part % 4 ELSE '' END AS identifier,
    '/lake/' || datasource || '/' || strftime(s, '%Y%m%d%H') AS path FROM seg)"""


def _segments(t):
    start = granularity("six_hour").start(c("ts"))
    rows = t.events.groupBy(c("event_type").alias("datasource"), start.alias("start")).agg(
        F.count(F.lit(1)).alias("size"), F.min("event_id").alias("first_id")
    )
    rows = rows.withColumns(
        {
            "end": F.expr("start + interval 6 hours"),
            "used": F.when(c("first_id") % 3 == 0, 0).otherwise(1),
            "partition": c("first_id") % 4,
            "path": F.concat_ws("/", F.lit("/lake"), "datasource", F.date_format("start", "yyyyMMddHH")),
        }
    )
    return rows.withColumn("id", k.make_identifier(c("datasource"), c("start"), c("end"), F.lit("v1"), c("partition")))


def _catalog(t):
    """The stored form: id, source, start, used flag and a JSON payload."""
    payload = F.to_json(
        F.struct(
            F.concat_ws("/", k.iso(c("start")), k.iso(c("end"))).alias("interval"),
            F.concat_ws(",", F.lit("event_type"), F.lit("user_id")).alias("dimensions"),
            F.lit("value").alias("metrics"),
            c("id").alias("identifier"),
            c("size"),
            F.struct(F.lit("hdfs").alias("type"), c("path")).alias("loadSpec"),
        )
    )
    return _segments(t).select("id", "datasource", "start", "used", payload.alias("payload"))


@query(
    "catalog_payload",
    f"WITH {SEGMENTS} SELECT datasource, s AS start, e AS \"end\", 'event_type|user_id' AS dimensions, 'value' AS metrics, identifier, size, path FROM cat",
)
def catalog_payload(t):
    out = k.with_payload(_catalog(t))
    return out.select(
        "datasource", "start", "end", F.array_join("dimensions", "|").alias("dimensions"), F.array_join("metrics", "|").alias("metrics"),
        "identifier", "size", "path",
    )


@query(
    "catalog_used_for_date",
    f"""
    WITH {SEGMENTS} SELECT identifier AS id, s AS start FROM cat
    WHERE used = 1 AND datasource = 'click' AND (s + INTERVAL '8 hours')::DATE = DATE '2024-01-10' ORDER BY s, id
    """,
)
def catalog_used_for_date(t):
    return k.used_on(_catalog(t), "click", "2024-01-10").select("id", "start")


@query(
    "catalog_latest",
    f"WITH {SEGMENTS} SELECT datasource, max(s) AS start, arg_max(identifier, (s, identifier)) AS id FROM cat WHERE used = 1 GROUP BY 1",
)
def catalog_latest(t):
    return k.latest_per_source(_catalog(t).drop("payload")).select("datasource", "start", "id")


@query(
    "catalog_group",
    """
    WITH seg AS (SELECT CASE WHEN event_type IN ('view', 'click') THEN 'web' ELSE 'other' END AS datasource, event_type, time_bucket(INTERVAL '6 hours', ts) AS s, count(*)::BIGINT AS size FROM events GROUP BY ALL)
    SELECT datasource, s AS start, s + INTERVAL '6 hours' AS "end", '/lake/' || event_type || '/' || strftime(s, '%Y%m%d%H') AS path,
      count(*) OVER w::BIGINT AS segments, sum(size) OVER w::BIGINT AS total_size
    FROM seg WINDOW w AS (PARTITION BY datasource, s)
    """.replace("count(*) OVER w::BIGINT", "(count(*) OVER w)::BIGINT").replace("sum(size) OVER w::BIGINT", "(sum(size) OVER w)::BIGINT"),
)
def catalog_group(t):
    segments = k.with_payload(_catalog(t))
    web = F.when(c("datasource").isin("view", "click"), "web").otherwise("other")
    return k.grouped(segments.withColumn("datasource", web)).select("datasource", "start", "end", "path", "segments", "total_size")


@query(
    "catalog_month_order",
    f"WITH {SEGMENTS} SELECT identifier AS id, (row_number() OVER (ORDER BY date_trunc('month', s), identifier) - 1)::BIGINT AS place FROM cat",
)
def catalog_month_order(t):
    return with_position(_segments(t).select("id", "start"), [], k.month_order("start", "id"), "place").select("id", "place")


@query("segment_id_make", f"WITH {SEGMENTS} SELECT datasource, s AS start, part AS partition, identifier AS id FROM cat")
def segment_id_make(t):
    return _segments(t).select("datasource", "start", "partition", "id")


@query(
    "segment_id_parse",
    f"""
    WITH {SEGMENTS} SELECT identifier AS id, s AS start, e AS "end", 'v1' AS version, CASE WHEN part <> 0 THEN part::VARCHAR END AS trail, true AS other_is_null FROM cat
    """,
)
def segment_id_parse(t):
    parts = k.parse_identifier(c("datasource"), c("id"))
    other = k.parse_identifier(F.lit("elsewhere"), c("id")).isNull()
    return _segments(t).select("id", parts["start"].alias("start"), parts["end"].alias("end"), parts["version"].alias("version"), parts["trail"].alias("trail"), other.alias("other_is_null"))


@query(
    "segment_id_with_interval",
    f"""
    WITH {SEGMENTS} SELECT identifier AS id, datasource || '_' || strftime(s, {ISO}) || 'Z_' || strftime(s + INTERVAL '1 hour', {ISO}) || 'Z_v1' || CASE WHEN part <> 0 THEN '_' || part ELSE '' END AS moved,
      identifier AS kept FROM cat
    """,
)
def segment_id_with_interval(t):
    end = F.expr("start + interval 1 hour")
    return _segments(t).select(
        "id",
        k.with_interval(c("datasource"), c("id"), c("start"), end).alias("moved"),
        k.with_interval(F.lit("elsewhere"), c("id"), c("start"), end).alias("kept"),
    )


@query(
    "compare_tables",
    """
    SELECT event_id, event_type, value, 1::BIGINT AS surplus FROM events WHERE event_id % 500 = 0
    UNION ALL SELECT event_id, event_type, value + 1, -1 FROM events WHERE event_id % 500 = 0
    """,
)
def compare_tables(t):
    left = t.events.select("event_id", "event_type", "value", F.array().cast("array<string>").alias("tags"))
    changed = F.when(c("event_id") % 500 == 0, c("value") + 1).otherwise(c("value"))
    right = t.events.select("event_id", "event_type", changed.alias("value"), F.array(F.lit(None).cast("string")).alias("tags"))
    return k.compare(left, right, ["tags"]).drop("tags")


@query(
    "catalog_agree",
    """
    WITH e AS (SELECT event_type, ts::DATE AS day, CASE WHEN event_type = 'view' THEN NULL ELSE 'hour' END AS gran, 'v' || CASE WHEN event_type = 'click' THEN user_id ELSE 1 END AS version FROM events)
    SELECT day, CASE WHEN min(gran) = max(gran) AND count(gran) = count(*) THEN min(gran) END AS gran,
      CASE WHEN min(version) = max(version) THEN min(version) END AS version, CASE WHEN min(event_type) = max(event_type) THEN min(event_type) END AS event_type
    FROM e GROUP BY 1
    """,
)
def catalog_agree(t):
    rows = t.events.select(
        F.to_date("ts").alias("day"),
        "event_type",
        F.when(c("event_type") != "view", "hour").alias("gran"),
        F.concat(F.lit("v"), F.when(c("event_type") == "click", c("user_id")).otherwise(1).cast("string")).alias("version"),
    )
    return k.agreed(rows, ["day"], ["gran", "version", "event_type"])


@query(
    "column_stats",
    """
    WITH v AS (SELECT o_orderdate, unnest(['o_orderstatus', 'o_orderpriority', 'o_custkey']) AS dimension, unnest([o_orderstatus, o_orderpriority, o_custkey::VARCHAR]) AS value FROM orders)
    SELECT dimension, count(DISTINCT value)::BIGINT AS cardinality, min(value) AS min_value, max(value) AS max_value, count(*)::BIGINT AS rows,
      min(o_orderdate) AS min_time, max(o_orderdate) AS max_time FROM v GROUP BY 1
    """,
)
def column_stats(t):
    return k.column_stats(t.orders, "o_orderdate", ["o_orderstatus", "o_orderpriority", "o_custkey"])


# configuration tables derived from the given ones: sources from suppliers, outputs from nations, jobs from customers

CONFIG = """src AS (SELECT s_suppkey AS id, 'src_' || s_suppkey AS source_code, 'jdbc:mysql://db' || s_nationkey || '/app' AS source_url, 'MYSQL' AS source_type FROM supplier),
out AS (SELECT n_nationkey::BIGINT AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'FILE' ELSE 'HIVE' END AS object_type, '/lake/' || n_name AS data_path FROM nation),
job AS (SELECT c_custkey AS id, 'job_' || c_custkey AS define_name, c_custkey % 120 AS input_source_id, c_nationkey::BIGINT AS output_source_id,
  CASE WHEN c_custkey % 5 = 0 THEN 'MYSQL' ELSE 'HADOOP' END AS output_type, c_mktsegment, c_name FROM customer)"""


def _sources(t):
    return t.supplier.select(
        c("s_suppkey").alias("id"),
        F.concat(F.lit("src_"), c("s_suppkey").cast("string")).alias("source_code"),
        F.concat(F.lit("jdbc:mysql://db"), c("s_nationkey").cast("string"), F.lit("/app")).alias("source_url"),
        F.lit("MYSQL").alias("source_type"),
    )


def _outputs(t):
    return t.nation.select(
        c("n_nationkey").cast("long").alias("id"),
        F.when(c("n_nationkey") % 2 == 0, "FILE").otherwise("HIVE").alias("object_type"),
        F.concat(F.lit("/lake/"), c("n_name")).alias("data_path"),
        F.lit("dw").alias("hive_schema"),
    )


def _jobs(t):
    first = F.struct(c("c_name").alias("sourceTable"), F.lit("id").alias("splitKey"), F.lower("c_mktsegment").alias("targetTable"), F.lit(None).cast("struct<tableName:string,fields:array<string>>").alias("source"))
    second = F.struct(
        F.lit(None).cast("string").alias("sourceTable"),
        F.lit(None).cast("string").alias("splitKey"),
        F.lit("t2").alias("targetTable"),
        F.struct(F.lit("wide").alias("tableName"), F.array(F.lit("a"), c("c_mktsegment")).alias("fields")).alias("source"),
    )
    return t.customer.select(
        c("c_custkey").alias("id"),
        F.concat(F.lit("job_"), c("c_custkey").cast("string")).alias("define_name"),
        (c("c_custkey") % 120).alias("input_source_id"),
        c("c_nationkey").cast("long").alias("output_source_id"),
        F.when(c("c_custkey") % 5 == 0, "MYSQL").otherwise("HADOOP").alias("output_type"),
        F.to_json(F.when(c("c_custkey") % 2 == 0, F.array(first, second)).otherwise(F.array(first))).alias("table_mappers"),
    )


@query(
    "config_resolve",
    f"""
    WITH {CONFIG} SELECT define_name, source_code, source_url, object_type, data_path
    FROM job JOIN src ON input_source_id = src.id JOIN out ON output_source_id = out.id WHERE output_type = 'HADOOP'
    """,
)
def config_resolve(t):
    return k.resolve_jobs(_jobs(t), _sources(t), _outputs(t)).select("define_name", "source_code", "source_url", "object_type", "data_path")


@query(
    "config_mappers",
    f"""
    WITH {CONFIG} SELECT define_name, c_name AS source_table, 'id' AS split_key, lower(c_mktsegment) AS target_table, NULL::VARCHAR AS fields FROM job
    UNION ALL SELECT define_name, 'wide', NULL, 't2', 'a|' || c_mktsegment FROM job WHERE id % 2 = 0
    """,
)
def config_mappers(t):
    return k.mappings(_jobs(t)).select("define_name", "source_table", "split_key", "target_table", F.array_join("fields", "|").alias("fields"))


@query(
    "config_source_lookup",
    "SELECT 'src_' || s_suppkey AS source_code, 'jdbc:mysql://db' || s_nationkey || '/app' AS source_url, true AS missing_fails FROM supplier WHERE s_suppkey = 7",
)
def config_source_lookup(t):
    try:
        k.source_by_code(_sources(t), "nowhere")
        failed = False
    except ValueError:
        failed = True
    return k.source_by_code(_sources(t), "src_7").select("source_code", "source_url", F.lit(failed).alias("missing_fails"))


@query(
    "table_columns",
    """
    SELECT r_name AS db_name, n_name AS tbl_name, c_name AS column_name, lower(c_mktsegment) AS type_name, c_custkey AS integer_idx
    FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN (SELECT s_nationkey AS sd_id, max(s_nationkey) AS cd_id FROM supplier GROUP BY 1) ON sd_id = n_nationkey
      LEFT JOIN customer ON c_nationkey = cd_id
    ORDER BY db_name, tbl_name, integer_idx
    """,
)
def table_columns(t):
    # the metastore shape: databases from regions, tables from nations, storage from suppliers, columns from customers
    dbs = t.region.select(c("r_regionkey").alias("db_id"), c("r_name").alias("db_name"))
    tbls = t.nation.select(c("n_regionkey").alias("db_id"), c("n_nationkey").alias("sd_id"), c("n_name").alias("tbl_name"))
    sds = t.supplier.groupBy(c("s_nationkey").alias("sd_id")).agg(F.max("s_nationkey").alias("cd_id"))
    cols = t.customer.select(
        c("c_nationkey").alias("cd_id"), c("c_name").alias("column_name"), F.lower("c_mktsegment").alias("type_name"), c("c_custkey").alias("integer_idx")
    )
    return k.table_columns(dbs, tbls, sds, cols).orderBy("db_name", "tbl_name", "integer_idx")
