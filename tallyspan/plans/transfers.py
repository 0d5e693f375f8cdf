"""Transfer queries. Writes go to the shared scratch folder and are read back.

The database ends of the JDBC jobs need a database; what is registered here is their Spark side:
the range plan over the whole table, the typed rows and the replace rules.
"""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyspan.functions import hivetypes as ht
from tallyspan.operators.intervals import within
from tallyspan.operators.ordered import with_position
from tallyspan.plans.registry import query
from tallyspan.session import scratch_path
from tallyspan.sources import jdbc, ranges as r, transfer as tr

c = F.col


@query(
    "jdbc_range_scan",
    """
    WITH p AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) + 1 - min(o_orderkey) AS span FROM orders),
    b AS (SELECT range AS i, lo + span * range // 10 AS a, lo + span * (range + 1) // 10 AS z FROM p, range(10))
    SELECT i::INTEGER AS task, count(*)::BIGINT AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM orders JOIN b ON o_orderkey >= a AND o_orderkey < z GROUP BY 1
    UNION ALL SELECT 10, count(*)::BIGINT, NULL, NULL FROM orders WHERE o_orderkey IS NULL HAVING count(*) > 0
    """,
)
def jdbc_range_scan(t):
    lo, hi = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    # one read per predicate, as the database source makes them
    predicates = r.range_predicates("o_orderkey", r.ranges(lo, hi, 10))
    return _read_by(t.orders, predicates).groupBy("task").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


def _read_by(table, predicates):
    """The partitions of a split read, with their number."""
    return reduce(DataFrame.unionByName, [table.where(p).withColumn("task", F.lit(i)) for i, p in enumerate(predicates)])


@query(
    "jdbc_offset_scan",
    """
    SELECT 'page' AS how, c_custkey::VARCHAR AS key, ((row_number() OVER (ORDER BY c_custkey) - 1) // 400)::BIGINT AS part FROM customer
    UNION ALL SELECT 'remainder', c_custkey::VARCHAR, (c_custkey % 4)::BIGINT FROM customer
    UNION ALL SELECT 'hashed', c_name, ord(right(c_name, 1)) % 3 FROM customer
    """,
)
def jdbc_offset_scan(t):
    # pages by position, and what a read without a split key uses instead: remainders of the key, or of its hash
    paged = with_position(t.customer.select("c_custkey"), [], ["c_custkey"])
    page = paged.select(F.lit("page").alias("how"), c("c_custkey").cast("string").alias("key"), F.call_function("div", c("position"), F.lit(400)).alias("part"))
    plain = _read_by(t.customer, r.hash_predicates("c_custkey", 4)).select(F.lit("remainder").alias("how"), c("c_custkey").cast("string").alias("key"), c("task").cast("long").alias("part"))
    hashed = _read_by(t.customer, r.hash_predicates("c_name", 3, "ASCII(RIGHT(c_name, 1))"))
    return page.unionByName(plain).unionByName(hashed.select(F.lit("hashed").alias("how"), c("c_name").alias("key"), c("task").cast("long").alias("part")))


@query(
    "default_split_key",
    """
    WITH k AS (SELECT * FROM (VALUES ('configured', 'o_orderkey'), ('sole id', 'ID'), ('none', NULL)) v(how, split_key)),
    p AS (SELECT max(o_orderkey) + 1 AS span FROM orders)
    SELECT how, split_key, CASE WHEN split_key IS NULL THEN 0 ELSE least(o_orderkey * 4 // span, 3) END::INTEGER AS task, count(*)::BIGINT AS n
    FROM k, orders, p GROUP BY ALL
    """,
)
def default_split_key(t):
    cases = {"configured": ("o_orderkey", ["id"]), "sole id": (None, ["ID"]), "none": (None, ["id", "o_custkey"])}
    rows = t.orders.select("o_orderkey", c("o_orderkey").alias("id"))
    lo, hi = rows.agg(F.min("id"), F.max("id")).first()
    out = []
    for how, (configured, keys) in cases.items():
        key = r.default_split_key(configured, keys)
        predicates = r.range_predicates(key, r.ranges(lo, hi, 4)) if key else ["1 = 1"]
        counted = _read_by(rows, predicates).groupBy("task").agg(F.count(F.lit(1)).alias("n"))
        out.append(counted.select(F.lit(how).alias("how"), F.lit(key).cast("string").alias("split_key"), "task", "n"))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(
    "wildcard_union",
    "SELECT o_orderkey, o_custkey, o_totalprice, 'orders_' || year(o_orderdate) AS source_table FROM orders",
)
def wildcard_union(t):
    lo, hi = t.orders.agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    tables = {}
    for year in range(lo, hi + 1):
        tables[f"orders_{year}"] = t.orders.where(within(c("o_orderdate"), f"{year}-01-01", f"{year + 1}-01-01"))
    tables["customer"] = t.customer
    union = tr.wildcard_union(t.spark, "orders_%", list(tables), tables.get)
    return union.select("o_orderkey", "o_custkey", "o_totalprice", "source_table")


@query(
    "balanced_ranges",
    """
    WITH s AS (SELECT 'lineitem' AS tab, min(l_orderkey) AS lo, max(l_orderkey) AS hi, count(*) AS n FROM lineitem
      UNION ALL SELECT 'orders', min(o_orderkey), max(o_orderkey), count(*) FROM orders
      UNION ALL SELECT 'part', min(p_partkey), max(p_partkey), count(*) FROM part),
    t AS (SELECT *, greatest(1, ceil(sum(n) OVER () / 10.0))::BIGINT AS step FROM s),
    p AS (SELECT *, least(greatest(1, ceil(n / step::DOUBLE)), hi - lo + 1)::BIGINT AS k FROM t),
    c AS (SELECT tab, lo + (hi + 1 - lo) * i // k AS a, lo + (hi + 1 - lo) * (i + 1) // k AS z, n * (i + 1) // k - n * i // k AS part_rows, step
      FROM (SELECT *, unnest(range(k)) AS i FROM p)),
    u AS (SELECT *, sum(part_rows) OVER (ORDER BY tab, a ROWS UNBOUNDED PRECEDING) AS until FROM c)
    SELECT tab AS "table", a::BIGINT AS lo, z::BIGINT AS hi, part_rows::BIGINT AS rows, least(9, floor((until - part_rows / 2.0) / step))::BIGINT AS task FROM u
    """,
)
def balanced_ranges(t):
    def probe(df, name, key):
        return df.agg(F.lit(name).alias("table"), F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("rows"))

    sizes = probe(t.lineitem, "lineitem", "l_orderkey").unionByName(probe(t.orders, "orders", "o_orderkey")).unionByName(probe(t.part, "part", "p_partkey"))
    return r.balanced_ranges(sizes, 10)


@query("field_projection", "SELECT c_custkey, c_mktsegment FROM customer")
def field_projection(t):
    mapping = {"tableName": "customer", "fields": ["c_custkey", "c_mktsegment"]}
    return t.customer.select(*mapping["fields"])


def _stored_segments(t):
    path = scratch_path(t.spark, "segments")
    tr.write_partitioned(t.events.withColumn("date", F.to_date("ts")), path, ["date"])
    return t.spark.read.schema(t.events.schema.simpleString()[7:-1].replace(":", " ") + ", date date").parquet(path)


@query(
    "segment_scan",
    "SELECT event_id, ts, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' ORDER BY ts, event_id",
)
def segment_scan(t):
    stored = _stored_segments(t)
    days = c("date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))
    return stored.where(days).select("event_id", "ts", "event_type", "value").orderBy("ts", "event_id")


@query(
    "hive_table_scan",
    "SELECT o_orderpriority, count(*)::BIGINT AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1",
)
def hive_table_scan(t):
    sql = """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {orders}
             WHERE o_orderdate < cast(:date AS timestamp) GROUP BY o_orderpriority"""
    return jdbc.dated_rows(t.spark, sql, "1997-01-01", orders=t.orders)


@query(
    "row_key",
    """
    SELECT CASE WHEN l_linenumber <> 3 THEN l_orderkey || '_' || l_partkey || '_' || l_linenumber END AS table_pk, l_orderkey, l_partkey, l_suppkey
    FROM lineitem
    """,
)
def row_key(t):
    rows = t.lineitem.withColumn("line", F.when(c("l_linenumber") != 3, c("l_linenumber")))
    return tr.with_row_key(rows.select("l_orderkey", "l_partkey", "line", "l_suppkey"), ["l_orderkey", "l_partkey", "line"]).drop("line")


DIRTY = "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'NULL' ELSE text END"


def _dirty():
    k = c("doc_id")
    return F.when(k % 7 == 0, F.lit(None)).when(k % 13 == 0, "NULL").otherwise(c("text"))


@query(
    "clean_text_fields",
    f"""
    WITH d AS (SELECT doc_id, {DIRTY} AS v FROM documents)
    SELECT doc_id, CASE WHEN v IS NULL OR lower(v) = 'null' THEN '\\N' ELSE replace(replace(v, chr(13), ''), chr(10), '') END AS v FROM d
    """,
)
def clean_text_fields(t):
    return t.documents.select("doc_id", tr.clean_text(_dirty()).alias("v"))


@query(
    "delimited_encode",
    "SELECT c_custkey, concat_ws(chr(1), c_custkey::VARCHAR, c_custkey::VARCHAR, CASE WHEN c_custkey % 7 = 0 THEN '\\N' ELSE c_name END, c_nationkey::VARCHAR, c_acctbal::VARCHAR) AS line FROM customer",
)
def delimited_encode(t):
    rows = t.customer.select(
        "c_custkey", F.when(c("c_custkey") % 7 != 0, c("c_name")).alias("c_name"), "c_nationkey", "c_acctbal"
    )
    return rows.select("c_custkey", tr.encode_row(rows, ["c_custkey"]).alias("line"))


@query(
    "multi_target_write",
    """
    SELECT 'dw_orders' AS target_table, 'orders' AS source_table, concat_ws(chr(1), o_orderkey::VARCHAR, o_orderkey::VARCHAR, o_orderstatus, o_orderpriority) AS line FROM orders
    UNION ALL SELECT 'dw_customer', 'customer', concat_ws(chr(1), c_custkey::VARCHAR, c_custkey::VARCHAR, c_name, c_mktsegment) FROM customer
    """,
)
def multi_target_write(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    cu = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    path = scratch_path(t.spark, "targets")
    tr.write_targets(
        [
            ("dw_orders", "orders", o.select(tr.encode_row(o, ["o_orderkey"]).alias("line"))),
            ("dw_customer", "customer", cu.select(tr.encode_row(cu, ["c_custkey"]).alias("line"))),
        ],
        path,
    )
    return tr.read_targets(t.spark, path).select("target_table", "source_table", c("value").alias("line"))


LOCAL = "(ts + INTERVAL '8 hours')"


@query(
    "event_time_columns",
    f"""
    SELECT event_id, epoch_us(ts) // 1000 AS "timestamp", year({LOCAL})::INTEGER AS year, month({LOCAL})::INTEGER AS month, day({LOCAL})::INTEGER AS day,
      hour({LOCAL})::INTEGER AS hour, minute({LOCAL})::INTEGER AS minute
    FROM events
    """,
)
def event_time_columns(t):
    return t.events.select("event_id", *[x.alias(n) for n, x in tr.event_time(c("ts")).items()])


@query(
    "hourly_partition_write",
    f"""
    SELECT strftime({LOCAL}, '%Y-%m-%d') AS date, strftime({LOCAL}, '%H') AS hour,
      concat_ws(chr(1), (epoch_us(ts) // 1000)::VARCHAR, year({LOCAL})::VARCHAR, month({LOCAL})::VARCHAR, day({LOCAL})::VARCHAR, hour({LOCAL})::VARCHAR,
        minute({LOCAL})::VARCHAR, event_id::VARCHAR, CASE WHEN event_id % 7 = 0 THEN '\\N' ELSE event_type END, value::VARCHAR) AS line
    FROM events
    """,
)
def hourly_partition_write(t):
    path = scratch_path(t.spark, "hours")
    kind = F.when(c("event_id") % 7 != 0, c("event_type"))
    rows = tr.with_export_date_hour(t.events.withColumn("event_type", kind), "ts")
    line = tr.encode_event("ts", ["event_id", "event_type", "value"])
    tr.write_partitioned(rows.select(line.alias("line"), "date", "hour"), path, ["date", "hour"], fmt="text")
    return t.spark.read.schema("value string, date string, hour string").text(path).withColumnRenamed("value", "line")


@query(
    "transfer_audit",
    f"""
    WITH e AS (SELECT event_type AS source, strftime({LOCAL}, '%Y-%m-%d') AS date, strftime({LOCAL}, '%H') AS hour FROM events)
    SELECT 'source' AS level, source, NULL AS date, NULL AS hour, count(*)::BIGINT AS n FROM e GROUP BY source
    UNION ALL SELECT 'date', source, date, NULL, count(*)::BIGINT FROM e GROUP BY source, date
    UNION ALL SELECT 'hour', source, date, hour, count(*)::BIGINT FROM e GROUP BY source, date, hour
    """,
)
def transfer_audit(t):
    rows = tr.with_export_date_hour(t.events.select(c("event_type").alias("source"), "ts"), "ts")
    return tr.audit(rows.drop("ts"))


@query(
    "partition_replace",
    "SELECT event_id, ts::DATE AS date, CASE WHEN ts::DATE = DATE '2024-01-07' THEN -value ELSE value END AS value FROM events WHERE NOT (ts::DATE = DATE '2024-01-07' AND event_type = 'view') AND ts::DATE <> DATE '2024-01-09'",
)
def partition_replace(t):
    path = scratch_path(t.spark, "replace")
    rows = t.events.select("event_id", F.to_date("ts").alias("date"), "value", "event_type")
    tr.replace_partitions(rows.drop("event_type"), path, ["date"])
    again = rows.where((c("date") == F.lit("2024-01-07").cast("date")) & (c("event_type") != "view"))
    for _ in range(2):  # loading a date again changes nothing
        tr.replace_partitions(again.select("event_id", "date", (-c("value")).alias("value")), path, ["date"])
    # a reload that finds no rows leaves the date empty
    tr.replace_partitions(rows.drop("event_type").where("false"), path, ["date"], [("2024-01-09",)])
    return t.spark.read.schema("event_id long, value double, date date").parquet(path)


@query("table_replace", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def table_replace(t):
    name = f"customer_{uuid.uuid4().hex}"
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    tr.replace_table(rows, name, scratch_path(t.spark, "table"))
    return tr.replace_table(rows.where("c_acctbal > 0"), name, scratch_path(t.spark, "table"))


@query(
    "source_type_map",
    """
    SELECT l_orderkey, l_linenumber, l_quantity::DECIMAL(12,2)::VARCHAR AS l_quantity, l_returnflag, l_shipdate FROM lineitem
    """,
)
def source_type_map(t):
    types = {
        "l_orderkey": ("BIGINT",),
        "l_linenumber": ("SMALLINT",),
        "l_quantity": ("DOUBLE", 12, 2),
        "l_returnflag": ("CHAR",),
        "l_shipdate": ("TIMESTAMP",),
    }
    return ht.as_table(t.lineitem, types).withColumn("l_quantity", c("l_quantity").cast("string"))


@query("event_type_map", "SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type, trunc(value)::BIGINT AS value FROM events")
def event_type_map(t):
    return ht.as_event_table(t.events, ["event_id", "user_id", "event_type"], ["value"])


@query(
    "target_type_map",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal::DECIMAL(15,2)::VARCHAR AS c_acctbal,
      'c_custkey BIGINT, c_name VARCHAR(200), c_nationkey INT, c_acctbal DECIMAL(15,2)' AS columns
    FROM customer
    """,
)
def target_type_map(t):
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey", c("c_acctbal").cast("decimal(15,2)").alias("c_acctbal"))
    return rows.withColumns({"columns": F.lit(jdbc.column_types(rows)), "c_acctbal": c("c_acctbal").cast("string")})


@query(
    "jdbc_replace_export",
    "SELECT c_custkey, c_name, c_acctbal::DECIMAL(15,2)::VARCHAR AS c_acctbal FROM customer",
)
def jdbc_replace_export(t):
    # rows in the column types that the target gets; here the target is a table in the lake
    name = f"target_{uuid.uuid4().hex}"
    rows = t.customer.select("c_custkey", "c_name", c("c_acctbal").cast("decimal(15,2)").alias("c_acctbal"))
    tr.replace_table(rows.limit(0).select("c_custkey"), name, scratch_path(t.spark, "target"))
    sent = tr.replace_table(rows.select(*[_as_sent(*x.split(" ", 1)) for x in jdbc.column_types(rows).split(", ")]), name, scratch_path(t.spark, "target"))
    return sent.withColumn("c_acctbal", c("c_acctbal").cast("string"))


def _as_sent(name, kind):
    """A column as the target's type takes it: a text that is too long fails."""
    if not kind.startswith("VARCHAR"):
        return c(name).cast(kind).alias(name)
    long = F.length(name) > int(kind[len("VARCHAR(") : -1])
    return F.when(long, F.raise_error(F.lit(f"{name} is longer than {kind}")).cast("string")).otherwise(c(name)).alias(name)


@query(
    "jdbc_dated_export",
    "SELECT o_orderkey, o_totalprice, o_orderdate::DATE AS day FROM orders WHERE o_orderdate::DATE IN (DATE '1995-02-03', DATE '1995-02-04')",
)
def jdbc_dated_export(t):
    # delete-then-append of one date is, in the lake, the replacement of that date's partition
    sql = "SELECT o_orderkey, o_totalprice, to_date(o_orderdate) AS day FROM {orders} WHERE o_orderdate >= cast(:date AS timestamp) AND o_orderdate < cast(:date AS timestamp) + interval 1 day"
    path = scratch_path(t.spark, "dated")
    for day in ("1995-02-03", "1995-02-04", "1995-02-05", "1995-02-03"):
        tr.replace_partitions(jdbc.dated_rows(t.spark, sql, day, orders=t.orders), path, ["day"], [(day,)])
    # the last day again, from a source that has no rows of it any more
    gone = t.orders.where("false")
    tr.replace_partitions(jdbc.dated_rows(t.spark, sql, "1995-02-05", orders=gone), path, ["day"], [("1995-02-05",)])
    return t.spark.read.schema("o_orderkey long, o_totalprice double, day date").parquet(path)


@query(
    "dump_with_null_marker",
    "SELECT c_custkey || ',' || CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END || ',' || c_nationkey || ',' || c_acctbal AS line FROM customer",
)
def dump_with_null_marker(t):
    path = scratch_path(t.spark, "dump")
    rows = t.customer.select("c_custkey", F.when(c("c_custkey") % 7 != 0, c("c_name")).alias("c_name"), "c_nationkey", "c_acctbal")
    rows.write.csv(path, sep=",", nullValue="", emptyValue="")
    return t.spark.read.text(path).select(c("value").alias("line"))
