"""Select queries: filters, projections, virtual columns, buckets, paging, merging."""

from pyspark.sql import functions as F

from tallyspan.functions import expr as e
from tallyspan.functions.granularity import granularity
from tallyspan.operators import intervals as iv
from tallyspan.operators import paging
from tallyspan.operators import select as s
from tallyspan.operators.ordered import Desc, with_position
from tallyspan.plans.registry import query

c = F.col


@query(
    "select_events",
    """
    SELECT ts AS __time, event_type, value, NULL::BIGINT AS event_id, NULL::BIGINT AS user_id, NULL AS props FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12' AND event_type <> 'view'
    UNION ALL SELECT ts, event_type, value, event_id, user_id, props FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21'
    """,
)
def select_events(t):
    # empty lists mean all columns
    whole = s.select_events(t.events, "ts", [_span("2024-01-20", "2024-01-21")])
    return _chosen(t).unionByName(whole, allowMissingColumns=True)


def _chosen(t):
    return s.select_events(
        t.events, "ts", [_span("2024-01-05", "2024-01-12")], ["event_type"], ["value"], s.value_is_not(t.events, "event_type", "view")
    )


def _span(lo, hi):
    from datetime import datetime

    return datetime.fromisoformat(lo), datetime.fromisoformat(hi)


@query(
    "interval_filter",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1996-03-01' AND l_shipdate < TIMESTAMP '1997-03-01'
    """,
)
def interval_filter(t):
    rows = t.lineitem.where(iv.within(c("l_shipdate"), "1996-03-01", "1997-03-01"))
    return rows.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")


@query(
    "multi_interval_filter",
    """
    SELECT event_id, ts, 'literal' AS how FROM events WHERE (ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-06')
      OR (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-07 12:00:00') OR (ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-20 01:00:00')
    UNION ALL
    SELECT event_id, ts, 'table' AS how FROM events e WHERE EXISTS (
      SELECT 1 FROM events x WHERE x.event_type = 'error' AND e.ts >= x.ts AND e.ts < x.ts + INTERVAL '2 minutes')
    """,
)
def multi_interval_filter(t):
    spans = [_span("2024-01-03", "2024-01-06"), _span("2024-01-05", "2024-01-07T12:00:00"), _span("2024-01-20", "2024-01-20T01:00:00")]
    rows = t.events.select("event_id", "ts")
    given = iv.in_intervals(rows, "ts", spans)
    # the intervals as data: two minutes after every error
    table = t.events.where(c("event_type") == "error").select(c("ts").alias("start"), F.expr("ts + interval 2 minutes").alias("end"))
    found = iv.in_interval_table(rows, "ts", table)
    return given.withColumn("how", F.lit("literal")).unionByName(found.withColumn("how", F.lit("table")))


DAY = "strftime(ts, 'events_%Y-%m-%d')"


def _by_day(t):
    return t.events.withColumn("segment", F.concat(F.lit("events_"), F.date_format("ts", "yyyy-MM-dd")))


@query(
    "segment_list_filter",
    f"""
    WITH busy AS (SELECT {DAY} AS segment FROM events GROUP BY 1 HAVING count(*) FILTER (WHERE event_type = 'error') > count(*) FILTER (WHERE event_type = 'view'))
    SELECT event_id, {DAY} AS segment, value FROM events WHERE {DAY} IN (SELECT segment FROM busy)
    """,
)
def segment_list_filter(t):
    rows = _by_day(t)
    # the list of segments as data: days with more errors than views
    named = rows.groupBy("segment").agg(F.count_if(c("event_type") == "error").alias("n"), F.count_if(c("event_type") == "view").alias("m")).where("n > m")
    return rows.join(named, "segment", "left_semi").select("event_id", "segment", "value")


LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
FLAG = "CASE WHEN l_linenumber = 4 THEN NULL ELSE l_returnflag END"


def _lines(t):
    return t.lineitem.withColumn("flag", F.when(c("l_linenumber") != 4, c("l_returnflag")))


@query(
    "filter_and",
    f"SELECT {', '.join(LINE)} FROM lineitem WHERE l_quantity < 10 AND l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1997-01-01'",
)
def filter_and(t):
    p = s.all_of(c("l_quantity") < 10, c("l_returnflag") == "R", c("l_shipdate") >= F.lit("1997-01-01").cast("timestamp"))
    return t.lineitem.where(p).select(*LINE)


@query("filter_or", f"SELECT {', '.join(LINE)} FROM lineitem WHERE coalesce({FLAG} = 'A', false) OR l_quantity > 45")
def filter_or(t):
    rows = _lines(t)
    return rows.where(s.any_of(s.value_is(rows, "flag", "A"), c("l_quantity") > 45)).select(*LINE)


@query("filter_not", f"SELECT {', '.join(LINE)} FROM lineitem WHERE NOT coalesce({FLAG} = 'A', false)")
def filter_not(t):
    rows = _lines(t)
    return rows.where(s.value_is_not(rows, "flag", "A")).select(*LINE)


@query("filter_true", "SELECT o_orderkey, o_custkey FROM orders WHERE true")
def filter_true(t):
    return t.orders.where(s.always()).select("o_orderkey", "o_custkey")


@query("filter_false", "SELECT count(*)::BIGINT AS n FROM orders WHERE false")
def filter_false(t):
    return t.orders.where(s.never()).agg(F.count(F.lit(1)).alias("n"))


# first words of a text as a multi-value dimension is a fixture of the tests; here all words of it are used
WORDS = "regexp_split_to_array(text, '[ \\n]+')"


def _words(t):
    return t.documents.select("doc_id", "lang", F.split("text", "[ \\n]+").alias("words"))


@query(
    "filter_value_match",
    f"""
    WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END AS p FROM orders)
    SELECT id, 'value' AS how FROM o WHERE p = '2-HIGH'
    UNION ALL SELECT id, 'null' FROM o WHERE p IS NULL OR p = ''
    UNION ALL SELECT doc_id, 'any' FROM documents WHERE list_contains({WORDS}, 'the')
    """,
)
def filter_value_match(t):
    k = c("o_orderkey")
    o = t.orders.select(k.alias("id"), F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, "").otherwise(c("o_orderpriority")).alias("p"))
    w = _words(t)
    parts = {
        "value": o.where(s.value_is(o, "p", "2-HIGH")),
        "null": o.where(s.value_is(o, "p", None)),
        "any": w.where(s.value_is(w, "words", "the")).select(c("doc_id").alias("id")),
    }
    return s.union_all([d.select("id", F.lit(how).alias("how")) for how, d in parts.items()])


@query(
    "filter_predicate",
    f"""
    SELECT p_partkey AS id, 'part' AS how FROM part WHERE length(p_name) > 10 AND p_name LIKE '%e%'
    UNION ALL SELECT doc_id, 'word' FROM documents WHERE len(list_filter({WORDS}, lambda w: length(w) > 22)) > 0
    """,
)
def filter_predicate(t):
    w = _words(t)
    part = t.part.where(s.value_like(t.part, "p_name", lambda v: (F.length(v) > 10) & v.like("%e%")))
    long_words = w.where(s.value_like(w, "words", lambda v: F.length(v) > 22))
    return part.select(c("p_partkey").alias("id"), F.lit("part").alias("how")).unionByName(
        long_words.select(c("doc_id").alias("id"), F.lit("word").alias("how"))
    )


@query(
    "dim_rename",
    """
    SELECT c_custkey::VARCHAR AS customer, n_name AS nation_name, n_regionkey::DOUBLE AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def dim_rename(t):
    rows = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey"))
    return rows.select(s.dimension("c_custkey", "customer"), s.dimension("n_name", "nation_name"), s.dimension("n_regionkey", "region", "double"))


@query(
    "dim_list_filtered",
    f"""
    SELECT doc_id, array_to_string(list_filter({WORDS}, lambda w: w IN ('the', 'en', 'de')), ' ') AS kept,
      len(list_filter({WORDS}, lambda w: w NOT IN ('the', 'en', 'de')))::INTEGER AS others
    FROM documents
    """,
)
def dim_list_filtered(t):
    listed = ["the", "en", "de"]
    return _words(t).select(
        "doc_id",
        F.array_join(s.list_filtered(c("words"), listed), " ").alias("kept"),
        F.size(s.list_filtered(c("words"), listed, keep=False)).alias("others"),
    )


@query(
    "dim_regex_filtered",
    f"SELECT doc_id, array_to_string(list_filter({WORDS}, lambda w: regexp_full_match(w, '[a-e]+')), ' ') AS kept FROM documents",
)
def dim_regex_filtered(t):
    return _words(t).select("doc_id", F.array_join(s.regex_filtered(c("words"), "[a-e]+"), " ").alias("kept"))


@query(
    "multivalue_normalise",
    f"""
    WITH w AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN {WORDS} || [NULL] ELSE {WORDS} END AS v FROM documents)
    SELECT doc_id, md5(array_to_string(list_transform(list_sort(v, 'ASC', 'NULLS FIRST'), lambda x: coalesce(x, '~')), ' ')) AS sorted_array,
      md5(array_to_string(list_transform(list_sort(list_distinct(v) || CASE WHEN doc_id % 5 = 0 THEN [NULL] ELSE [] END, 'ASC', 'NULLS FIRST'), lambda x: coalesce(x, '~')), ' ')) AS sorted_set,
      md5(array_to_string(list_transform(v, lambda x: coalesce(x, '~')), ' ')) AS as_given
    FROM w
    """,
)
def multivalue_normalise(t):
    v = F.when(c("doc_id") % 5 == 0, F.concat(c("words"), F.array(F.lit(None).cast("string")))).otherwise(c("words"))
    w = _words(t).withColumn("v", v)
    shown = {"sorted_array": "SORTED_ARRAY", "sorted_set": "SORTED_SET", "as_given": "ARRAY"}
    return w.select("doc_id", *[F.md5(F.array_join(s.normalised(c("v"), p), " ", "~")).alias(n) for n, p in shown.items()])


SOME_LIST = "CASE doc_id % 4 WHEN 0 THEN [lang] WHEN 1 THEN [lang, source] WHEN 2 THEN [] ELSE NULL END"


def _some_list():
    k = c("doc_id") % 4
    return F.when(k == 0, F.array("lang")).when(k == 1, F.array("lang", "source")).when(k == 2, F.array().cast("array<string>"))


@query(
    "multivalue_scalarise",
    f"""
    WITH w AS (SELECT doc_id, {SOME_LIST} AS v FROM documents)
    SELECT doc_id, CASE len(v) WHEN 1 THEN v[1] WHEN 2 THEN '[' || v[1] || ', ' || v[2] || ']' END AS v FROM w
    """,
)
def multivalue_scalarise(t):
    return t.documents.select("doc_id", s.scalarised(_some_list()).alias("v"))


@query(
    "dimension_strings",
    f"""
    WITH w AS (SELECT doc_id, {SOME_LIST} AS v, CASE WHEN doc_id % 3 <> 0 THEN n_chars END AS n FROM documents)
    SELECT doc_id, coalesce(len(v), 0)::INTEGER AS size, coalesce(array_to_string(v, '|'), '') AS listed, coalesce(n::VARCHAR, '') AS scalar FROM w
    """,
)
def dimension_strings(t):
    listed = s.strings_of(_some_list(), True)
    scalar = s.strings_of(F.when(c("doc_id") % 3 != 0, c("n_chars")), False)
    return t.documents.select("doc_id", F.size(listed).alias("size"), F.array_join(listed, "|").alias("listed"), F.array_join(scalar, "|").alias("scalar"))


@query(
    "group_key",
    f"""
    WITH w AS (SELECT TIMESTAMP '2024-01-01' + to_days((doc_id % 30)::INTEGER) AS ts, lang, {SOME_LIST} AS tags FROM documents)
    SELECT ts, lang, array_to_string(list_sort(list_distinct(CASE WHEN len(tags) > 0 THEN tags END)), '|') AS tags, count(*)::BIGINT AS n FROM w GROUP BY 1, 2, 3
    """,
)
def group_key(t):
    at = F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=(c("doc_id") % 30).cast("int"))
    w = t.documents.select(at.alias("ts"), "lang", _some_list().alias("tags"))
    groups = w.groupBy(s.group_key(w, c("ts"), ["tags", "lang"]).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return groups.select("key.ts", F.element_at("key.lang", 1).alias("lang"), F.array_join("key.tags", "|").alias("tags"), "n")


@query(
    "virtual_columns",
    f"""
    SELECT {', '.join(LINE)}, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross,
      l_quantity::FLOAT::DOUBLE AS qty_float
    FROM lineitem
    """,
)
def virtual_columns(t):
    price, cut, tax = e.double("l_extendedprice"), e.double("l_discount"), e.double("l_tax")
    columns = [
        ("gross", (e.double("net") * (e.double(1.0) + tax)).col, ["net", "l_tax"]),
        ("net", (price * (e.double(1.0) - cut)).col, ["l_extendedprice", "l_discount"]),
        ("qty_float", c("l_quantity").cast("float").cast("double"), ["l_quantity"]),
    ]
    return s.with_virtual_columns(t.lineitem, columns).select(*LINE, "net", "gross", "qty_float")


@query(
    "time_bucketed_select",
    """
    WITH b AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01' - INTERVAL '1 microsecond', INTERVAL '5 minutes')) AS bucket),
    r AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS bucket, event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01')
    SELECT bucket, event_id, value FROM b LEFT JOIN r USING (bucket)
    """,
)
def time_bucketed_select(t):
    return s.bucketed_select(t.events.select("ts", "event_id", "value"), "ts", granularity("five_minute"), "2024-01-01", "2024-02-01").drop("ts")


PAGED = f"r AS (SELECT *, {DAY} AS segment FROM events)"


@query(
    "select_paged",
    f"""
    WITH {PAGED}, n AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY ts, event_id) - 1 AS o FROM r)
    SELECT segment, event_id, value, o::BIGINT AS paging_offset, 'shallow' AS depth FROM n
    WHERE o >= CASE WHEN segment = 'events_2024-01-03' THEN 20 WHEN segment = 'events_2024-01-04' THEN 6 ELSE 0 END
      AND o < CASE WHEN segment = 'events_2024-01-03' THEN 30 WHEN segment = 'events_2024-01-04' THEN 16 ELSE 10 END
    UNION ALL
    SELECT segment, event_id, value, o::BIGINT, 'deep' FROM n WHERE o >= 100 AND o < 5100
    UNION ALL
    SELECT segment, event_id, value, o::BIGINT, 'bucket' FROM (
      SELECT *, row_number() OVER (PARTITION BY segment, time_bucket(INTERVAL '6 hours', ts) ORDER BY ts, event_id) - 1 AS o FROM r) WHERE o >= 3 AND o < 8
    """,
)
def select_paged(t):
    rows = _by_day(t).select("segment", "ts", "event_id", "value")
    shallow = s.page(rows, ["segment"], "ts", "event_id", {"events_2024-01-03": 19, "events_2024-01-04": 5}, 10)
    # stored cursors as a table: every segment goes on after offset 99
    cursors = rows.select("segment").distinct().withColumn("paging_offset", F.lit(99))
    deep = s.page(rows, ["segment"], "ts", "event_id", cursors, 5000)
    # a page per segment and granularity bucket, each with its own stored cursor
    bucketed = rows.withColumn("bucket", granularity("six_hour").start(c("ts")))
    stored = bucketed.select("segment", "bucket").distinct().withColumn("paging_offset", F.lit(2))
    per_bucket = s.page(bucketed, ["segment", "bucket"], "ts", "event_id", stored, 5)
    shown = ["segment", "event_id", "value", "paging_offset"]
    return per_bucket.select(*shown, F.lit("bucket").alias("depth")).unionByName(_depths(shallow, deep, shown))


def _depths(shallow, deep, shown):
    return shallow.select(*shown, F.lit("shallow").alias("depth")).unionByName(deep.select(*shown, F.lit("deep").alias("depth")))


@query(
    "select_paged_desc",
    f"""
    WITH {PAGED}, n AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY ts DESC, event_id DESC) AS o FROM r)
    SELECT segment, event_id, value, (-o)::BIGINT AS paging_offset FROM n
    WHERE o > CASE WHEN segment = 'events_2024-01-03' THEN 12 ELSE 0 END AND o <= CASE WHEN segment = 'events_2024-01-03' THEN 22 ELSE 10 END
    """,
)
def select_paged_desc(t):
    rows = _by_day(t).select("segment", "ts", "event_id", "value")
    return s.page(rows, ["segment"], "ts", "event_id", {"events_2024-01-03": -12}, 10, descending=True).drop("ts")


def _bucket_sql(descending):
    """Two pages of 25 rows of every (part, day), the first from a stored cursor."""
    way, sign = (" DESC", "-1 - ") if descending else ("", "")
    return f"""
    SELECT part, bucket, event_id, value, ({sign}o)::BIGINT AS paging_offset, ((o - stored) // 25 + 1)::INTEGER AS page_number FROM (
      SELECT *, row_number() OVER (PARTITION BY part, bucket ORDER BY ts{way}, event_id{way}) - 1 AS o,
        CASE WHEN part = 1 AND bucket = TIMESTAMP '2024-01-05' THEN 3 WHEN part = 1 THEN 10 WHEN part = 2 AND bucket = TIMESTAMP '2024-01-06' THEN 1 ELSE 0 END AS stored
      FROM (SELECT (event_id % 3)::INTEGER AS part, date_trunc('day', ts)::TIMESTAMP AS bucket, ts, event_id, value FROM events)) WHERE o >= stored AND o < stored + 50
    """


def _bucket_pages(t, descending):
    rows = t.events.select((c("event_id") % 3).cast("int").alias("part"), "ts", "event_id", "value")
    # a row without a bucket is for all buckets of its part that have no row of their own
    stored = [(1, "2024-01-05", 2), (1, None, 9), (2, "2024-01-06", 0)]
    stored = [(part, day, -at - 1 if descending else at) for part, day, at in stored]
    cursor = t.spark.createDataFrame(stored, "part int, day string, paging_offset long").select("part", c("day").cast("timestamp").alias("bucket"), "paging_offset")
    index = paging.PageIndex.of(rows, ["part"], "ts", "event_id", granularity("day"), descending)
    pages = [page for page, _ in paging.read_on(index, 25, cursor, most_pages=2)]
    out = s.union_all([page.withColumn("page_number", F.lit(i + 1)) for i, page in enumerate(pages)])
    return out.select("part", "bucket", "event_id", "value", "paging_offset", "page_number")


@query("select_paged_buckets", _bucket_sql(False))
def select_paged_buckets(t):
    return _bucket_pages(t, False)


@query("select_paged_buckets_desc", _bucket_sql(True))
def select_paged_buckets_desc(t):
    return _bucket_pages(t, True)


@query(
    "merge_bucket_pages",
    """
    WITH n AS (SELECT *, row_number() OVER (PARTITION BY part, bucket ORDER BY ts, event_id) - 1 AS o
      FROM (SELECT (event_id % 3)::INTEGER AS part, date_trunc('day', ts)::TIMESTAMP AS bucket, ts, event_id FROM events))
    SELECT bucket, part, event_id, o::BIGINT AS paging_offset FROM (
      SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY ts, part, o) AS place FROM n WHERE o < 25) WHERE place <= 25
    """,
)
def merge_bucket_pages(t):
    rows = t.events.select((c("event_id") % 3).cast("int").alias("part"), "ts", "event_id")
    page = paging.PageIndex.of(rows, ["part"], "ts", "event_id", granularity("day")).page(None, 25)
    return paging.merge_pages(page, "ts", ["part"], 25).select("bucket", "part", "event_id", "paging_offset")


@query(
    "paging_identifiers",
    f"WITH {PAGED} SELECT segment, least(count(*), 25)::BIGINT - 1 AS paging_offset FROM r GROUP BY 1",
)
def paging_identifiers(t):
    rows = _by_day(t).select("segment", "ts", "event_id")
    return s.paging_identifiers(s.page(rows, ["segment"], "ts", "event_id", None, 25), ["segment"])


@query(
    "merge_topk",
    f"""
    WITH {PAGED}, n AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY ts, event_id) - 1 AS o FROM r)
    SELECT ts, segment, o::BIGINT AS paging_offset, event_id FROM n WHERE o < 20 ORDER BY ts, segment, o LIMIT 250
    """,
)
def merge_topk(t):
    rows = _by_day(t).select("segment", "ts", "event_id")
    pages = s.page(rows, ["segment"], "ts", "event_id", None, 20)
    return s.merge_pages(pages, "ts", "segment", 250).select("ts", "segment", "paging_offset", "event_id")


@query(
    "order_desc",
    "SELECT o_orderkey, o_orderdate, (row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) - 1)::BIGINT AS place FROM orders",
)
def order_desc(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return with_position(rows, [], [Desc("o_orderdate"), Desc("o_orderkey")], "place")


@query("union_all", f"SELECT {', '.join(LINE)} FROM lineitem")
def union_all(t):
    half = c("l_shipdate") < F.lit("1998-01-01").cast("timestamp")
    return s.union_all([t.lineitem.where(half).select(*LINE), t.lineitem.where(s.none_of(half)).select(*LINE)])


@query("ordered_merge", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey")
def ordered_merge(t):
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return s.ordered_merge([rows.where("o_orderkey % 2 = 0"), rows.where("o_orderkey % 2 <> 0")], ["o_orderdate", "o_orderkey"])


@query("limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def limit(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
