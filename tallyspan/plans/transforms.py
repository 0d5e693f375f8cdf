"""Dimension transforms over whole tables."""

from pyspark.sql import functions as F

from tallyspan.functions import transforms as x
from tallyspan.functions.granularity import granularity
from tallyspan.plans.registry import query

c = F.col
NULL_NAME = "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN '' ELSE p_name END"


def _null_name():
    k = c("p_partkey")
    return F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, "").otherwise(c("p_name"))


@query(
    "extract_regex",
    f"""
    WITH n AS (SELECT p_partkey, {NULL_NAME} AS v FROM part)
    SELECT p_partkey, CASE WHEN regexp_matches(coalesce(v, ''), '^(\\w+) b') THEN regexp_extract(v, '^(\\w+) b', 1) ELSE nullif(v, '') END AS kept,
      CASE WHEN regexp_matches(coalesce(v, ''), '(\\w+) (\\w+)$') THEN regexp_extract(v, '(\\w+) (\\w+)$', 2) ELSE 'none' END AS replaced,
      CASE WHEN regexp_matches(coalesce(v, ''), '^(\\w+) b') THEN regexp_extract(v, '^(\\w+) b', 1) END AS nulled
    FROM n
    """,
)
def extract_regex(t):
    n = _null_name()
    return t.part.select(
        "p_partkey",
        x.regex(r"^(\w+) b")(n).alias("kept"),
        x.regex(r"(\w+) (\w+)$", 2, True, "none")(n).alias("replaced"),
        x.regex(r"^(\w+) b", 1, True)(n).alias("nulled"),
    )


@query("extract_partial", "SELECT p_partkey, CASE WHEN regexp_matches(p_type, 'O.*D|AL') THEN p_type END AS v FROM part")
def extract_partial(t):
    return t.part.select("p_partkey", x.partial("O.*D|AL")(c("p_type")).alias("v"))


@query(
    "extract_time_format",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%A, %d %B %Y') AS long_text,
      strftime(o_orderdate AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Shanghai', '%Y-%m-%d %H') AS shanghai,
      strftime(date_trunc('month', o_orderdate), '%Y-%m-%dT%H:%M:%S.000Z') AS month_iso,
      epoch_ms(date_trunc('week', o_orderdate)::TIMESTAMP)::VARCHAR AS week_millis,
      ['lundi', 'mardi', 'mercredi', 'jeudi', 'vendredi', 'samedi', 'dimanche'][isodow(o_orderdate)] || strftime(o_orderdate, ', %d.%m.%Y') AS french
    FROM orders
    """,
)
def extract_time_format(t):
    d = c("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        x.time_format("EEEE, dd MMMM yyyy")(d).alias("long_text"),
        x.time_format("yyyy-MM-dd HH", "Asia/Shanghai")(d).alias("shanghai"),
        x.time_format(gran=granularity("month"))(d).alias("month_iso"),
        x.time_format(gran=granularity("week"), as_millis=True)(d).alias("week_millis"),
        x.time_format("EEEE, dd.MM.yyyy", locale="fr-FR")(d).alias("french"),
    )


# the small name tables are joined to the facts, so that the work grows with the data
@query(
    "extract_identity",
    "SELECT c_custkey, n_nationkey::VARCHAR AS key_text, n_name AS name_text FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def extract_identity(t):
    rows = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey"))
    return rows.select("c_custkey", x.identity()(c("n_nationkey")).alias("key_text"), x.identity()(c("n_name")).alias("name_text"))


@query(
    "extract_substring",
    """
    SELECT c_custkey, substr(c_name, 10) AS tail, substr(c_name, 1, 4) AS head, c_name AS zero, NULL::VARCHAR AS past,
      nullif(substr(c_mktsegment, 9), '') AS maybe
    FROM customer
    """,
)
def extract_substring(t):
    n = c("c_name")
    return t.customer.select(
        "c_custkey",
        x.substring(9)(n).alias("tail"),
        x.substring(0, 4)(n).alias("head"),
        x.substring(0, 0)(n).alias("zero"),
        x.substring(40, 2)(n).alias("past"),
        x.substring(8)(c("c_mktsegment")).alias("maybe"),
    )


@query(
    "extract_cascade",
    "SELECT c_custkey, 'id-' || lower(substr(regexp_extract(c_name, '#(\\d+)$', 1), 4)) AS v FROM customer",
)
def extract_cascade(t):
    chain = x.cascade(x.regex(r"#(\d+)$"), x.substring(3), x.lower(), x.string_format("id-%s"))
    return t.customer.select("c_custkey", chain(c("c_name")).alias("v"))


@query(
    "extract_string_format",
    """
    WITH s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_name END AS v FROM supplier)
    SELECT s_suppkey, '[' || coalesce(v, 'null') || ']' AS as_text, '[' || coalesce(v, '') || ']' AS as_empty, '[' || v || ']' AS as_null FROM s
    """,
)
def extract_string_format(t):
    v = F.when(c("s_suppkey") % 7 != 0, c("s_name"))
    return t.supplier.select(
        "s_suppkey",
        x.string_format("[%s]")(v).alias("as_text"),
        x.string_format("[%s]", "emptyString")(v).alias("as_empty"),
        x.string_format("[%s]", "returnNull")(v).alias("as_null"),
    )


@query("extract_upper", f"SELECT p_partkey, nullif(upper({NULL_NAME}), '') AS v, upper(replace(p_type, 'i', 'İ')) AS turkish FROM part")
def extract_upper(t):
    return t.part.select("p_partkey", x.upper()(_null_name()).alias("v"), x.upper("tr-TR")(c("p_type")).alias("turkish"))


@query("extract_lower", "SELECT p_partkey, lower(p_type) AS v, lower(p_brand) AS brand, lower(replace(p_type, 'I', 'ı')) AS turkish FROM part")
def extract_lower(t):
    return t.part.select("p_partkey", x.lower()(c("p_type")).alias("v"), x.lower()(c("p_brand")).alias("brand"), x.lower("tr")(c("p_type")).alias("turkish"))


@query(
    "extract_bucket",
    """
    SELECT p_partkey, (floor(p_retailprice / 100) * 100)::BIGINT::VARCHAR AS hundred, (floor((p_size - 3) / 10.0) * 10 + 3)::BIGINT::VARCHAR AS shifted,
      CASE WHEN floor(p_size / 2.5::DOUBLE) * 2.5::DOUBLE = trunc(floor(p_size / 2.5::DOUBLE) * 2.5::DOUBLE)
        THEN (floor(p_size / 2.5::DOUBLE) * 2.5::DOUBLE)::BIGINT::VARCHAR ELSE (floor(p_size / 2.5::DOUBLE) * 2.5::DOUBLE)::VARCHAR END AS halves,
      NULL::VARCHAR AS bad
    FROM part
    """,
)
def extract_bucket(t):
    return t.part.select(
        "p_partkey",
        x.bucket(100)(c("p_retailprice")).alias("hundred"),
        x.bucket(10, 3)(c("p_size").cast("string")).alias("shifted"),
        x.bucket(2.5)(c("p_size")).alias("halves"),
        x.bucket()(c("p_name")).alias("bad"),
    )


@query("extract_strlen", f"SELECT p_partkey, coalesce(length({NULL_NAME}), 0)::VARCHAR AS v FROM part")
def extract_strlen(t):
    return t.part.select("p_partkey", x.strlen()(_null_name()).alias("v"))


@query(
    "extract_lookup",
    """
    WITH m AS (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 <> 0)
    SELECT c_custkey, r_name AS plain, coalesce(r_name, c_nationkey::VARCHAR) AS kept, coalesce(r_name, 'elsewhere') AS replaced
    FROM customer LEFT JOIN m ON c_nationkey = n_nationkey
    """,
)
def extract_lookup(t):
    m = t.nation.join(t.region, c("n_regionkey") == c("r_regionkey")).where(c("n_nationkey") % 4 != 0)
    out = x.lookup(t.customer, "c_nationkey", m, "n_nationkey", "r_name", "plain")
    out = x.lookup(out, "c_nationkey", m, "n_nationkey", "r_name", "kept", retain_missing=True)
    out = x.lookup(out, "c_nationkey", m, "n_nationkey", "r_name", "replaced", replace_with="elsewhere")
    return out.select("c_custkey", "plain", "kept", "replaced")


@query(
    "time_as_dimension",
    "SELECT strftime(ts, '%a %H') AS slot, count(*)::BIGINT AS n FROM events GROUP BY 1",
)
def time_as_dimension(t):
    return t.events.groupBy(x.time_format("EEE HH")(c("ts")).alias("slot")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "numeric_as_dimension",
    """
    SELECT l_linenumber::VARCHAR AS line, (floor(l_quantity / 10) * 10)::BIGINT::VARCHAR AS quantity_band, count(*)::BIGINT AS n
    FROM lineitem GROUP BY 1, 2
    """,
)
def numeric_as_dimension(t):
    return t.lineitem.groupBy(
        x.identity()(c("l_linenumber")).alias("line"), x.bucket(10)(c("l_quantity").cast("string")).alias("quantity_band")
    ).agg(F.count(F.lit(1)).alias("n"))
