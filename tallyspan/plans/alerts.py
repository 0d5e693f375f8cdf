"""Alert queries. Every event is a request; its level follows from its type."""

from pyspark.sql import functions as F

from tallyspan.operators import alerts as al
from tallyspan.operators.ordered import with_position
from tallyspan.plans.registry import query
from tallyspan.sources import transfer as tr

c = F.col

LEVEL = "CASE event_type WHEN 'error' THEN 'fatal' WHEN 'purchase' THEN 'warn' ELSE 'info' END"
REQUESTS = f"""r AS (SELECT event_id AS request_id, user_id, event_id % 4 AS k, CASE WHEN event_id % 4 = 0 THEN 'message' ELSE 'remote_file' END AS type,
  '[' || upper({LEVEL}) || '] event ' || event_id AS subject, CASE WHEN event_id % 5 = 0 THEN 'ftp' ELSE 'sftp' END AS remote_type,
  CASE user_id % 3 WHEN 0 THEN ['ops@example.com'] WHEN 1 THEN ['ops@example.com', 'user' || user_id || '@example.com'] ELSE [] END AS tos
  FROM events)"""


def _file(rename, path, attachment, fmt="text", excel=None, sheet=None):
    return F.struct(
        F.lit("dump").alias("name"),
        rename.alias("rename"),
        path.alias("path"),
        F.lit(attachment).alias("attachment"),
        F.lit(fmt).alias("format"),
        F.lit(excel).cast("string").alias("excelName"),
        F.lit(sheet).cast("string").alias("sheetName"),
    )


def requests_of(events):
    """One request per event, on a batch or a stream."""
    uid = c("user_id").cast("string")
    user = F.concat(F.lit("user"), uid, F.lit("@example.com"))
    to = (
        F.when(c("user_id") % 3 == 0, F.array(F.lit("ops@example.com")))
        .when(c("user_id") % 3 == 1, F.array(F.lit("ops@example.com"), user))
        .otherwise(F.array().cast("array<string>"))
    )
    eid = c("event_id").cast("string")

    def path(stem, ext):
        return F.concat(F.lit(f"/out/{stem}_"), eid, F.lit(ext))

    files = F.array(
        _file(F.concat(F.lit("report_"), eid), path("report", ".csv"), True),
        _file(F.lit("x"), path("a", ".txt"), True, "excel", "book.xlsx", "first"),
        _file(F.lit("y"), path("b", ".dat"), False, "excel", "book.xlsx", "second"),
        _file(F.lit("z"), path("inline", ".TXT"), False),
    )
    k = c("event_id") % 4
    return events.select(
        c("event_id").alias("request_id"),
        F.when(k == 0, "message").otherwise("remote_file").alias("type"),
        F.concat(F.lit("user"), uid).alias("user"),
        F.when(c("event_type") == "error", "fatal").when(c("event_type") == "purchase", "warn").otherwise("info").alias("level"),
        F.concat(F.lit("event "), eid).alias("subject"),
        c("props").alias("body"),
        to.alias("to_address"),
        F.when(c("event_id") % 5 == 0, "ftp").otherwise("sftp").alias("remote_type"),
        F.when(k >= 2, files).alias("remote_files"),
    )


@query(
    "alert_outbox",
    f"""
    WITH {REQUESTS} SELECT request_id, subject, unnest(tos) AS recipient, false AS missing_recipient FROM r
    UNION ALL SELECT request_id, subject, NULL, true FROM r WHERE len(tos) = 0
    """,
)
def alert_outbox(t):
    return al.outbox(requests_of(t.events)).drop("body")


@query(
    "alert_dispatch",
    f"""
    WITH {REQUESTS} SELECT request_id, CASE WHEN type = 'remote_file' AND k >= 2 THEN CASE WHEN remote_type = 'sftp' THEN 'files' ELSE 'reject' END ELSE 'body' END AS route,
      CASE WHEN type = 'remote_file' AND k >= 2 AND remote_type <> 'sftp' THEN 'unknown remote type: ' || remote_type END AS reason FROM r
    """,
)
def alert_dispatch(t):
    return al.route(requests_of(t.events)).select("request_id", "route", "reason")


@query(
    "alert_attachments",
    f"""
    WITH {REQUESTS}, f AS (SELECT request_id FROM r WHERE k >= 2)
    SELECT request_id, 'attachment' AS use, 'report_' || request_id AS name, '/out/report_' || request_id || '.csv' AS content FROM f
    UNION ALL SELECT request_id, 'inline', NULL, '/out/inline_' || request_id || '.TXT' FROM f
    UNION ALL SELECT request_id, 'workbook', 'book.xlsx', 'first=/out/a_' || request_id || '.txt;second=/out/b_' || request_id || '.dat' FROM f
    """,
)
def alert_attachments(t):
    requests = requests_of(t.events)
    single = al.route_files(requests, [".txt", ".csv"]).where(c("use") != "sheet").select("request_id", "use", "name", c("path").alias("content"))
    sheets = F.array_join(F.transform("sheets", lambda s: F.concat_ws("=", s["sheet"], s["path"])), ";")
    books = al.workbooks(requests, [".txt", ".csv"])
    return single.unionByName(books.select("request_id", F.lit("workbook").alias("use"), c("workbook").alias("name"), sheets.alias("content")))


@query(
    "alert_size_limit",
    """
    WITH s AS (SELECT event_id, user_id, trunc(value * 1048576)::BIGINT AS size FROM events),
    r AS (SELECT *, sum(size) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS size_so_far FROM s)
    SELECT *, size_so_far <= 1073741824 AS accepted FROM r
    """,
)
def alert_size_limit(t):
    # one message per user, its attachments are the user's events
    rows = t.events.select("event_id", "user_id", (c("value") * 1048576).cast("long").alias("size"))
    return al.within_limit(rows, ["user_id"], ["event_id"], "size")


@query(
    "html_table",
    """
    WITH n AS (SELECT c_custkey, '<tr><td>' || c_custkey || '</td><td>' || c_name || '</td><td>' || n_name || '</td></tr>' AS html,
      row_number() OVER (ORDER BY c_custkey) AS i FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT (i + 1)::BIGINT AS place, html FROM n
    UNION ALL SELECT 0, '<table border="1" cellspacing="0" cellpadding="6">'
    UNION ALL SELECT 1, '<tr><th>key</th><th>name</th><th>nation</th></tr>'
    UNION ALL SELECT count(*)::BIGINT + 2, '</table>' FROM n
    """,
)
def html_table(t):
    rows = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey"))
    lines = rows.select("c_custkey", F.concat_ws(tr.SEPARATOR, c("c_custkey").cast("string"), "c_name", "n_name").alias("line"))
    placed = with_position(lines, [], ["c_custkey"], "at")
    return al.html_table("key|name|nation", placed, "line", "at")
