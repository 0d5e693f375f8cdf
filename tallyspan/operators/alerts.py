"""Alert outbox: requests become outbox rows, files are routed, results are rendered as HTML rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Attachment limit of one message in bytes; layout of rendered tables; the request
# type and remote type that are served; separators of header and data cells in a result dump.
SIZE_LIMIT = 1024 * 1024 * 1024
TABLE_OPEN = '<table border="1" cellspacing="0" cellpadding="6">'
TABLE_CLOSE = "</table>"
FILE_REQUEST = "remote_file"
REMOTE_TYPES = ("sftp",)
HEADER_SEPARATOR = "|"
CELL_SEPARATOR = "\u0001"


def subject(level: Column, text: Column) -> Column:
    return F.concat(F.lit("["), F.upper(level), F.lit("] "), text)


def outbox(requests: DataFrame, keep: list[str] = ("request_id",)) -> DataFrame:
    """One row per recipient; a request without recipients gives one flagged row.

    Row by row, so it runs unchanged on a stream.
    """
    rows = requests.select(
        *keep,
        subject(F.col("level"), F.col("subject")).alias("subject"),
        "body",
        F.explode_outer("to_address").alias("recipient"),
    )
    return rows.withColumn("missing_recipient", F.col("recipient").isNull())


def route(requests: DataFrame) -> DataFrame:
    """Which way a request goes: ``files``, ``body`` only, or ``reject`` with the reason."""
    has_files = F.coalesce(F.size("remote_files"), F.lit(0)) > 0
    known = F.coalesce(F.col("remote_type").isin(*REMOTE_TYPES), F.lit(False))
    is_files = (F.col("type") == FILE_REQUEST) & has_files
    way = F.when(is_files & known, "files").when(is_files, "reject").otherwise("body")
    reason = F.when(is_files & ~known, F.concat(F.lit("unknown remote type: "), F.coalesce("remote_type", F.lit("none"))))
    return requests.withColumns({"route": way, "reason": reason})


def route_files(requests: DataFrame, body_extensions: list[str]) -> DataFrame:
    """One row per file with its use: ``attachment``, ``sheet`` of a workbook, or ``inline`` table."""
    accepted = [e.lower() for e in body_extensions]
    rows = requests.select("request_id", F.posexplode("remote_files").alias("pos", "f"))
    extension = F.concat(F.lit("."), F.lower(F.regexp_extract(F.col("f.path"), r"\.([^./]*)$", 1)))
    attach = F.coalesce(F.col("f.attachment"), F.lit(True)) | ~extension.isin(*accepted)
    use = F.when(attach & (F.col("f.format") == "excel"), "sheet").when(attach, "attachment").otherwise("inline")
    return rows.select(
        "request_id",
        "pos",
        use.alias("use"),
        F.when(use == "attachment", F.col("f.rename")).when(use == "sheet", F.col("f.excelName")).alias("name"),
        F.when(use == "sheet", F.col("f.sheetName")).alias("sheet"),
        F.col("f.path").alias("path"),
    )


def workbooks(requests: DataFrame, body_extensions: list[str]) -> DataFrame:
    """Sheets per (request, workbook) in file order. A group is part of one request's file list."""
    sheets = route_files(requests, body_extensions).where(F.col("use") == "sheet")
    listed = F.array_sort(F.collect_list(F.struct("pos", "sheet", "path")))
    return sheets.groupBy("request_id", F.col("name").alias("workbook")).agg(
        F.transform(listed, lambda s: F.struct(s["sheet"].alias("sheet"), s["path"].alias("path"))).alias("sheets")
    )


def within_limit(attachments: DataFrame, message: list[str], order: list[str], size: str, limit: int = SIZE_LIMIT) -> DataFrame:
    """Running attachment size per message and whether it still is within the limit."""
    from tallyspan.operators.ordered import with_running

    rows = with_running(attachments, message, order, "size_so_far", F.col(size))
    return rows.withColumn("accepted", F.col("size_so_far") <= limit)


def _row(cells: Column, tag: str) -> Column:
    inner = F.array_join(F.transform(cells, lambda x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag}>"))), "")
    return F.concat(F.lit("<tr>"), inner, F.lit("</tr>"))


def html_row(line: Column, is_header: Column) -> Column:
    """One line of a dump as a table row; header cells are split by a bar, data cells by \\001.

    Empty cells at the end of a line are dropped, as a plain split does.
    """

    def cells(separator):
        trimmed = F.regexp_replace(line, f"(?:{separator})+$", "")
        return F.split(trimmed, separator)

    return F.when(is_header, _row(cells("\\|"), "th")).otherwise(_row(cells(CELL_SEPARATOR), "td"))


def html_table(header: str, lines: DataFrame, column: str, place: str) -> DataFrame:
    """``place, html`` rows of the whole table: opening, header, one row per line, closing.

    ``place`` is the 0-based position of each line; the parts only need to be written in order.
    """
    spark = lines.sparkSession
    body = lines.select((F.col(place) + 2).alias("place"), html_row(F.col(column), F.lit(False)).alias("html"))
    one = spark.range(1)
    head = one.select(F.lit(0).cast("long").alias("place"), F.lit(TABLE_OPEN).alias("html")).unionByName(
        one.select(F.lit(1).cast("long").alias("place"), html_row(F.lit(header), F.lit(True)).alias("html"))
    )
    foot = lines.agg((F.count(F.lit(1)) + 2).alias("place")).select("place", F.lit(TABLE_CLOSE).alias("html"))
    return head.unionByName(body).unionByName(foot)
