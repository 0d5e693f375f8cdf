import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyspan.functions import hivetypes as ht
from tallyspan.sources import jdbc, ranges as r, transfer as tr

c = F.col


@given(st.integers(-(10**12), 10**12), st.integers(0, 10**6), st.integers(1, 200))
def test_ranges_cover_exactly(lo, length, n):
    hi = lo + length
    parts = r.ranges(lo, hi, n)
    assert len(parts) <= n and parts[0][0] == lo and parts[-1][1] == hi + 1
    assert all(a < b for a, b in parts) and all(x[1] == y[0] for x, y in zip(parts, parts[1:]))


def test_ranges_corner_cases():
    assert r.ranges(5, 4, 3) == []
    assert r.ranges(0, 0, 10) == [(0, 1)]
    with pytest.raises(ValueError):
        r.ranges(0, 5, 0)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=40), st.integers(1, 7))
def test_every_row_falls_under_one_predicate(spark, keys, n):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    known = [k for k in keys if k is not None]
    by_range = r.range_predicates("k", r.ranges(min(known), max(known), n) if known else [])
    for predicates in (by_range, r.hash_predicates("k", n)):
        hits = df.select(sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0)).alias("h")).collect()
        assert all(x["h"] == 1 for x in hits)


def test_split_key():
    assert r.default_split_key("k", ["id"]) == "k"
    assert r.default_split_key("", ["Id"]) == "Id"
    assert r.default_split_key(None, ["id", "x"]) is None
    assert r.default_split_key(None, ["key"]) is None


def test_balanced_ranges(spark):
    tables = spark.createDataFrame([("big", 1, 1000, 9000), ("a", 5, 5, 30), ("b", 0, 9, 40), ("c", -5, 5, 20), ("none", 0, 0, 0)], "table string, lo long, hi long, rows long")
    rows = r.balanced_ranges(tables, 6).collect()
    assert {x["task"] for x in rows} <= set(range(6))
    by = {}
    for x in rows:
        by.setdefault(x["table"], []).append(x)
    assert set(by) == {"big", "a", "b", "c"} and len(by["big"]) > 3
    for name, lo, hi, n in (("big", 1, 1000, 9000), ("a", 5, 5, 30), ("b", 0, 9, 40), ("c", -5, 5, 20)):
        parts = sorted((x["lo"], x["hi"]) for x in by[name])
        assert parts[0][0] == lo and parts[-1][1] == hi + 1 and all(p[1] == q[0] for p, q in zip(parts, parts[1:]))
        assert sum(x["rows"] for x in by[name]) == n
    load = {}
    for x in rows:
        load[x["task"]] = load.get(x["task"], 0) + x["rows"]
    assert max(load.values()) <= 2 * 9090 / 6


def test_encoding(values):
    rows = [("k1", 2, "a\r\nb", "NULL"), ("k1", None, None, "x")]
    schema = "p string, q int, v string, w string"
    df_cols = [tr.row_key(["p", "q"]), tr.clean_text(c("v")), tr.clean_text(c("w"))]
    assert values(df_cols, rows, schema) == [("k1_2", "ab", "\\N"), (None, "\\N", "x")]


def test_encoded_line_keeps_keys_uncleaned(spark):
    df = spark.createDataFrame([("a\nb", None, "c\nd")], "p string, q string, v string")
    assert df.select(tr.encode_row(df, ["p", "q"])).first()[0] == "\u0001".join(["null", "a\nb", "null", "cd"])


def test_types():
    assert [ht.table_type(x) for x in ("TINYINT", "VARCHAR", "DATE", "FLOAT")] == ["int", "string", "date", "decimal(38,4)"]
    assert [ht.database_type(x) for x in ("string", "bigint", "tinyint", "timestamp", "decimal(9,2)", "binary")] == ["VARCHAR(200)", "BIGINT", "INT", "DATETIME", "DECIMAL(9,2)", "VARCHAR(200)"]


def test_replace_partitions_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    tr.replace_partitions(spark.range(10).withColumn("p", c("id") % 2), path, ["p"])
    tr.replace_partitions(spark.range(100, 102).withColumn("p", F.lit(1).cast("long")), path, ["p"])
    tr.replace_partitions(spark.range(100, 102).withColumn("p", F.lit(1).cast("long")), path, ["p"])
    assert sorted(x["id"] for x in spark.read.parquet(path).collect()) == [0, 2, 4, 6, 8, 100, 101]
    tr.replace_partitions(spark.range(0).withColumn("p", c("id") % 2), path, ["p"], [(1,), (7,)])
    assert sorted(x["id"] for x in spark.read.parquet(path).collect()) == [0, 2, 4, 6, 8]


def test_replace_table(spark, tmp_path):
    tr.replace_table(spark.range(5), "replaced", str(tmp_path / "1"))
    assert tr.replace_table(spark.range(2), "replaced", str(tmp_path / "2")).count() == 2
    with pytest.raises(Exception, match="broken"):
        tr.replace_table(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), "replaced", str(tmp_path / "3"))
    assert spark.table("replaced").count() == 2
    wider = tr.replace_table(spark.range(3).withColumn("x", c("id")), "replaced", str(tmp_path / "4"))
    assert wider.columns == ["id", "x"] and spark.table("replaced").count() == 3
    spark.sql("DROP TABLE replaced")


def test_audited_write(spark, tmp_path):
    df = spark.range(100).withColumn("p", c("id") % 3)
    assert tr.write_audited(df, str(tmp_path / "t"), ["p"]) == 100
    counts = {tuple(x)[:4]: x["n"] for x in tr.audit(df.select(F.lit("s").alias("source"), F.lit("d").alias("date"), c("p").cast("string").alias("hour"))).collect()}
    assert counts[("source", "s", None, None)] == 100 and counts[("date", "s", "d", None)] == 100 and counts[("hour", "s", "d", "0")] == 34


def test_wildcards(spark):
    assert tr.like_pattern("orders_1997", "ORDERS_%") and not tr.like_pattern("x_orders", "orders%")
    assert tr.like_pattern("t_[a]", "t_[a]") and not tr.like_pattern("t_a", "t_[a]") and not tr.like_pattern("tab", "t?b")
    spark.range(2).createOrReplaceTempView("part_a")
    spark.range(3).createOrReplaceTempView("part_b")
    got = tr.wildcard_union(spark, "part_%").groupBy("source_table").count().collect()
    assert {x[0]: x[1] for x in got} == {"part_a": 2, "part_b": 3}
    with pytest.raises(ValueError):
        tr.wildcard_union(spark, "no_such_%")


def test_export_dates(spark):
    from datetime import date

    assert jdbc.export_date("1970-01-01", date(2024, 3, 1)) == "2024-02-29"
    assert jdbc.export_date("2024-01-05") == "2024-01-05"
    rows = jdbc.dated_rows(spark, "SELECT :date AS d, count(*) AS n FROM {x}", "2024-01-05' OR '1'='1", x=spark.range(4))
    assert tuple(rows.first()) == ("2024-01-05' OR '1'='1", 4)
