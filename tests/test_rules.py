"""Rules at the edges: nested filters, NaN and missing times, exact powers, mixed kinds, level points, streams of folders."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.functions import spatial as sp, transforms as x
from tallyspan.functions.expr import case_searched, case_simple, double, fn, if_, long, text
from tallyspan.functions.granularity import granularity
from tallyspan.operators import aggregate as a
from tallyspan.sources import ranges as r
from tallyspan.streaming.rollup import rollup_available
from tallyspan.streaming.sinks import stream_table

c = F.col


def test_nested_filters_all_count(spark):
    df = spark.range(100)
    agg = a.filtered(a.filtered(a.filtered(a.count("n"), c("id") < 50), c("id") % 2 == 0), c("id") >= 10)
    assert df.agg(agg.partial).first()[0] == 20


def test_nan_and_missing_times(spark):
    rows = [(1, "a", 3.0), (None, "b", 7.0), (2, "c", float("nan")), (3, "d", None)]
    df = spark.createDataFrame(rows, "ts int, tie string, v double")
    low, high = a.double_min("low", c("v")), a.double_max("high", c("v"))
    first, last = a.double_first("first", c("v"), "ts", "tie"), a.double_last("last", c("v"), "ts", "tie")
    got = df.agg(*[g.partial.alias(g.name) for g in (low, high, first, last)]).first()
    assert np.isnan(got.low) and np.isnan(got.high) and got.first == 3.0 and got.last == 0.0
    assert df.where("ts = 1").agg(low.partial.alias("low")).first().low == 3.0
    assert np.isnan(df.groupBy("ts").agg(low.partial.alias("low")).agg(low.combine(c("low"))).first()[0])


def test_list_dimensions(spark):
    df = spark.createDataFrame([(["a", "b"], "x"), (["b", "a"], "x"), (["a", "b"], "b"), (None, "y"), ([], None)], "l array<string>, s string")
    by_row = df.agg(a.cardinality_by_row("n", [a.list_text(c("l"))], rounded=True).partial.alias("n")).select(F.round(F.hll_sketch_estimate("n"))).first()[0]
    assert by_row == 3
    assert a.pooled_cardinality(df, [], "n", ["s"], ["l"], rounded=True).first().n == 5
    assert a.pooled_cardinality(df.where("s = 'x'"), ["s"], "n", [], ["l"], rounded=True).first().n == 2


@pytest.mark.parametrize("base,power", [(3, 39), (10, 19), (2, 63), (-3, 41), (7, 1000), (5, 0), (0, 0), (0, 5), (-1, 7), (2, -1), (1, -9), (3, 2**40)])
def test_long_powers_are_exact_and_wrap(spark, base, power):
    want = {1: 1, -1: -1 if power % 2 else 1}.get(base, 0) if power < 0 else (pow(base, power, 1 << 64) + (1 << 63)) % (1 << 64) - (1 << 63)
    df = spark.createDataFrame([(base, power)], "a long, n long")
    assert df.select((long("a") ** long("n")).col).first()[0] == want


def test_mixed_kinds(values):
    got = values(
        [
            fn("round", double(0.49999999999999994)).col, fn("round", double(2.5)).col, fn("round", double(-2.5)).col, fn("sqrt", if_(1, 4, 2.5)).col,
            long(1).and_("abc").col, text("x").or_(2).col, (case_searched(0, 1, 1, 2.5, 3) / 2).col, (case_simple(2, 1, 10, 2, 20.5) / 2).col,
            if_(0, "a", 1).col, (double(1.0) / double(-0.0)).col,
        ]
    )[0]
    assert got == (0, 3, -2, 2.0, "abc", "2", 1.25, 10.25, "1", float("-inf"))


def test_polygon_counts_corners_once(spark):
    diamond = ([0, 1, 0, -1], [-1, 0, 1, 0])
    points = [(0.5, 0.0), (0.5, 0.1), (-0.5, 0.0), (1.0, 0.0), (0.0, -1.0), (0.5, 0.5), (1.5, 0.0), (-1.5, 0.0), (0.9, 0.9), (0.0, 0.0)]
    df = spark.createDataFrame([(i, list(p)) for i, p in enumerate(points)], "id int, at array<float>")
    got = sorted(q["id"] for q in df.where(sp.in_polygon(c("at"), *diamond)).collect())
    assert got == [0, 1, 2, 3, 4, 5, 9]
    square = ([0, 2, 2, 0], [0, 0, 2, 2])
    assert [q["id"] for q in df.where(sp.in_polygon(c("at"), *square)).orderBy("id").collect()] == [0, 1, 3, 5, 6, 8, 9]


def test_conflicting_mapping_fails(spark):
    m = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2"), ("b", "3")], "k string, v string")
    df = spark.createDataFrame([("a",)], "k string")
    assert x.lookup(df, "k", m.where("k = 'a'"), "k", "v", "out").first()["out"] == "1"
    with pytest.raises(Exception, match="two values for the key b"):
        x.lookup(spark.createDataFrame([("b",)], "k string"), "k", m, "k", "v", "out").collect()


def test_ranges_over_all_longs(spark):
    top = 2**63 - 1
    tables = spark.createDataFrame([("wide", -top, top - 1, 1000), ("one", 5, 5, 10)], "table string, lo long, hi long, rows long")
    out = sorted((q["lo"], q["hi"]) for q in r.balanced_ranges(tables, 4).where("table = 'wide'").collect())
    assert out[0][0] == -top and out[-1][1] == top and all(p[1] == q[0] for p, q in zip(out, out[1:]))
    assert r.hash_predicates("name", 2, "CRC32(name)")[0] == "MOD(MOD(CRC32(name), 2) + 2, 2) = 0"


def test_streams_of_folders_and_of_nothing(spark, t, tmp_path):
    aggs = lambda: [a.count("n")]
    hour = granularity("hour")
    want = {(q["bucket"], q["n"]) for q in rollup_available(stream_table(spark, t.sf_dir, "events"), "ts", hour, [], aggs()).collect()}
    t.events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    t.events.limit(1).write.parquet(str(tmp_path / "events_old.parquet"))
    got = {(q["bucket"], q["n"]) for q in rollup_available(stream_table(spark, str(tmp_path), "events"), "ts", hour, [], aggs()).collect()}
    assert got == want and sum(n for _, n in got) == t.events.count()
    (tmp_path / "none" / "events.parquet").mkdir(parents=True)
    assert rollup_available(stream_table(spark, str(tmp_path / "none"), "events"), "ts", hour, [], aggs()).collect() == []
