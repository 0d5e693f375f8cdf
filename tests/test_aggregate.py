import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyspan.functions.granularity import granularity
from tallyspan.operators import aggregate as a
from tallyspan.operators import postagg as p
from tallyspan.operators import rollup as r
from tallyspan.operators.scripted import scripted_aggregate
from tallyspan.session import cluster_settings
from tallyspan.streaming.rollup import rollup_available, rollup_stream
from tallyspan.streaming.sinks import run_available, stream_table

from conftest import SF_DIR

c = F.col


def one(df, *aggs):
    states = df.agg(*[x.partial.alias(x.name) for x in aggs])
    return states.select(*[x.final().alias(x.name) for x in aggs]).first()


def test_nulls_and_identities(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "l long, d double")
    got = one(
        df, a.count("n"), a.long_sum("ls", c("l")), a.double_sum("ds", c("d")), a.float_sum("fs", c("d")), a.long_min("lmin", c("l")),
        a.long_max("lmax", c("l")), a.double_min("dmin", c("d")), a.double_max("dmax", c("d")), a.float_min("fmin", c("d")), a.float_max("fmax", c("d")),
    )
    assert got["n"] == 2 and got["ls"] == 0 and got["ds"] == 0.0 and got["fs"] == 0.0
    assert got["lmin"] == 2**63 - 1 and got["lmax"] == -(2**63)
    assert got["dmin"] == got["fmin"] == math.inf and got["dmax"] == got["fmax"] == -math.inf


def test_empty_input(spark):
    got = one(spark.range(0), a.count("n"), a.long_sum("s", c("id")), a.long_min("m", c("id")), a.filtered(a.count("f"), c("id") > 1))
    assert tuple(got) == (0, 0, 2**63 - 1, 0)


def test_filtered_null_predicate_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, True), (3, False)], "v long, p boolean")
    got = one(df, a.filtered(a.long_sum("s", c("v")), c("p")), a.filtered(a.long_max("m", c("v")), c("v") > 9), a.filtered(a.count("n"), c("p")))
    assert tuple(got) == (2, -(2**63), 1)


def test_first_last_ties_and_null_value(spark):
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame([(t0, 2, 20.0), (t0, 1, None), (t1, 7, 5.0), (t1, 8, 6.0)], "ts timestamp, id long, v double")
    assert tuple(one(df, a.double_first("f", c("v"), "ts", "id"), a.double_last("l", c("v"), "ts", "id"))) == (0.0, 6.0)
    assert tuple(one(df, a.long_last("l", c("v"), "ts", "id", state=True))) == (6,)
    with pytest.raises(ValueError):
        a.double_first("f", c("v"), "ts", "id").combine(c("f"))


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.0, 1.5, 2.0, 2.1, 9.0)], "v double")
    h = one(df, a.histogram("h", c("v"), [1.0, 2.0, 3.0]))["h"]
    # (..1] hidden, (1,2] has 1.5 and 2.0, (2,3] has 2.1, above hidden
    assert h["breaks"] == [1.0, 2.0, 3.0] and h["counts"] == [2.0, 1.0] and h["quantiles"] == [0.5, 9.0]


def test_cardinality_counts_null_and_lists_as_values(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, None), ("a", "x")], "p string, q string")
    assert one(df, a.cardinality_by_row("n", [c("p"), c("q")], rounded=True))["n"] == 3
    assert one(df, a.cardinality_by_value("n", [c("p"), c("q")], rounded=True))["n"] == 3


def test_sketch_error_on_many_values(spark):
    df = spark.range(200000).select((c("id") % 60000).alias("u"))
    assert abs(one(df, a.hyper_unique("n", c("u")))["n"] - 60000) < 60000 * 0.05


def test_scripted_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select(F.when(c("id") % 3 > 0, "hot").otherwise("cold").alias("k"), c("id").alias("v"))
    out = scripted_aggregate(df, ["k"], ["v"], "m", lambda: -1.0, lambda s, rows: max(s, float(rows["v"].max())), max)
    assert {x["k"]: x["m"] for x in out.collect()} == {"hot": 4999.0, "cold": 4998.0}


def test_post_aggregators(values):
    lit = F.lit
    got = values(
        [
            p.arithmetic("/", [lit(1), lit(0)]), p.arithmetic("-", [lit(9), lit(2), lit(3)]), p.arithmetic("quotient", [lit(1), lit(0)]),
            p.arithmetic("quotient", [lit(-1), lit(0)]), p.arithmetic("/", [lit(8), lit(2), lit(0), lit(3)]),
            p.double_greatest([lit(1), lit(2.5)]), p.long_least([lit(4), lit(3.9)]),
        ]
    )[0]
    assert got == (0.0, 4.0, math.inf, -math.inf, 0.0, 2.5, 3)
    assert math.isnan(values([p.arithmetic("quotient", [lit(0), lit(0)])])[0][0])
    with pytest.raises(ValueError):
        p.arithmetic("+", [lit(1)])
    with pytest.raises(ValueError):
        p.arithmetic("^", [lit(1), lit(2)])


def test_post_validate():
    class A:
        def __init__(self, name):
            self.name = name

    p.validate([A("n"), A("s")], {"m": ["n", "s"], "k": ["m"]})
    for aggs, post in (([A("n"), A("n")], {}), ([A("n")], {"m": ["x"]}), ([A("n")], {"n": []}), ([A("n")], {"k": ["m"], "m": ["n"]})):
        with pytest.raises(ValueError):
            p.validate(aggs, post)


def aggregators():
    return [
        a.count("n"), a.long_sum("s", c("user_id")), a.double_max("top", c("value")),
        a.double_first("first", c("value"), "ts", "event_id", state=True), a.long_last("last", c("user_id"), "ts", "event_id", state=True),
        a.hyper_unique("users", c("user_id")), a.histogram("h", c("value"), [5.0, 50.0]), a.filtered(a.count("big"), c("value") > 30),
    ]


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_re_rollup_equals_direct(spark, t):
    day, hour = granularity("day"), granularity("hour")
    direct = r.rollup(t.events, "ts", day, ["event_type"], aggregators())
    parts = [r.rollup(t.events.where(c("event_id") % 3 == i), "ts", hour, ["event_type"], aggregators(), finish=False) for i in range(3)]
    assert rows_of(r.re_rollup(parts, ["event_type"], aggregators(), day)) == rows_of(direct)


def test_stream_equals_batch(spark, t):
    hour, floor = granularity("hour"), "2024-01-04 00:30:00"
    batch = r.rollup(t.events, "ts", hour, ["event_type"], aggregators(), min_time=floor)
    streamed = rollup_available(stream_table(spark, SF_DIR, "events"), "ts", hour, ["event_type"], aggregators(), min_time=floor)
    assert rows_of(streamed) == rows_of(batch)


def test_stream_in_many_batches_equals_batch(spark, t, tmp_path):
    # newest days first: rows of later batches are far behind
    for i in reversed(range(4)):
        t.events.where(F.floor(F.dayofmonth("ts") / 8) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    day = granularity("day")
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, cluster_settings(1, 1)[key])
    try:
        got = rollup_available(stream, "ts", day, ["event_type"], aggregators())
    finally:
        spark.conf.set(key, old)
    assert rows_of(got) == rows_of(r.rollup(t.events, "ts", day, ["event_type"], aggregators()))


def test_endless_stream_emits_complete_buckets(spark, t, tmp_path):
    # in append mode the last bucket waits for the watermark to pass its end
    for i in range(4):
        t.events.where(F.floor(F.dayofmonth("ts") / 8) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    day, aggs = granularity("day"), [a.count("n")]
    states = rollup_stream(stream, "ts", day, ["event_type"], aggs, delay="1 day")
    run_available(states, str(tmp_path / "out"), "append")
    want = {str(x) for x in rows_of(r.rollup(t.events, "ts", day, ["event_type"], aggs))}
    got = rows_of(spark.read.parquet(str(tmp_path / "out")).drop("_batch"))
    assert 0 < len(got) < len(want) and set(got) <= want and len(set(got)) == len(got)


def test_discover_dims(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1, 2.0, ["a"])], "ts timestamp, k long, m double, tags array<string>")
    assert dict(r.discover_dims(df, "ts", ["m"]).dtypes) == {"ts": "timestamp", "m": "double", "k": "string", "tags": "array<string>"}


def test_scripted_sees_every_row(spark):
    seen = scripted_aggregate(spark.range(1000).withColumn("k", F.lit(1)), ["k"], ["id"], "n", lambda: 0.0, lambda s, x: s + len(x), lambda x, y: x + y)
    assert seen.first()["n"] == 1000.0
