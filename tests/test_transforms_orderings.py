import pytest
from pyspark.sql import functions as F

from tallyspan.functions import orderings as o
from tallyspan.functions import transforms as x
from tallyspan.functions.granularity import granularity


def test_transform_rules(values):
    rows = [("foo-12",), ("",), (None,), ("zz",)]
    c = F.col("v")
    got = values(
        [
            x.regex(r"-(\d+)$")(c),
            x.regex(r"-(\d+)$", 1, True, "none")(c),
            x.partial(r"\d")(c),
            x.substring(1, 2)(c),
            x.substring(0, 0)(c),
            x.string_format("<%s>")(c),
            x.string_format("<%s>", "returnNull")(c),
            x.strlen()(c),
            x.cascade(x.regex(r"^([a-z]+)"), x.upper(), x.substring(0, 1))(c),
        ],
        rows,
        "v string",
    )
    assert got == [
        ("12", "12", "foo-12", "oo", "foo-12", "<foo-12>", "<foo-12>", "6", "F"),
        (None, "none", None, None, None, "<>", "<>", "0", None),
        (None, "none", None, None, None, "<null>", None, "0", None),
        ("zz", "none", None, "z", "zz", "<zz>", "<zz>", "2", "Z"),
    ]


def test_bucket(values):
    c = F.col("v")
    got = values([x.bucket(10, 3)(c), x.bucket(2.5)(c), x.bucket()(c)], [("14.2",), ("-1",), ("x",), (None,)], "v string")
    assert got == [("13", "12.5", "14"), ("-7", "-2.5", "-1"), (None, None, None), (None, None, None)]


def test_time_format(values):
    ts = F.lit("2024-03-10 23:30:00").cast("timestamp")
    got = values([x.time_format()(ts), x.time_format("HH:mm", "Asia/Kolkata")(ts), x.time_format(gran=granularity("day"), as_millis=True)(ts)])
    assert got == [("2024-03-10T23:30:00.000Z", "05:00", "1710028800000")]
    with pytest.raises(ValueError):
        x.time_format(zone="Asia/Kolkata", as_millis=True)


def test_each_and_errors(values):
    assert values([x.each(x.upper())(F.array(F.lit("a"), F.lit("")))]) == [(["A", None],)]
    with pytest.raises(ValueError):
        x.substring(-1)
    with pytest.raises(ValueError):
        x.string_format("%s", "other")


def test_lookup_options(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    m = spark.createDataFrame([("a", "A")], "k string, v string")
    with pytest.raises(ValueError):
        x.lookup(left, "k", m, "k", "v", "out", retain_missing=True, replace_with="z")
    got = {r["k"]: r["out"] for r in x.lookup(left, "k", m, "k", "v", "out", retain_missing=True).collect()}
    assert got == {"a": "A", "b": "b", None: None}


def ordered(spark, texts, key):
    df = spark.createDataFrame([(v,) for v in texts], "v string")
    return [r[0] for r in df.orderBy(key(F.col("v"))).collect()]


def test_alphanumeric(spark):
    # digits before letters, runs of digits by value, case ignored, zeros break ties, then length
    want = [None, "", "1", "01", "2", "10", "a", "A1", "a2", "a02", "a10", "a10b", "b"]
    got = ordered(spark, list(reversed(want)), o.alphanumeric)
    assert got == want
    # other digits count as digits: ٣ is 3
    assert ordered(spark, ["a٣", "a10", "a2"], o.alphanumeric) == ["a2", "a٣", "a10"]


def test_numeric_and_strlen(spark):
    assert ordered(spark, ["10", "9", "x", None, "1e1", "-3.5", "abc", "9.99"], o.numeric)[:5] == [None, "abc", "x", "-3.5", "9"]
    big = ["9223372036854775808", "9223372036854775807", "9223372036854775806"]
    assert ordered(spark, big, o.numeric) == list(reversed(big))
    assert ordered(spark, ["bb", "a", "ab", None, ""], o.strlen) == [None, "", "a", "ab", "bb"]
