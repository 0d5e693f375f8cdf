from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspan.functions import granularity as g
from tallyspan.functions import timeparse as tp
from tallyspan.operators import intervals as iv


def at(text):
    return F.lit(text).cast("timestamp")


def d(text):
    return datetime.fromisoformat(text)


def test_parse_period():
    assert g.parse_period("P1Y2M3W4DT5H6M7.5S") == {"years": 1, "months": 2, "weeks": 3, "days": 4, "hours": 5, "minutes": 6, "seconds": 7, "millis": 500}
    for bad in ("P", "1D", "PT"):
        with pytest.raises(ValueError):
            g.parse_period(bad)


def test_clock_changes_in_new_york(values):
    day, hour, three = g.Period("P1D", "America/New_York"), g.Period("PT1H", "America/New_York"), g.Period("P3D", "America/New_York")
    # 2024-03-10 has 23 hours, 2024-11-03 has 25: its 05:30Z and 06:30Z both read 01:30
    got = values(
        [
            day.start(at("2024-03-10 12:00:00")), day.end(at("2024-03-10 12:00:00")),
            day.start(at("2024-11-03 12:00:00")), day.end(at("2024-11-03 12:00:00")),
            hour.start(at("2024-11-03 05:30:00")), hour.start(at("2024-11-03 06:30:00")),
            three.end(at("2024-03-10 12:00:00")),
        ]
    )[0]
    assert got[:6] == (
        d("2024-03-10 05:00"), d("2024-03-11 04:00"), d("2024-11-03 04:00"), d("2024-11-04 05:00"), d("2024-11-03 05:00"), d("2024-11-03 06:00"),
    )
    assert got[6].hour == 4  # local midnight in summer time


def test_origins(values):
    months = g.Period("P3M", origin="2020-02-10 00:00:00")
    got = values(
        [months.start(at("2024-02-09 00:00:00")), months.start(at("2024-02-10 00:00:00")), months.start(at("2019-12-01 00:00:00")),
         g.Period("P2W").start(at("2024-01-10 00:00:00")), g.Period("P2Y").start(at("2025-06-01 00:00:00")),
         g.Duration(86400000, "2024-01-01 06:00:00").start(at("2023-12-31 05:00:00"))]
    )[0]
    assert got == (d("2023-11-10"), d("2024-02-10"), d("2019-11-10"), d("2024-01-04"), d("2024-01-01") , d("2023-12-30 06:00"))


def test_compound_needs_stepping(spark, values):
    with pytest.raises(ValueError):
        g.Period("P1M1D").start(at("2024-01-01"))
    assert values([g.Period("P1DT6H").start(at("1970-01-02 07:00:00"))]) == [(d("1970-01-02 06:00"),)]
    df = spark.createDataFrame([(d("2024-03-05"),), (d("2023-12-31"),)], "ts timestamp")
    out = g.with_stepped_bucket(df, "ts", g.Period("P1M1D", origin="2024-01-31 00:00:00"), "b").orderBy("ts").collect()
    # 01-31 → 02-29 + 1 day = 03-01; backwards 01-31 → 12-31 - 1 day = 12-30
    assert [r["b"] for r in out] == [d("2023-12-30"), d("2024-03-01")]


def test_covering(values):
    got = values([g.granularity("month").covering(at("2024-01-15"), at("2024-03-01")), g.granularity("five_minute").covering(at("2024-01-01 00:03:00"), at("2024-01-01 00:10:00"))])[0]
    assert got[0] == [d("2024-01-01"), d("2024-02-01")]
    assert got[1] == [d("2024-01-01 00:00"), d("2024-01-01 00:05")]


def test_finer():
    assert g.finer_granularities("ten_minute") == ["ten_minute", "five_minute", "minute", "second"]
    assert g.finer_granularities("all")[0] == "year" and g.finer_granularities("none") == []


def test_paths(values):
    p = F.lit("/x/y=2024/m=05/d=06/H=07/f.gz")
    got = values([g.path_to_time(p, "hour"), g.path_to_time(p, "month"), g.path_to_time(p, "minute"), g.path_to_time(F.lit("/x/dt=2024-05-06-07/f"), "day", "hive")])[0]
    assert got == (d("2024-05-06 07:00"), d("2024-05-01"), None, d("2024-05-06"))


def test_parsers(values):
    lit = F.lit
    got = values(
        [
            tp.parse_auto(lit("1704067200123")), tp.parse_auto(lit('"2024-01-01 10:20 UTC"')), tp.parse_auto(lit("2024-01-01T10:00:00+02:00")),
            tp.parse_auto(lit("soon")), tp.parse_iso(lit("2024-01")), tp.timestamp_parser("posix")(lit("60")), tp.timestamp_parser("nano")(lit("1999999")),
            tp.timestamp_parser("ruby")(lit("12.9")), tp.timestamp_parser("dd/MM/yyyy")(lit("03/02/2024")), tp.with_default(tp.parse_auto(lit(None).cast("string")), "2000-01-01"),
        ]
    )[0]
    assert got == (
        d("2024-01-01 00:00:00.123"), d("2024-01-01 10:20"), d("2024-01-01 08:00"), None, d("2024-01-01"), d("1970-01-01 00:01"),
        d("1970-01-01 00:00:00.001"), d("1970-01-01 00:00:12"), d("2024-02-03"), d("2000-01-01"),
    )


def brute_condense(spans):
    out = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_condense_hot_group(spark, slices, seed):
    import random

    rnd = random.Random(seed)
    base = d("2024-01-01")
    rows = []
    for i in range(600):
        key = "hot" if i % 3 else f"k{i % 40}"
        lo = base + timedelta(minutes=rnd.randrange(0, 60000))
        rows.append((key, lo, lo + timedelta(minutes=rnd.choice([1, 5, 60, 2000]))))
    df = spark.createDataFrame(rows, "k string, start timestamp, end timestamp")
    got = {}
    for r in iv.condense(df, ["k"]).collect():
        got.setdefault(r["k"], []).append((r["start"], r["end"]))
    want = {}
    for k, lo, hi in rows:
        want.setdefault(k, []).append((lo, hi))
    assert {k: sorted(v) for k, v in got.items()} == {k: brute_condense(v) for k, v in want.items()}


def test_touching_intervals_merge_and_long_ones_span_slices(spark, slices):
    base = d("2024-01-01")
    rows = [(base, base + timedelta(days=400))] + [(base + timedelta(days=i), base + timedelta(days=i + 1)) for i in range(1, 500)]
    df = spark.createDataFrame(rows, "start timestamp, end timestamp")
    assert [tuple(r) for r in iv.condense(df, []).collect()] == [(base, base + timedelta(days=500))]


def test_overlap_edges(spark, slices):
    base = d("2024-01-01")
    h = lambda n: base + timedelta(hours=n)
    left = spark.createDataFrame([("a", 1, h(0), h(1)), ("a", 2, h(1), h(2)), ("a", 3, h(5), h(9)), ("b", 4, h(0), h(9)), ("a", 5, h(2), h(3))], "k string, id int, start timestamp, end timestamp")
    right = spark.createDataFrame([("a", h(1), h(2)), ("a", h(6), h(7)), ("c", h(0), h(9))], "k string, start timestamp, end timestamp")
    # touching is not overlapping
    assert sorted(r["id"] for r in iv.overlapping(left, right, ["k"]).collect()) == [2, 3]


def test_interval_table_against_brute_force(spark, slices, t):
    table = spark.createDataFrame([(d("2024-01-02"), d("2024-01-03")), (d("2024-01-02 12:00"), d("2024-01-04")), (d("2024-01-10"), d("2024-01-10 06:00"))], "start timestamp, end timestamp")
    got = [sorted(r[0] for r in iv.in_interval_table(t.events, "ts", table, cell).select("event_id").collect()) for cell in ("hour", "day", "month")]
    lo, hi = d("2024-01-02"), d("2024-01-04")
    want = sorted(r["event_id"] for r in t.events.collect() if lo <= r["ts"] < hi or d("2024-01-10") <= r["ts"] < d("2024-01-10 06:00"))
    assert got == [want] * 3
    assert iv.in_interval_table(t.events, "ts", table.where("false")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 199, 200, 201, 5000])
def test_any_number_of_intervals_has_one_plan(t, n):
    base = d("2024-01-02")
    spans = [(base + timedelta(minutes=7 * i), base + timedelta(minutes=7 * i + 3)) for i in range(n)]
    out = iv.in_intervals(t.events, "ts", spans)
    want = sorted(r["event_id"] for r in t.events.collect() if any(a <= r["ts"] < z for a, z in spans))
    assert sorted(r["event_id"] for r in out.collect()) == want
    pushed = out._jdf.queryExecution().executedPlan().toString().split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_overlap_against_brute_force(spark, slices):
    import random

    rnd = random.Random(11)
    base = d("2024-01-01")

    def spans(n):
        out = []
        for i in range(n):
            lo = base + timedelta(minutes=rnd.randrange(0, 3000))
            out.append(("hot" if i % 3 else f"k{i % 7}", i, lo, lo + timedelta(minutes=rnd.choice([0, 1, 5, 200]))))
        return out

    left, right = spans(500), spans(80)
    schema = "k string, id int, start timestamp, end timestamp"
    got = iv.overlapping(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema).drop("id"), ["k"]).collect()
    want = [i for k, i, a, z in left if a < z and any(k == k2 and a < z2 and a2 < z and a2 < z2 for k2, _, a2, z2 in right)]
    assert sorted(r["id"] for r in got) == want


def test_intervals_shuffle_once_and_write_nothing(spark, monkeypatch):
    """One exchange of the rows, none by range, and the exchanges of one row per cell."""
    from tallyspan.operators import intervals

    monkeypatch.setattr(intervals, "materialise", None)
    rows = spark.range(1000).select((F.col("id") % 5).alias("k"), F.timestamp_seconds(F.col("id") * 997).alias("start"), F.timestamp_seconds(F.col("id") * 1009 + 50).alias("end"))
    for out in (iv.condense(rows, ["k"]), iv.overlapping(rows, rows, ["k"])):
        assert out.count() > 0
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan


def test_null_groups_and_any_cell(spark):
    base = d("2024-01-01")
    rows = [(k, base + timedelta(hours=7 * i), base + timedelta(hours=7 * i + 9 - 4 * (i % 3))) for i in range(200) for k in (None, "a")]
    df = spark.createDataFrame(rows, "k string, start timestamp, end timestamp")
    want = sorted(brute_condense([(a, z) for k, a, z in rows if k is None]))
    for cell in ("hour", "day", "month", "year"):
        got = {}
        for r in iv.condense(df, ["k"], cell=cell).collect():
            got.setdefault(r["k"], []).append((r["start"], r["end"]))
        assert sorted(got[None]) == want and sorted(got["a"]) == want
        assert iv.overlapping(df, df.where("k is null"), ["k"], cell=cell).count() == 200
    assert iv.condense(df.limit(0), ["k"]).count() == 0
