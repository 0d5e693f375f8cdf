from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspan.functions.granularity import granularity
from tallyspan.operators import select as s
from tallyspan.operators.ordered import Desc, with_position, with_running

c = F.col


@pytest.fixture(scope="module")
def rows(spark):
    # segment "hot" holds two thirds of the rows; a third of all rows share one time
    base = datetime(2024, 1, 1)
    data = []
    for i in range(900):
        seg = "hot" if i % 3 else f"s{i % 5}"
        ts = base if i % 3 == 1 else base + timedelta(minutes=(i * 37) % 500)
        data.append((seg, ts, i))
    return spark.createDataFrame(data, "segment string, ts timestamp, id long").repartition(7)


def expected(rows, descending=False):
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r["ts"], r["id"]), reverse=descending):
        out.setdefault(r["segment"], []).append(r["id"])
    return out


def ids(page, descending=False):
    out = {}
    for r in sorted(page.collect(), key=lambda r: r["paging_offset"], reverse=descending):
        out.setdefault(r["segment"], []).append(r["id"])
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("cell", ["minute", "hour", "year"])
def test_pages_joined_equal_the_whole(rows, descending, cell):
    want, got, cursor = expected(rows, descending), {}, None
    for _ in range(4):
        page = s.page(rows, ["segment"], "ts", "id", cursor, 170, descending=descending, cell=cell).cache()
        for k, v in ids(page, descending).items():
            got.setdefault(k, []).extend(v)
        new = {r["segment"]: r["paging_offset"] for r in s.paging_identifiers(page, ["segment"], descending).collect()}
        cursor = s.merge_cursors([cursor or {}, new])
        page.unpersist()
    assert got == want


def test_cursor_table_equals_cursor_dict(spark, rows):
    d = {"hot": 40, "s0": 3}
    table = spark.createDataFrame(list(d.items()), "segment string, paging_offset long")
    assert ids(s.page(rows, ["segment"], "ts", "id", d, 25)) == ids(s.page(rows, ["segment"], "ts", "id", table, 25))


def test_offsets(rows):
    want = expected(rows)
    assert ids(s.page(rows, ["segment"], "ts", "id", {"hot": 5}, 3, from_next=False))["hot"] == want["hot"][5:8]
    with pytest.raises(ValueError):
        s.page(rows, ["segment"], "ts", "id", {"hot": -5}, 3)
    wrong = rows.sparkSession.createDataFrame([("hot", -5)], "segment string, paging_offset long")
    with pytest.raises(Exception, match="sign of an offset"):
        s.page(rows, ["segment"], "ts", "id", wrong, 3).collect()
    assert s.next_cursor({"a": 4}) == {"a": 5} and s.next_cursor({"a": -4}, True) == {"a": -5}


def test_merge_pages(rows):
    page = s.page(rows, ["segment"], "ts", "id", None, 30)
    merged = s.merge_pages(page, "ts", "segment", 20).collect()
    assert len(merged) == 20
    keys = [(r["ts"], r["segment"], r["paging_offset"]) for r in merged]
    assert keys == sorted(keys)
    assert s.merge_pages(page, "ts", "segment", 0).count() == page.count()


def test_positions_and_running(rows, slices):
    want = expected(rows)
    got = {}
    for r in with_position(rows, ["segment"], ["ts", "id"]).collect():
        got.setdefault(r["segment"], {})[r["position"]] = r["id"]
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == want
    back = {r["id"]: r["position"] for r in with_position(rows, [], [Desc("id")]).collect()}
    assert back == {i: 899 - i for i in range(900)}
    for inclusive in (True, False):
        run = with_running(rows, ["segment"], ["ts", "id"], "so_far", c("id"), inclusive=inclusive).collect()
        for seg, order in want.items():
            sums, total = {}, 0
            for i in order:
                sums[i] = total + i if inclusive else total
                total += i
            assert {r["id"]: r["so_far"] for r in run if r["segment"] == seg} == sums


def test_a_hot_group_spreads_over_slices(spark, rows):
    from tallyspan.operators.ordered import SLICE, place

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per = place(rows, ["segment"], ["ts", "id"]).groupBy("segment", SLICE).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = [r["count"] for r in per if r["segment"] == "hot"]
    assert len(hot) >= 4 and max(hot) <= 900 / 8 * 2


def test_filters_are_two_valued(spark):
    df = spark.createDataFrame([(1, "a", ["a", "b"]), (2, None, []), (3, "", None), (4, "b", ["c", None])], "id int, v string, l array<string>")

    def got(p):
        return sorted(r["id"] for r in df.where(p).collect())

    assert got(s.none_of(c("v") == "a")) == [2, 3, 4]
    assert got(s.value_is(df, "v", None)) == [2, 3]
    assert got(s.value_is(df, "l", "b")) == [1]
    assert got(s.value_is(df, "l", None)) == [2, 3, 4]
    assert got(s.value_like(df, "l", lambda x: x == "c")) == [4]
    assert got(s.value_like(df, "l", lambda x: x.isNull())) == [2, 3, 4]
    assert got(s.all_of(s.always(), s.never())) == [] and got(s.any_of(s.always(), s.never())) == [1, 2, 3, 4]


def test_multi_values(values):
    arr = F.array(F.lit("b"), F.lit(None).cast("string"), F.lit("a"), F.lit("b"))
    got = values(
        [
            s.normalised(arr), s.normalised(arr, "SORTED_SET"), s.normalised(arr, "ARRAY"), s.list_filtered(arr, ["a"]), s.list_filtered(arr, ["b"], keep=False),
            s.regex_filtered(arr, "a|"), s.scalarised(F.array(F.lit("x"))), s.scalarised(F.array().cast("array<string>")), s.strings_of(arr, True),
            s.strings_of(F.lit(None).cast("int"), False),
        ]
    )[0]
    assert got == (
        [None, "a", "b", "b"], [None, "a", "b"], ["b", None, "a", "b"], ["a"], [None, "a"], [None, "a"], "x", None, ["b", "null", "a", "b"], [],
    )


def test_virtual_columns(spark):
    df = spark.range(3)
    out = s.with_virtual_columns(df, [("b", c("a") * 2, ["a"]), ("a", c("id") + 1, ["id"])])
    assert [r["b"] for r in out.orderBy("id").collect()] == [2, 4, 6]
    for bad in ([("", c("id"), [])], [("__time", c("id"), [])], [("a", c("id"), []), ("a", c("id"), [])], [("a", c("b"), ["b"]), ("b", c("a"), ["a"])]):
        with pytest.raises(ValueError):
            s.with_virtual_columns(df, bad)


def test_empty_buckets_appear_once(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5), 1), (datetime(2024, 1, 1, 5, 30), 2)], "ts timestamp, v int")
    out = s.bucketed_select(df, "ts", granularity("hour"), "2024-01-01 04:30:00", "2024-01-03 02:00:00").collect()
    buckets = sorted(r["bucket"] for r in out)
    assert len(out) == 46 + 1 and buckets[0] == datetime(2024, 1, 1, 4) and buckets[-1] == datetime(2024, 1, 3, 1)
    week = s.bucket_table(spark, granularity("week"), "2024-01-03 00:00:00", "2024-01-20 00:00:00").collect()
    assert sorted(r[0] for r in week) == [datetime(2024, 1, 1), datetime(2024, 1, 8), datetime(2024, 1, 15)]


def test_select_plan_prunes_and_pushes(t):
    q = s.select_events(t.events, "ts", [(datetime(2024, 1, 2), datetime(2024, 1, 3))], ["event_type"], ["value"])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "props" not in plan and "user_id" not in plan


@pytest.mark.parametrize("depth", [0, 998, 1000, 100_000])
def test_pages_have_one_plan(t, depth):
    rows = t.events.withColumn("segment", F.lit("all"))
    page = s.page(rows, ["segment"], "ts", "event_id", {"all": depth}, 5)
    order = [r["event_id"] for r in sorted(t.events.collect(), key=lambda r: (r["ts"], r["event_id"]))]
    assert [r["event_id"] for r in page.orderBy("paging_offset").collect()] == order[depth + 1 : depth + 6]


def test_values_reach_the_scan(t):
    def pushed(p):
        return t.events.where(p)._jdf.queryExecution().executedPlan().toString().split("PushedFilters: ")[1].split("]")[0]

    assert "EqualNullSafe(event_type,view)" in pushed(s.value_is(t.events, "event_type", "view"))
    assert "Not(EqualNullSafe(event_type,view))" in pushed(s.value_is_not(t.events, "event_type", "view"))
    assert "user_id" in pushed(s.value_is(t.events, "user_id", "7"))
    assert t.events.where(s.value_is(t.events, "user_id", "abc")).count() == 0
    assert t.events.where(s.value_is_not(t.events, "user_id", "abc")).count() == t.events.count()


def test_empty_lists_mean_all(t):
    span = [(datetime(2024, 1, 2), datetime(2024, 1, 3))]
    names = lambda *a, **k: s.select_events(t.events, "ts", span, *a, **k).columns
    assert names() == ["__time", "event_id", "user_id", "event_type", "value", "props"]
    assert names(["event_type"]) == ["__time", "event_type", "event_id", "user_id", "value", "props"]
    assert names([], ["value"]) == ["__time", "event_id", "user_id", "event_type", "props", "value"]
    assert names(all_dims=["event_type"], all_metrics=["value"]) == ["__time", "event_type", "value"]
