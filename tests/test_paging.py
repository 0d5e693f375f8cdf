"""Pages of every (segment, bucket): both directions, resumed until exhausted, cursors as tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspan.functions.granularity import granularity
from tallyspan.operators import paging

BASE = datetime(2024, 1, 1)
SCHEMA = "seg string, ts timestamp, id long"


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else rng.choice(["a", None]), BASE + timedelta(minutes=rng.randrange(0, 4000)), i) for i in range(700)]
    rows += [("same", BASE, 1000 + i) for i in range(40)] + [("untimed", None, 2000)]
    return rows


def day(ts, hours=24):
    return BASE + timedelta(hours=hours * ((ts - BASE) // timedelta(hours=hours)))


def by_bucket(rows, hours, descending):
    out = {}
    for seg, ts, i in rows:
        if ts is not None:
            out.setdefault((seg, day(ts, hours)), []).append((ts, i))
    return {k: [i for _, i in sorted(v, reverse=descending)] for k, v in out.items()}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("gran,hours,cell", [("day", 24, "hour"), ("six_hour", 6, "day"), ("hour", 1, "hour")])
def test_read_until_exhausted(spark, events, descending, gran, hours, cell):
    """Every row once, in order, with its offset; nothing lost or repeated over the pages."""
    index = paging.PageIndex.of(spark.createDataFrame(events, SCHEMA), ["seg"], "ts", "id", granularity(gran), descending, cell)
    got, pages, cursor = {}, 0, None
    for page, cursor in paging.read_on(index, 60, None):
        pages += 1
        for r in page.collect():
            got.setdefault((r.seg, r.bucket), []).append((r.paging_offset, r.id))
    want = by_bucket(events, hours, descending)
    assert pages == -(-max(map(len, want.values())) // 60)
    numbered = {k: [(-1 - n if descending else n, i) for n, i in enumerate(v)] for k, v in want.items()}
    assert {k: sorted(v, reverse=descending) for k, v in got.items()} == numbered
    last = {(r.seg, r.bucket): r.paging_offset for r in cursor.collect()}
    assert last == {k: v[-1][0] for k, v in numbered.items()}
    assert list(paging.read_on(index, 60, cursor)) == []


def test_cursors(spark, events):
    index = paging.PageIndex.of(spark.createDataFrame(events, SCHEMA), ["seg"], "ts", "id", granularity("day"))
    want = by_bucket(events, 24, False)
    second = BASE + timedelta(days=1)
    cursor = spark.createDataFrame([("hot", None, 4), ("hot", second, 9), (None, second, 1), ("hot", second, 7)], "seg string, bucket timestamp, paging_offset long")
    start = lambda seg, b: 10 if (seg, b) == ("hot", second) else 5 if seg == "hot" else 2 if (seg, b) == (None, second) else 0
    got = {}
    for r in index.page(cursor, 3).orderBy("paging_offset").collect():
        got.setdefault((r.seg, r.bucket), []).append(r.id)
    assert got == {k: v[start(*k) : start(*k) + 3] for k, v in want.items()}
    # the next cursor without from_next is the same page; a cursor without buckets is for all of a segment
    stepped = index.page(paging.next_cursor(cursor), 3, from_next=False)
    assert sorted(r.id for r in stepped.collect()) == sorted(i for v in got.values() for i in v)
    plain = spark.createDataFrame([("hot", 4)], "seg string, paging_offset long")
    assert {r.bucket: r.n for r in index.page(plain, 1).where("seg = 'hot'").groupBy("bucket").agg(F.min("paging_offset").alias("n")).collect()} == {
        b: 5 for s, b in want if s == "hot"
    }
    merged = paging.merge_cursors([plain, paging.cursor_of(index.page(None, 6), ["seg"])], ["seg"])
    assert {(r.seg, r.bucket): r.paging_offset for r in merged.collect()} == {**{k: min(len(v), 6) - 1 for k, v in want.items()}, ("hot", None): 4}


def test_wrong_sign_fails(spark, events):
    rows = spark.createDataFrame(events, SCHEMA)
    for descending, at in ((False, -1), (True, 0)):
        index = paging.PageIndex.of(rows, ["seg"], "ts", "id", granularity("day"), descending)
        with pytest.raises(Exception, match="sign"):
            index.page(spark.createDataFrame([("hot", at)], "seg string, paging_offset long"), 3).collect()


def test_times_of_the_page_reach_the_scan_and_empty_tables_have_no_pages(spark, t):
    index = paging.PageIndex.of(t.events.select("event_type", "ts", "event_id"), ["event_type"], "ts", "event_id", granularity("all"))
    plan = index.page(None, 5)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    none = paging.PageIndex.of(t.events.limit(0), ["event_type"], "ts", "event_id", granularity("day"))
    assert none.page(None, 5).count() == 0 and list(paging.read_on(none, 5)) == []


def test_merged_pages(spark, events):
    index = paging.PageIndex.of(spark.createDataFrame(events, SCHEMA), ["seg"], "ts", "id", granularity("day"))
    got = {}
    for r in paging.merge_pages(index.page(None, 10), "ts", ["seg"], 7).collect():
        got.setdefault(r.bucket, []).append((r.ts, r.seg or "", r.paging_offset))
    rows = {}
    for seg, ts, i in events:
        if ts is not None:
            rows.setdefault((seg, day(ts)), []).append((ts, i))
    want = {}
    for (seg, b), v in rows.items():
        want.setdefault(b, []).extend((ts, seg or "", n) for n, (ts, _) in enumerate(sorted(v)[:10]))
    assert {b: sorted(v) for b, v in got.items()} == {b: sorted(v)[:7] for b, v in want.items()}
