"""The appended rollup: late rows, replays, restarts, state that ends."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspan.functions.granularity import granularity
from tallyspan.operators import aggregate as a
from tallyspan.session import scratch_path
from tallyspan.streaming.watermark import rollup_appended

BASE = datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp, kind string, value double"


def job_of(spark, delay="3 hours", min_time=None):
    aggs = [a.count("n"), a.double_sum("total", F.col("value"))]
    return rollup_appended(scratch_path(spark, "wm"), "ts", granularity("hour"), ["kind"], aggs, delay, min_time)


def plain(batches, delay, min_time=None):
    """(emitted, rejected ids by reason, open) by the same rules, row by row."""
    mark, states, out, gone = None, {}, {}, {}
    for rows in batches:
        seen = [r[1] for r in rows if r[1] is not None]
        for i, ts, kind, value in rows:
            if ts is None:
                gone[i] = "no time"
            elif min_time is not None and ts < min_time:
                gone[i] = "before the minimum time"
            elif mark is not None and ts.replace(minute=0, second=0) + timedelta(hours=1) <= mark:
                gone[i] = "late"
            else:
                n, total = states.get((ts.replace(minute=0, second=0), kind), (0, 0.0))
                states[ts.replace(minute=0, second=0), kind] = (n + 1, total + value)
        if seen:
            mark = max([m for m in (mark, max(seen) - delay) if m is not None])
        if mark is not None:
            for key in [k for k in states if k[0] + timedelta(hours=1) <= mark]:
                assert key not in out
                out[key] = states.pop(key)
    return out, gone, states


def table(frame):
    return {(r.bucket, r.kind): (r.n, r.total) for r in frame.collect()}


@pytest.fixture(scope="module")
def batches():
    rng = random.Random(4)
    out, i = [], 0
    for b in range(5):
        rows = []
        for _ in range(40):
            hours = b * 15 + rng.random() * 15 - (rng.random() * 30 if rng.random() < 0.2 else 0)
            rows.append((i, BASE + timedelta(minutes=round(hours * 60)), "hot" if i % 3 else rng.choice(["x", None]), float(rng.randrange(100))))
            i += 1
        out.append(rows)
    out[1].append((900, None, "x", 1.0))
    return out


def test_batches_equal_plain_rules(spark, batches):
    job = job_of(spark, min_time="2023-12-31 20:00:00")
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in batches]
    for number, frame in enumerate(frames):
        job.write(frame, number)
        if number == 2:  # a batch that is replayed after a failure changes nothing
            job.write(frame, number)
    out, gone, held = plain(batches, timedelta(hours=3), datetime(2023, 12, 31, 20))
    assert table(job.emitted(frames[0])) == out and table(job.open_buckets(frames[0])) == held
    rejected = job.rejected(frames[0]).collect()
    assert {r.id: r.reason for r in rejected} == gone and len(rejected) == len(gone) and len(set(gone.values())) >= 2
    # state of days that are over is gone, what is open is not
    days = {name.split("=")[1] for name in os.listdir(f"{job.path}/states".removeprefix("file:")) if name.startswith("_day=")}
    first_open = min(k[0] for k in held)
    assert days and min(map(int, days)) >= (first_open - timedelta(days=2) - datetime(1970, 1, 1)).days


def test_stream_goes_on_from_its_checkpoint(spark, batches):
    job, folder, checkpoint = job_of(spark), scratch_path(spark, "in"), scratch_path(spark, "cp")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        job.run(spark.readStream.schema(SCHEMA).parquet(folder), checkpoint)
    empty = spark.createDataFrame([], SCHEMA)
    out, gone, held = plain(batches, timedelta(hours=3))
    assert table(job.emitted(empty)) == out and table(job.open_buckets(empty)) == held
    assert {r.id: r.reason for r in job.rejected(empty).collect()} == gone


def test_nothing_arrived(spark):
    job, empty = job_of(spark), spark.createDataFrame([], SCHEMA)
    for frame in (job.emitted(empty), job.rejected(empty), job.open_buckets(empty)):
        assert frame.count() == 0
    job.write(empty, 0)
    job.write(spark.createDataFrame([(1, None, "x", 1.0)], SCHEMA), 1)
    assert job.emitted(empty).count() == 0 and job.rejected(empty).count() == 1 and job.open_buckets(empty).count() == 0
