import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.functions import spatial as sp
from tallyspan.operators import alerts as al
from tallyspan.operators import catalog as k
from tallyspan.operators.spatial import join_boxes
from tallyspan.plans.alerts import requests_of

c = F.col


def test_identifiers(values):
    src = F.lit("my_source")
    at = lambda x: F.lit(x).cast("timestamp")
    made = k.make_identifier(src, at("2024-01-01"), at("2024-01-02"), F.lit("v"), F.lit(3))
    plain = k.make_identifier(src, at("2024-01-01"), at("2024-01-02"), F.lit("v"), F.lit(0))
    got = values([made, plain, k.parse_identifier(src, made)["trail"], k.parse_identifier(src, F.lit("my_source_x_y_z")), k.parse_identifier(src, F.lit("other_a")), k.with_interval(src, made, at("2024-02-01"), at("2024-02-02"))])[0]
    assert got == (
        "my_source_2024-01-01T00:00:00.000Z_2024-01-02T00:00:00.000Z_v_3", "my_source_2024-01-01T00:00:00.000Z_2024-01-02T00:00:00.000Z_v", "3", None, None,
        "my_source_2024-02-01T00:00:00.000Z_2024-02-02T00:00:00.000Z_v_3",
    )


def test_compare_counts_copies(spark):
    left = spark.createDataFrame([(1, []), (1, []), (2, ["a"])], "v int, l array<string>")
    right = spark.createDataFrame([(1, [None]), (2, ["a"]), (3, None)], "v int, l array<string>")
    got = {r["v"]: r["surplus"] for r in k.compare(left, right, ["l"]).collect()}
    assert got == {1: 1, 3: -1}


def test_agreed(spark):
    df = spark.createDataFrame([("g", "a", "x"), ("g", "a", None), ("h", "a", "x")], "g string, p string, q string")
    got = {r["g"]: (r["p"], r["q"]) for r in k.agreed(df, ["g"], ["p", "q"]).collect()}
    assert got == {"g": ("a", None), "h": ("a", "x")}


def test_missing_source(spark):
    with pytest.raises(ValueError):
        k.source_by_code(spark.createDataFrame([("a",)], "source_code string"), "b")


def inside_polygon(x, y, xs, ys):
    """Straight-line check in 64 bits, for points away from the border."""
    odd = False
    for i in range(len(xs)):
        j = i - 1
        if (ys[i] > y) != (ys[j] > y) and x < (xs[j] - xs[i]) * (y - ys[i]) / (ys[j] - ys[i]) + xs[i]:
            odd = not odd
    return odd


def test_polygon(spark):
    xs, ys = [0, 4, 4, 2, 0], [0, 0, 4, 1, 4]
    border = [(0, 0), (4, 4), (2, 0), (0, 2), (4, 1), (3, 2.5)]
    rnd = random.Random(3)
    points = [(rnd.uniform(-1, 5), rnd.uniform(-1, 5)) for _ in range(400)]
    df = spark.createDataFrame([(i, [float(x), float(y)]) for i, (x, y) in enumerate(border + points)], "id int, at array<float>")
    got = {r["id"] for r in df.where(sp.in_polygon(c("at"), xs, ys)).collect()}
    want = set(range(len(border))) | {i + len(border) for i, (x, y) in enumerate(points) if inside_polygon(np.float32(x), np.float32(y), xs, ys)}
    assert got == want
    with pytest.raises(ValueError):
        sp.in_polygon(c("at"), [0, 1], [0, 1])


def test_rectangle_radius_decode(values):
    p = lambda *x: F.array(*[F.lit(float(v)).cast("float") for v in x])
    got = values(
        [
            sp.in_rectangle(p(1, 2, 3), [1, 2, 3], [1, 2, 3]), sp.in_rectangle(p(1, 2.1), [0, 0], [1, 2]), sp.in_radius(p(3, 4), [0, 0], 5), sp.in_radius(p(3.01, 4), [0, 0], 5),
            sp.decode(F.lit("1, 2.5")), sp.decode(F.lit("1,x")), sp.coordinate(F.lit("1"), F.lit("n")), sp.in_rectangle(F.lit(None).cast("array<float>"), [0], [1]),
        ]
    )[0]
    assert got == (True, False, True, False, [1.0, 2.5], None, None, False)


def test_box_join_against_brute_force(spark):
    rnd = random.Random(5)
    # a third of the points in one spot; boxes from a point to the whole plane
    pts = [(i, 0.5, 0.5) if i % 3 == 0 else (i, rnd.uniform(-3, 3), rnd.uniform(-3, 3)) for i in range(300)]
    boxes = []
    for i in range(60):
        x, y, w, h = rnd.uniform(-3, 3), rnd.uniform(-3, 3), 10 ** rnd.uniform(-3, 1), 10 ** rnd.uniform(-3, 1)
        boxes.append((i, x, x + w, y, y + h))
    boxes += [(90, 0.5, 0.5, 0.5, 0.5), (91, -100.0, 100.0, -100.0, 100.0)]
    got = join_boxes(
        spark.createDataFrame(pts, "id int, x double, y double"), "x", "y", spark.createDataFrame(boxes, "box int, min_x double, max_x double, min_y double, max_y double")
    ).select("id", "box").collect()
    want = sorted((i, b) for i, x, y in pts for b, a, z, lo, hi in boxes if a <= x <= z and lo <= y <= hi)
    assert sorted(map(tuple, got)) == want


def test_outbox_and_routes(spark, t):
    req = requests_of(t.events)
    box = al.outbox(req)
    assert box.where("missing_recipient").count() == req.where(F.size("to_address") == 0).count()
    assert box.where(~c("subject").rlike(r"^\[(FATAL|WARN|INFO)\] event ")).count() == 0
    odd = spark.createDataFrame([("remote_file", None, "sftp"), ("remote_file", ["x"], None), ("other", ["x"], "sftp")], "type string, remote_files array<string>, remote_type string")
    assert [r["route"] for r in al.route(odd).collect()] == ["body", "reject", "body"]


def test_size_limit(spark, slices):
    df = spark.createDataFrame([("m", i, 400) for i in range(5)] + [("n", 0, 2000)], "m string, pos int, size long")
    got = {(r["m"], r["pos"]): (r["size_so_far"], r["accepted"]) for r in al.within_limit(df, ["m"], ["pos"], "size", limit=1200).collect()}
    assert got[("m", 2)] == (1200, True) and got[("m", 3)] == (1600, False) and got[("n", 0)] == (2000, False)


def test_html_rows(spark):
    df = spark.createDataFrame([("a\u0001b\u0001", 0), ("c", 1)], "line string, at long")
    rows = [r["html"] for r in al.html_table("x|y", df, "line", "at").orderBy("place").collect()]
    assert rows == [al.TABLE_OPEN, "<tr><th>x</th><th>y</th></tr>", "<tr><td>a</td><td>b</td></tr>", "<tr><td>c</td></tr>", "</table>"]
