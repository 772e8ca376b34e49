import math
import random

from pyspark.sql import functions as F

from spotloom.operators.spatial import located, near_on_earth, near_pairs, points_in_boxes, points_in_polygons


def _points(n=400, side=150, seed=3):
    r = random.Random(seed)
    return [(i, r.choice([1, 2, None]), r.randrange(-20, side), r.randrange(-20, side)) for i in range(n)]


def test_near_pairs_equal_all_pairs(spark):
    rows = _points()
    df = spark.createDataFrame(rows, "spot_id bigint, roi int, x int, y int").withColumn("cx", F.lit("extra"))
    for radius in (1, 6, 30):
        got = {(r["spot_id_a"], r["spot_id_b"]) for r in near_pairs(df, radius).collect()}
        want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] is not None and a[1] == b[1] and (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 <= radius**2}
        assert got == want
        assert near_pairs(df, radius).count() == len(want)


def test_near_pairs_ties_nulls_and_nothing(spark):
    rows = [(1, 1, 5, 5), (2, 1, 5, 5), (3, 1, None, 5), (4, 1, -1, -1), (5, 1, -1, -1), (None, 1, 5, 5)]
    df = spark.createDataFrame(rows, "spot_id bigint, roi int, x int, y int")
    assert [tuple(r)[1:] for r in near_pairs(located(df), 6).collect()] == [(1, 2, 0.0)]
    assert near_pairs(df.limit(0), 6).count() == 0


def test_boxes_are_half_open_and_may_overlap(spark):
    pts = spark.createDataFrame([(1, 1, 0.0, 0.0), (2, 1, 9.5, 9.5), (3, 1, 10.0, 10.0), (4, 2, 0.0, 0.0)], "spot_id bigint, roi int, x double, y double")
    boxes = spark.createDataFrame([(1, 7, 0, 0, 10, 10), (1, 8, 9, 9, 200, 200), (1, 9, 5, 5, 5, 9), (2, 7, None, 0, 1, 1)], "roi int, label int, ymin int, xmin int, ymax int, xmax int")
    assert sorted((r["spot_id"], r["label"]) for r in points_in_boxes(pts, boxes).collect()) == [(1, 7), (2, 7), (2, 8), (3, 8)]


def test_polygons_equal_a_plain_test(spark):
    ring = [(0.0, 0.0), (100.0, 10.0), (80.0, 90.0), (40.0, 30.0), (5.0, 95.0)]

    def inside(x, y):
        hit = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                hit = not hit
        return hit

    rows = [(i, 1, x + 0.25, y + 0.25) for i, _, x, y in _points(300, 120)]
    pts = spark.createDataFrame(rows, "spot_id bigint, roi int, x double, y double")
    polys = spark.createDataFrame([(1, 5, ring), (1, 6, ring[:2]), (1, 7, None)], "roi int, polygon_id int, ring array<struct<x:double,y:double>>")
    got = {r["spot_id"] for r in points_in_polygons(pts, polys).collect()}
    assert got == {i for i, _, x, y in rows if inside(x, y)}


def test_great_circle_pairs_equal_all_pairs(spark):
    r = random.Random(5)
    rows = [(i, r.uniform(-90, 90), r.uniform(-180, 180)) for i in range(150)] + [(900, 89.9, 10.0), (901, 89.9, -170.0), (902, 0.0, 179.95), (903, 0.0, -179.95), (904, None, 1.0)]
    df = spark.createDataFrame(rows, "id bigint, lat double, lon double")

    def metres(a, b):
        la, lb, d = math.radians(a[1]), math.radians(b[1]), math.radians(b[2] - a[2])
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(d / 2) ** 2
        return 2 * 6371008.8 * math.asin(math.sqrt(min(1, h)))

    for radius in (30_000.0, 1_500_000.0):
        got = {(x["id_a"], x["id_b"]) for x in near_on_earth(df, radius).collect()}
        want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] is not None and b[1] is not None and metres(a, b) <= radius}
        assert got == want
