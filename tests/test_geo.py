import math
import random

from evenfall.operators import geo


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * geo.EARTH_KM * math.asin(min(1, math.sqrt(h)))


def test_near_points_as_brute_force(spark):
    r = random.Random(1)
    pts = [(i, r.uniform(-90, 90), r.choice([r.uniform(-180, 180), 179.99, -179.99])) for i in range(300)] + [(900, 89.999, 10.0), (901, 89.999, -170.0), (902, 0.0, 0.0), (903, None, 1.0), (904, float("nan"), 1.0), (905, 91.0, 1.0)]
    others = [(i, a + r.uniform(-1, 1) if a is not None and abs(a) < 88 else a, b) for i, a, b in pts]
    ok = lambda x: x[1] is not None and x[1] == x[1] and abs(x[1]) <= 90 and not (x[1] == 0 and x[2] == 0)
    for dist in (0.25, 50.0, 2000.0):
        p = spark.createDataFrame(pts, "id long, lat double, lon double")
        o = spark.createDataFrame(others, "oid long, lat double, lon double")
        got = {tuple(x) for x in geo.near_points(p, "id", "lat", "lon", o, "oid", "lat", "lon", dist).collect()}
        assert got == {(x[0], y[0]) for x in pts for y in others if ok(x) and ok(y) and km(x[1:], y[1:]) <= dist}


def test_areas(spark):
    pts = [(1, 10.0, 179.5), (2, 10.0, -179.5), (3, 10.0, 0.0), (4, 50.0, 8.0), (5, None, 1.0), (6, 0.0, 0.0)]
    areas = [(1, None, None, None, (9.0, 179.0, 11.0, -179.0)), (2, 10.0, 180.0, 80.0, None), (3, 50.0, 8.0, None, None), (4, None, None, 5.0, None), (5, 89.9, 0.0, 20.0, None), (6, None, None, None, (None, 1.0, 2.0, 3.0))]
    p = spark.createDataFrame(pts, "id long, lat double, lon double")
    a = spark.createDataFrame(areas, "area_id int, lat double, lon double, radius_km double, bbox struct<south:double,west:double,north:double,east:double>")
    assert {tuple(x) for x in geo.containing_areas(p, "id", "lat", "lon", a).collect()} == {(1, 1), (2, 1), (1, 2), (2, 2), (4, 3)}
    assert geo.containing_areas(p, "id", "lat", "lon", a.limit(0)).count() == 0


def test_hot_cells_are_split(spark, monkeypatch):
    from evenfall import runtime

    left = spark.range(30_000).selectExpr("id", "IF(id % 3 = 0, 7, id) AS k")
    right = spark.createDataFrame([(7, "a"), (7, "b"), (10, "c")], "k long, v string")
    got = runtime.keyed_join(left, right, ["k"], rows=1)
    assert got.count() == 20_003
    assert runtime.keyed_join(left, right, ["k"], "left", rows=1).count() == left.count() + 10_001
