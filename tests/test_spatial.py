"""Spatial joins against tests of all pairs."""

import math
import random
from fractions import Fraction

from conftest import rows
from siteweave.functions.wkt import orientation, parse_polygons, signed_area, triangulate
from siteweave.operators import spatial

HOLE = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"


def test_parse_and_triangulate():
    assert parse_polygons(None) == parse_polygons("POLYGON EMPTY") == parse_polygons("LINESTRING (0 0, 1 1)") == []
    rings = parse_polygons(" multipolygon(((0 0,4 0,4 4,0 0)),((5 5, 6 5, 6 6, 5 5)))")
    assert [len(p) for p in rings] == [1, 1]
    for text, area in ((HOLE, 96.0), ("POLYGON((0 0,4 0,4 4,2 1,0 4,0 0))", 10.0), ("POLYGON ((0 0, 2 0, 4 0, 4 4, 0 4, 0 0))", 16.0)):
        parts = triangulate(parse_polygons(text)[0])
        assert math.isclose(sum(signed_area(list(t)) for t in parts), area)


def test_orientation_is_exact():
    a, b = (0.1, 0.1), (0.3, 0.3)
    for k in range(-3, 4):
        p = (0.2, 0.2 + k * 2.0**-55)
        want = (Fraction(b[0]) - Fraction(a[0])) * (Fraction(p[1]) - Fraction(a[1])) - (Fraction(b[1]) - Fraction(a[1])) * (Fraction(p[0]) - Fraction(a[0]))
        assert orientation(a, b, p) == (want > 0) - (want < 0)


def points(spark, data):
    return spark.createDataFrame([(i, la, lo, "x") for i, la, lo in data], "id string, lat double, lon double, region string")


def test_regions(spark):
    shapes = spark.createDataFrame([("hole", HOLE, 1), ("hole", HOLE, 2), ("left", "POLYGON ((0 0, 5 0, 5 10, 0 10, 0 0))", 1), ("bow", "POLYGON ((20 0, 24 4, 24 0, 20 4, 20 0))", 1), ("none", None, 1), ("empty", "POLYGON EMPTY", 1), (None, HOLE, 1)], "region string, shape string, id int")
    at = points(spark, [("in", 2.0, 2.0), ("in", 2.0, 2.0), ("hole", 5.0, 5.0), ("edge", 5.0, 4.0), ("shared", 1.0, 5.0), ("out", 11.0, 5.0), ("bow", 1.0, 23.5), ("between", 2.9, 22.0), ("null", None, 1.0), ("nan", float("nan"), 1.0), ("zero", 0.0, 0.0), (None, 2.0, 2.0)])
    want = sorted([("in", "hole"), ("in", "left"), ("hole", "left"), ("edge", "hole"), ("edge", "left"), ("shared", "hole"), ("shared", "left"), ("bow", "bow")], key=repr)
    assert rows(spatial.containing_regions(at, shapes)) == want
    assert rows(spatial.containing_regions(at, shapes, block_triangles=3)) == want
    assert rows(spatial.containing_regions(at.limit(0), shapes)) == rows(spatial.containing_regions(at, shapes.limit(0))) == []


def test_random_polygons_against_crossing_counts(spark):
    rng, shapes = random.Random(3), []
    for n in range(12):
        cx, cy, k = rng.uniform(-5, 5), rng.uniform(-5, 5), rng.randrange(5, 30)
        ring = [(cx + r * math.cos(2 * math.pi * i / k), cy + r * math.sin(2 * math.pi * i / k)) for i in range(k) for r in [rng.uniform(1, 4)]]
        shapes.append((f"r{n}", "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*ring, ring[0]]) + "))"))
    at = [(f"p{i}", rng.uniform(-8, 8), rng.uniform(-8, 8)) for i in range(400)]
    want = {(i, r) for i, la, lo in at for r, text in shapes if spatial._even_odd(text, (lo, la))}
    got = set(map(tuple, spatial.containing_regions(points(spark, at), spark.createDataFrame(shapes, "region string, shape string")).collect()))
    assert got == want


def test_near_pairs_against_all_pairs(spark, monkeypatch):
    rng = random.Random(5)
    data = [(f"a{i:03}", rng.uniform(40, 40.02), rng.uniform(-100.02, -100)) for i in range(150)]
    data += [("w1", 0.0005, 179.9999), ("w2", 0.0005, -179.9999), ("n1", 89.9999, 10.0), ("n2", 89.9999, -170.0), ("s1", 52.0, 4.0), ("s2", 52.0, 4.0), ("s2", 52.0, 4.0), ("far", -30.0, 0.0)]
    data += [("x", None, 1.0), ("y", float("nan"), 1.0), ("z", 0.0, 0.0), (None, 52.0, 4.0)]

    def metres(p, q):
        (a, b), (c, d) = (map(math.radians, t[1:]) for t in (p, q))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * spatial.EARTH_RADIUS_M * math.asin(min(1, math.sqrt(h)))

    good = [p for p in set(data) if p[0] and p[1] is not None and not math.isnan(p[1]) and p[1:] != (0.0, 0.0)]
    want = sorted((p[0], q[0]) for p in good for q in good if p[0] < q[0] and metres(p, q) <= 200)
    assert ("w1", "w2") in want and ("n1", "n2") in want
    assert rows(spatial.near_pairs(points(spark, data), 200.0), "left_id", "right_id") == want
    monkeypatch.setattr(spatial, "CELL_POINTS", 2)
    assert rows(spatial.near_pairs(points(spark, data), 200.0), "left_id", "right_id") == want
    assert rows(spatial.near_pairs(points(spark, []), 200.0)) == []


def test_nearest(spark):
    from siteweave.operators.evidence import nearest_km

    rng = random.Random(9)
    at = [(f"p{i}", rng.uniform(-60, 60), rng.uniform(-180, 180)) for i in range(60)]
    to = [(f"f{i}", rng.uniform(-60, 60), rng.uniform(-180, 180)) for i in range(25)]

    def km(p, q):
        (a, b), (c, d) = (map(math.radians, t[1:]) for t in (p, q))
        return 2 * 6371.0088 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    got = {r["id"]: r["feature"] for r in nearest_km(points(spark, at), points(spark, to)).collect()}
    assert got == {p[0]: min(to, key=lambda q: km(p, q))[0] for p in at}


def test_nearest_of_far_points_compares_few_places(spark, monkeypatch):
    import pandas as pd
    from pyspark.sql import functions as F

    from siteweave.operators import evidence

    rng = random.Random(4)
    at = [(f"p{i}", rng.uniform(30, 40), rng.uniform(100, 110)) for i in range(280)] + [("pole", 89.999, 0.0), ("none", None, 1.0)]
    to = [(f"f{i:04}", rng.uniform(30, 45), rng.uniform(-120, -70)) for i in range(1500)] + [("here", 89.992, 0.0), ("over", 89.999, 180.0), ("pover", 89.999, 180.0)]

    def km(p, q):
        (a, b), (c, d) = (map(math.radians, t[1:]) for t in (p, q))
        return 2 * 6371.0088 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    compared, real = spark.sparkContext.accumulator(0), spatial.haversine_m

    def nothing(a: pd.Series, b: pd.Series) -> pd.Series:
        compared.add(len(a))
        return (a - b) * 0.0

    monkeypatch.setattr(evidence, "haversine_m", lambda *c: real(*c) + F.pandas_udf(nothing, "double")(c[0], c[2]))
    got = {r["id"]: r["feature"] for r in evidence.nearest_km(points(spark, at), points(spark, to)).collect()}
    assert got == {p[0]: min(to, key=lambda q: (km(p, q), q[0]))[0] for p in at if p[1] is not None}
    assert got["pole"] == "over" and compared.value < 100 * len(at)
    fine = [(f"n{i}", 40 + rng.random() / 50, -100 + rng.random() / 50) for i in range(300)]
    monkeypatch.setattr(evidence, "CELL_PLACES", 2)
    got = {r["id"]: r["feature"] for r in evidence.nearest_km(points(spark, fine), points(spark, [(f"g{i}", *p[1:]) for i, p in enumerate(fine[:150])] + to)).collect()}
    near = [(f"g{i}", *p[1:]) for i, p in enumerate(fine[:150])]
    assert got == {p[0]: min(near, key=lambda q: (km(p, q), q[0]))[0] for p in fine}
