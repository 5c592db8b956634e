"""Regions and lines over adaptive cells, against brute force, with most of the places in one town."""

import math
import random

import pytest
from pyspark.sql import functions as F

from vitalair.operators import quadtree
from vitalair.operators.spatial import nearest_line, projected, region_of, segment_distance


def ring(lat, lon, radius, n, rng, wave=0.3):
    at = [(lat + radius * (1 + rng.uniform(-wave, wave)) * math.sin(2 * math.pi * k / n), lon + radius * (1 + rng.uniform(-wave, wave)) * math.cos(2 * math.pi * k / n)) for k in range(n)]
    return list(zip(at, at[1:] + at[:1]))


def world(seed):
    rng = random.Random(seed)
    sides = []
    for r in range(40):
        lat, lon = rng.uniform(25, 49), rng.uniform(-120, -70)
        rings = [ring(lat, lon, rng.uniform(1, 6), rng.randint(3, 60), rng)]
        if r % 3 == 0:
            rings.append(ring(lat, lon, 0.5, rng.randint(3, 20), rng))  # a hole
        if r % 4 == 0:
            rings.append(ring(lat + 1, lon + 15, 1.5, 12, rng))  # a second part
        sides += [(r, *a, *b) for x in rings for a, b in x]
    sides += [(90, *a, *b) for a, b in ring(35.5, -79.5, 3, 400, rng)] + [(91, *a, *b) for a, b in ring(35.52, -79.52, 0.004, 200, rng)]
    points = [(i, 35.5 + rng.gauss(0, 0.01), -79.5 + rng.gauss(0, 0.01)) for i in range(1800)]  # the town
    points += [(i, rng.uniform(20, 55), rng.uniform(-125, -65)) for i in range(1800, 2000)] + [(2000, None, -80.0), (2001, 35.5, None), (2002, points[0][1], points[0][2])]
    return points, sides


def inside(lat, lon, sides):
    odd = {}
    for r, a, b, c, d in sides:
        if (a > lat) != (c > lat) and b + (lat - a) / (c - a) * (d - b) > lon:
            odd[r] = not odd.get(r, False)
    return min((r for r, x in odd.items() if x), default=None)


@pytest.mark.parametrize("draw", [20_000, 300])
def test_regions_with_holes_and_a_dense_town(spark, draw):
    points, sides = world(5)
    p, s = spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(sides, "region long, lat1 double, lon1 double, lat2 double, lon2 double")
    got = {r.id: r.region for r in region_of(p, s, "id", "region", draw).collect()}
    assert got == {i: None if lat is None or lon is None else inside(lat, lon, sides) for i, lat, lon in points}
    assert len({v for v in got.values()}) > 15


def test_no_leaf_holds_a_large_share_and_inner_leaves_test_nothing(spark):
    rng = random.Random(1)
    rows = [(35 + rng.gauss(0, 0.001), -79 + rng.gauss(0, 0.001)) for _ in range(18_000)] + [(rng.uniform(20, 55), rng.uniform(-125, -65)) for _ in range(2_000)]
    p = spark.createDataFrame(rows, "lat double, lon double")
    tree = quadtree.fitted(p, "lon", "lat")
    sizes = [r["count"] for r in quadtree.with_leaf(p, tree, "lon", "lat").groupBy("leaf").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 0.01 * 20_000
    assert len(tree.starts) <= 3 * quadtree.DEPTH * quadtree.SHARES + 1


def test_boxes_meet_every_leaf_they_touch(spark):
    rng = random.Random(2)
    p = spark.createDataFrame([(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(3000)], "x double, y double")
    tree = quadtree.fitted(p, "x", "y", shares=40)
    boxes = [(i, *sorted((rng.gauss(0, 2), rng.gauss(0, 2))), *sorted((rng.gauss(0, 2), rng.gauss(0, 2)))) for i in range(60)] + [(60, 0.1, 0.1, 0.2, 0.2), (61, -99.0, 99.0, -99.0, 99.0)]
    b = spark.createDataFrame(boxes, "id long, a double, b double, c double, d double")
    got = {(r.id, r.leaf) for r in quadtree.touched(b, tree, F.col("a"), F.col("b"), F.col("c"), F.col("d")).collect()}
    leaves = [tuple(r) for r in quadtree._leaves(p, tree).select("leaf", "west", "south", "east", "north").collect()]
    want = {(i, n) for i, x0, x1, y0, y1 in boxes for n, w, s, e, t in leaves if x0 <= e and x1 >= w and y0 <= t and y1 >= s}
    assert want <= got and len(want) > 100
    assert len({n for i, n in got if i == 61}) == len(leaves)


def test_nearest_lines_of_a_dense_town(spark):
    rng = random.Random(9)
    points = [(i, 35.5 + rng.gauss(0, 0.02), -79.5 + rng.gauss(0, 0.02)) for i in range(450)] + [(i, rng.uniform(30, 45), rng.uniform(-100, -75)) for i in range(450, 520)] + [(520, None, 1.0), (521, *(35.5, -79.5))]
    lines = []
    for k in range(260):
        lat, lon = (35.5 + rng.gauss(0, 0.05), -79.5 + rng.gauss(0, 0.05)) if k < 200 else (rng.uniform(30, 45), rng.uniform(-100, -75))
        lines.append((k, lat, lon, lat + rng.gauss(0, 0.02 if k < 200 else 1), lon + rng.gauss(0, 0.02 if k < 200 else 1), f"kind{k % 3}"))
    p, s = spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(lines, "line long, lat1 double, lon1 double, lat2 double, lon2 double, kind string")
    x, y, a, b = *projected(F.col("lat"), F.col("lon")), projected(F.col("lat1"), F.col("lon1")), projected(F.col("lat2"), F.col("lon2"))
    every = p.where("lat is not null").join(s, F.lit(True)).select("id", "line", "kind", segment_distance(x, y, *a, *b).alias("d")).where("d <= 20000")
    want = {}
    for r in every.collect():
        want[r.id] = min(want.get(r.id, (math.inf, 0, "")), (r.d, r.line, r.kind))
    got = {r.id: (r.distance, r.line, r.kind) for r in nearest_line(p, s, "id", "line", 20_000.0, ("kind",), 400).collect()}
    assert len(got) == 522 and got[520] == (math.inf, None, None)
    near = {k: v for k, v in got.items() if v[1] is not None}
    assert near.keys() == want.keys() and all(near[k][1:] == want[k][1:] and abs(near[k][0] - want[k][0]) < 1e-6 for k in want) and 450 < len(want) < 521


def test_no_places_and_no_layers(spark):
    points, sides = world(3)
    p, s = spark.createDataFrame(points[:20], "id long, lat double, lon double"), spark.createDataFrame(sides, "region long, lat1 double, lon1 double, lat2 double, lon2 double")
    assert region_of(p, s.limit(0), "id", "region").where("region is null").count() == 20
    assert region_of(p.withColumn("lat", F.lit(None).cast("double")), s, "id", "region").where("region is null").count() == 20
    assert region_of(p.limit(0), s, "id", "region").count() == 0
    roads = s.withColumnRenamed("region", "line")
    assert nearest_line(p, roads.limit(0), "id", "line", 500.0).where("distance = double('infinity')").count() == 20
    assert nearest_line(p.withColumn("lat", F.lit(None).cast("double")), roads, "id", "line", 500.0).count() == 20
