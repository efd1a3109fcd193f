"""Spatial joins on larger tables: what is compiled, what moves, with the rows of brute force."""

import random

import pytest
from pyspark.sql import functions as F

from zonescope.operators import spatial

POINTS = "id long, longitude double, latitude double"
VERTICES = "zone_id string, part int, ring int, vertex int, longitude double, latitude double"
#: Level and upright edges, a saw of many edges, a hole, a second part that shares an edge with the first.
ZONES = {
    "step": [[(0.0, 0.0), (0.3, 0.0), (0.3, 0.1), (0.2, 0.1), (0.2, 0.2), (0.0, 0.2)]],
    "saw": [[(0.0, 0.0)] + [(i * 0.004, 0.02 + 0.03 * (i % 2)) for i in range(60)] + [(0.24, 0.0)]],
    "holed": [[(-0.1, -0.1), (0.4, -0.1), (0.4, 0.3), (-0.1, 0.3)], [(0.1, 0.05), (0.12, 0.05), (0.11, 0.07)]],
    "twins": [[(0.05, 0.05), (0.1, 0.05), (0.1, 0.1), (0.05, 0.1)], [(0.1, 0.05), (0.15, 0.05), (0.15, 0.1), (0.1, 0.1)]],
}


def vertices(spark):
    rows = [(z, p, 0, i, x, y) for z, rings in ZONES.items() for p, ring in enumerate(rings) for i, (x, y) in enumerate(ring)]
    return spark.createDataFrame(rows, VERTICES)


def inside(point, rings):
    px, py = (round(c * 1_000_000) for c in point)
    odd = False
    for ring in rings:
        ring = [(round(x * 1_000_000), round(y * 1_000_000)) for x, y in ring]
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            cross = (py - y1) * (x2 - x1) - (px - x1) * (y2 - y1)
            if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return True
            odd ^= (y1 > py) != (y2 > py) and (cross < 0) == (y2 > y1)
    return odd


@pytest.mark.parametrize("unrolled", [0, 1, 3, 8])
def test_points_are_in_the_same_polygons_however_many_edges_are_compiled(spark, monkeypatch, unrolled):
    monkeypatch.setattr(spatial, "UNROLLED_EDGES", unrolled)
    rnd = random.Random(7)
    places = [(round(rnd.uniform(-0.12, 0.42), 3), round(rnd.uniform(-0.12, 0.32), 3)) for _ in range(1500)]
    places += [v for rings in ZONES.values() for ring in rings for v in ring] + [(0.25, 0.0), (0.25, 0.1), (0.1, 0.07), (0.35, 0.1)]
    points = spark.createDataFrame([*((i, x, y) for i, (x, y) in enumerate(places)), (-1, None, 0.1), (-2, 0.1, None), (0, *places[0])], POINTS)
    want = sorted((i, z) for i, p in [*enumerate(places), (0, places[0])] for z, rings in ZONES.items() if inside(p, rings))
    for cell in (50_000, 1_000_000):
        assert sorted(map(tuple, spatial.points_in_polygons(points, vertices(spark), cell=cell).select("id", "zone_id").collect())) == want


def test_cells_with_few_edges_are_tested_by_compiled_code(spark):
    points = spark.createDataFrame([(1, 0.11, 0.06), (2, 5.0, 5.0)], POINTS)
    plain = vertices(spark).where("zone_id in ('step', 'twins')")
    plan = spatial.points_in_polygons(points, plain)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "Join" in plan
    mixed = spatial.points_in_polygons(points, vertices(spark))
    assert "lambda" in mixed._jdf.queryExecution().executedPlan().toString()  # the saw's cells alone
    assert sorted((r.id, r.zone_id) for r in mixed.collect()) == [(1, "step"), (1, "twins")]


def test_points_are_not_moved_to_the_sites(spark, monkeypatch):
    rnd = random.Random(9)
    places = [(i, rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for i in range(150)] + [(200, 179.999, 0.0), (201, 0.0, 89.999), (202, 0.0, 0.0), (202, 0.0, 0.0)]
    spots = [(i, lon + rnd.uniform(-0.1, 0.1), max(-90.0, min(90.0, lat + rnd.uniform(-0.1, 0.1)))) for i, lon, lat in places * 4]
    spots = [(i, lon, lat) for i, (_, lon, lat) in enumerate(spots)] + [(9001, -179.999, 0.0), (9002, 180.0, 89.998), (9003, None, 0.0), (9004, 0.0, 0.0), (9004, 0.0, 0.0), (9005, 900.0, -95.0)]
    points = spark.createDataFrame(spots, POINTS).repartition(4)
    sites = spark.createDataFrame([*((f"s{i}", lon, lat) for i, lon, lat in places), (None, 0.0, 0.0), ("nowhere", None, 1.0)], "site_id string, longitude double, latitude double")
    metres = 9000.0
    distance = spatial.haversine_m(F.col("p.latitude"), F.col("p.longitude"), F.col("s.latitude"), F.col("s.longitude"))
    pairs = points.alias("p").join(sites.where("site_id is not null").alias("s"), (distance <= metres) & F.col("p.latitude").between(-90, 90) & F.col("p.longitude").between(-180, 180))
    want = sorted(map(tuple, pairs.select("p.id", "s.site_id").collect()))
    assert len(want) > 300
    monkeypatch.setattr(spatial, "SITES_PER_BROADCAST", 400)
    monkeypatch.setitem(spatial.__dict__, "MOST_BROADCASTS", 1000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = spatial.within_distance(points, sites, metres)
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.id, r.site_id) for r in near.collect()) == want
        assert plan.count("BroadcastHashJoin") >= 2 and "hashpartitioning(_cell" not in plan
        monkeypatch.setattr(spatial, "MOST_BROADCASTS", 1)
        dealt = spatial.within_distance(points, sites, metres, hot_rows=2)
        assert "hashpartitioning(_cell" in dealt._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.id, r.site_id) for r in dealt.collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
