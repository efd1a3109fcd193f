"""Spatial joins against brute force: boundaries, holes, hot cells, poles and the date line."""

import math
import random

import pytest
from pyspark.sql import functions as F

from zonescope.operators import spatial

POINTS = "id long, longitude double, latitude double"
VERTICES = "zone_id string, part int, ring int, vertex int, longitude double, latitude double"


def vertices(spark, zones):
    rows = [(z, p, r, i, x, y) for z, rings in zones for p, r, ring in rings for i, (x, y) in enumerate(ring)]
    return spark.createDataFrame(rows, VERTICES)


SQUARE = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
HOLE = [(0.4, 0.4), (0.6, 0.4), (0.6, 0.6), (0.4, 0.6)]


def inside(point, rings):
    """Closed even-odd test in whole units."""
    px, py = (round(c * 1_000_000) for c in point)
    odd = False
    for ring in rings:
        ring = [(round(x * 1_000_000), round(y * 1_000_000)) for x, y in ring]
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            cross = (py - y1) * (x2 - x1) - (px - x1) * (y2 - y1)
            if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return True
            if (y1 > py) != (y2 > py) and (cross < 0) == (y2 > y1):
                odd = not odd
    return odd


@pytest.mark.parametrize("cell", [50_000, 300_000, 7_000_000])
def test_boundary_and_holes(spark, cell):
    zones = vertices(spark, [("plain", [(0, 0, SQUARE + SQUARE[:1])]), ("holed", [(0, 0, SQUARE), (0, 1, HOLE)])])
    cases = {
        1: (0.5, 0.5), 2: (0.5, 0.4), 3: (0.4, 0.4), 4: (1.0, 1.0), 5: (0.0, 0.5), 6: (1.000001, 0.5), 7: (0.2, 0.2),
        8: (0.5, 0.000001), 9: (0.5, -0.000001), 10: (0.6, 0.5), 11: (0.599999, 0.5), 12: (-0.5, 0.0), 13: (2.0, 1.0),
    }
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in cases.items()] + [(20, None, 0.5), (21, 0.5, None)], POINTS)
    got = {(r.id, r.zone_id) for r in spatial.points_in_polygons(points, zones, cell=cell).collect()}
    plain = {1, 2, 3, 4, 5, 7, 8, 10, 11}
    assert got == {(i, "plain") for i in plain} | {(i, "holed") for i in plain - {1, 11}}


def test_polygons_equal_brute_force(spark):
    rnd = random.Random(4)
    zones = []
    for z in range(12):
        cx, cy = rnd.uniform(-1, 1), rnd.uniform(-1, 1)
        turns = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(rnd.choice([3, 5, 40])))
        outer = [(round(cx + math.cos(t) * rnd.uniform(0.1, 0.9), 3), round(cy + math.sin(t) * rnd.uniform(0.1, 0.9), 3)) for t in turns]
        zones.append((f"z{z}", [(0, 0, outer)]))
    points = [(i, round(rnd.uniform(-2, 2), 2), round(rnd.uniform(-2, 2), 2)) for i in range(600)]
    points += [(1000 + i, x, y) for i, (x, y) in enumerate(v for _, rings in zones for v in rings[0][2])]
    points += [(2000 + i, 0.31, 0.17) for i in range(400)]  # a hot cell of copies
    want = {(i, z) for i, x, y in points for z, rings in zones if inside((x, y), [r[2] for r in rings])}
    frame = spark.createDataFrame(points, POINTS)
    for cell, hot in ((50_000, None), (100_000, 50)):
        rows = spatial.points_in_polygons(frame, vertices(spark, zones), cell=cell, hot_rows=hot).collect()
        assert {(r.id, r.zone_id) for r in rows} == want and len(rows) == len(want)


def _crowded(rnd, zones=9, points=3000):
    outlines = []
    for z in range(zones):
        turns = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(rnd.choice([3, 6, 30])))
        outer = [(round(0.2 + math.cos(t) * rnd.uniform(0.02, 0.2), 4), round(0.1 + math.sin(t) * rnd.uniform(0.02, 0.2), 4)) for t in turns]
        outlines.append((f"z{z}", [(0, 0, outer)] + ([(0, 1, [(0.19, 0.09), (0.21, 0.09), (0.2, 0.12)])] if z % 2 else [])))
    places = [(round(rnd.uniform(-0.05, 0.45), 3), round(rnd.uniform(-0.1, 0.3), 3)) for _ in range(points)]
    places += [v for _, rings in outlines for _, _, ring in rings for v in ring] + [(0.201, 0.103)] * 300
    rows = [(i, rnd.choice(["z0", "z1", "z5", None]), x, y) for i, (x, y) in enumerate(places)] + [(90_000, "z1", None, 0.1)]
    return outlines, rows


def test_crowded_border_cells_are_cut_and_hold_the_same_points(spark):
    zones, rows = _crowded(random.Random(11))
    want = {(i, z) for i, _, x, y in rows if x is not None for z, rings in zones if inside((x, y), [r[2] for r in rings])}
    points = spark.createDataFrame(rows, "id long, own string, longitude double, latitude double")
    spots = spatial._in_units(points, "longitude", "latitude")
    cover, sides = spatial.fitted_cover(spots, spatial.polygon_edges(vertices(spark, zones)), "zone_id", 50_000, 8)
    near = spatial._at(spots, sides).join(cover, spatial.CELL_KEYS)
    got = near.where(spatial._holds(F.col("_x"), F.col("_y"))).select("id", "zone_id").collect()
    assert {(r.id, r.zone_id) for r in got} == want and len(got) == len(want)
    met = near.where("not inner").count()
    assert len(sides) > 2 and met < spatial._at(spots, [50_000]).join(spatial.polygon_cover(spatial.polygon_edges(vertices(spark, zones))), ["_row", "_col"]).count() / 3


@pytest.mark.parametrize("small", [False, True])
def test_polygon_counts_equal_the_pairs_without_making_them(spark, monkeypatch, small):
    zones, rows = _crowded(random.Random(12))
    held = [(own, z) for _, own, x, y in rows if x is not None for z, rings in zones if inside((x, y), [r[2] for r in rings])]
    want = {z: (sum(h[1] == z for h in held), sum(h == (z, z) for h in held)) for z in {h[1] for h in held}}
    if small:
        for name, value in (("SPOTS_PER_GROUP", 20), ("EDGES_PER_GROUP", 4), ("PAIRS_AT_ONCE", 100)):
            monkeypatch.setattr(spatial, name, value)
    points = spark.createDataFrame(rows, "id long, own string, longitude double, latitude double")
    monkeypatch.setattr(spatial, "points_in_polygons", None)
    got = spatial.polygon_counts(points, vertices(spark, zones), "own", most=30 if small else 1 << 14, hot_rows=40).collect()
    assert {r.zone_id: (r.inside, r.inside_own) for r in got} == want and len(got) == len(want)


def test_inner_cells_carry_no_edges(spark):
    cover = spatial.polygon_cover(spatial.polygon_edges(vertices(spark, [("a", [(0, 0, SQUARE), (0, 1, HOLE)])])), cell=50_000)
    kinds = {(r.inner, r.n > 0): r["count"] for r in cover.select("inner", F.size("edges").alias("n")).groupBy("inner", "n").count().collect()}
    assert kinds[(True, False)] > 250 and set(kinds) == {(True, False), (False, True)}
    assert cover.agg(F.max(F.size("edges"))).first()[0] <= 4
    hole = cover.where("_row = 10 and _col = 10").count()
    assert hole == 0  # wholly inside the hole: no row at all


def test_no_cross_join_and_hot_cells_are_split(spark):
    points = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0.21).otherwise(F.col("id") / 3000).alias("longitude"), F.lit(0.2).alias("latitude"))
    joined = spatial.points_in_polygons(points, vertices(spark, [("a", [(0, 0, SQUARE)])]), hot_rows=100)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert joined.count() == 3000


def test_skewed_join_equals_plain_join(spark):
    big = spark.range(2000).select(F.when(F.col("id") < 900, None).when(F.col("id") < 1500, 7).otherwise(F.col("id") % 20).alias("k"), F.lit("same").alias("v"))
    small = spark.createDataFrame([(k, f"s{k}-{j}") for k in range(15) for j in range(2)], "k long, s string")
    for how in ("inner", "left"):
        got = spatial.skewed_join(big, small, ["k"], how, hot_rows=40).groupBy("k", "s").count().collect()
        assert {(r.k, r.s, r["count"]) for r in got} == {(r.k, r.s, r["count"]) for r in big.join(small, "k", how).groupBy("k", "s").count().collect()}


# ---------------------------------------------------------------- distances


def metres(a, b):
    (lon1, lat1), (lon2, lat2) = a, b
    h = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    h += math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * spatial.EARTH_RADIUS_M * math.asin(math.sqrt(min(1.0, h)))


def world(rnd, n):
    out = []
    for i in range(n):
        spot = rnd.choice([(2.0, 48.0), (179.95, 10.0), (0.0, 89.9), (-60.0, -89.95), (10.0, 0.0)])
        lon, lat = spot[0] + rnd.uniform(-0.3, 0.3), max(-90.0, min(90.0, spot[1] + rnd.uniform(-0.3, 0.3)))
        out.append((i, (lon + 180.0) % 360.0 - 180.0, lat))
    return out


@pytest.mark.parametrize("radius", [500.0, 20_000.0, 400_000.0])
def test_within_distance_equals_all_pairs(spark, radius):
    rnd = random.Random(int(radius))
    points, sites = world(rnd, 300), [(f"s{i}", x, y) for i, x, y in world(rnd, 40)]
    points += [(1000 + i, 2.1, 48.1) for i in range(150)]  # a third of all points in one cell
    want = {(p, s): metres((x, y), (u, v)) for p, x, y in points for s, u, v in sites if metres((x, y), (u, v)) <= radius}
    frame = spark.createDataFrame([*points, (5000, None, 1.0)], POINTS)
    places = spark.createDataFrame([*sites, ("none", None, None), (None, 2.0, 48.0)], "site_id string, longitude double, latitude double")
    rows = spatial.within_distance(frame, places, radius, hot_rows=30).collect()
    assert {(r.id, r.site_id) for r in rows} == set(want) and len(rows) == len(want)
    assert all(abs(r.distance_m - want[r.id, r.site_id]) < 0.001 for r in rows)


def test_buffer_counts(spark):
    frame = spark.createDataFrame([(i, 2.0 + i * 0.001, 48.0) for i in range(30)], POINTS)
    sites = spark.createDataFrame([("a", 2.0, 48.0), ("far", 9.0, 40.0), ("nowhere", None, None)], "site_id string, longitude double, latitude double")
    rows = {r.site_id: (r.within_500m, r.within_1000m) for r in spatial.buffer_counts(frame, sites, (500.0, 1000.0)).collect()}
    step = metres((2.0, 48.0), (2.001, 48.0))
    assert rows == {"a": (int(500 / step) + 1, int(1000 / step) + 1), "far": (0, 0), "nowhere": (0, 0)}


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_sites_equal_all_pairs(spark, k):
    rnd = random.Random(k)
    points, sites = world(rnd, 250), [(f"s{i:02}", x, y) for i, x, y in world(rnd, 30)]
    sites += [(f"t{i}", 2.0, 48.0) for i in range(4)] + [("lone", -100.0, 40.0)]  # equal distances; far from all others
    points += [(1000 + i, 2.0, 48.0) for i in range(120)] + [(2000, -101.0, 41.0), (2001, 75.0, -30.0), (2002, 180.0, 90.0), (2003, -180.0, -90.0)]
    frame = spark.createDataFrame([*points, (3000, None, 5.0)], POINTS)
    places = spark.createDataFrame(sites, "site_id string, longitude double, latitude double")
    got = {(r.id, r["rank"]): r for r in spatial.nearest_sites(frame, places, k, hot_rows=40).collect()}
    assert got.pop((3000, None)).site_id is None
    assert len(got) == len(points) * k
    for p, x, y in points:
        ranked = sorted((metres((x, y), (u, v)), s) for s, u, v in sites)[:k]
        for rank, (d, s) in enumerate(ranked, 1):
            assert abs(got[p, rank].distance_m - d) < 0.001
            close = [t for e, t in ranked if abs(e - d) < 1e-6]
            assert got[p, rank].site_id in close or len(close) == 1 and got[p, rank].site_id == s


def test_nearest_with_few_sites(spark):
    frame = spark.createDataFrame([(1, 2.0, 48.0)], POINTS)
    schema = "site_id string, longitude double, latitude double"
    two = spatial.nearest_sites(frame, spark.createDataFrame([("a", 2.05, 48.0), ("b", 3.0, 48.0)], schema), 5).collect()
    assert [(r.site_id, r["rank"], r.ring) for r in two] == [("a", 1, 0), ("b", 2, 10)]
    none = spatial.nearest_sites(frame, spark.createDataFrame([], schema), 2).collect()
    assert [(r.id, r.site_id, r["rank"]) for r in none] == [(1, None, None)]


def test_candidates_per_point_do_not_grow_with_the_sites(spark):
    """Crowded sites get smaller shared cells; the nearest sites and rings stay those of all pairs."""
    rnd = random.Random(8)
    spots = [(i, round(rnd.uniform(2.0, 2.2), 6), round(rnd.uniform(48.0, 48.2), 6)) for i in range(2000)]
    sites = [(f"s{i}", round(rnd.uniform(2.0, 2.2), 6), round(rnd.uniform(48.0, 48.2), 6)) for i in range(60)]
    points, places = spark.createDataFrame(spots, POINTS), spark.createDataFrame(sites, "site_id string, longitude double, latitude double")
    assert spatial.wanted_halvings(spatial._sites(places, "site_id", "longitude", "latitude"), 0.1) > 0
    got = {(r.id, r["rank"]): (r.site_id, r.ring) for r in spatial.nearest_sites(points, places, 2).collect()}
    row, col = (lambda lat: math.floor((lat + 90.0) / 0.1)), (lambda lon: math.floor((lon + 180.0) / 0.1))
    for i, x, y in spots:
        order = sorted((metres((x, y), (u, v)), s, u, v) for s, u, v in sites)[:2]
        assert [got[i, n + 1] for n in range(2)] == [(s, max(abs(row(v) - row(y)), abs(col(u) - col(x)))) for _, s, u, v in order]
    assert len(got) == 4000
