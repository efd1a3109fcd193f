"""Registered spatial joins (X4) and their SQL: all pairs, or a box and every edge, decided point by point."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonescope.functions.columns import empty_to_null, to_double, to_int
from zonescope.operators import spatial
from zonescope.plans import oracle
from zonescope.plans.oracle import nz

NEAR_M = 5000.0
BUFFERS_M = (500.0, 1000.0, 5000.0)


def boundaries(m) -> DataFrame:
    """Vertices of the zones' outlines."""
    raw = m.extra("zone_boundaries")
    return raw.select(
        empty_to_null("code_commune").alias("zone_id"), to_int("part").alias("part"), to_int("ring").alias("ring"),
        to_int("vertex").alias("vertex"), to_double("longitude").alias("longitude"), to_double("latitude").alias("latitude"))


def hubs(m) -> DataFrame:
    raw = m.extra("transport_hubs")
    return raw.select(empty_to_null("hub_id").alias("hub_id"), F.lower(empty_to_null("hub_kind")).alias("hub_kind"),
                      to_double("longitude").alias("longitude"), to_double("latitude").alias("latitude"))


def _poi(m) -> DataFrame:
    return m.staged["tourism_poi"].select("poi_id", "longitude", "latitude")


def points_in_zones(m) -> DataFrame:
    return spatial.points_in_polygons(_poi(m), boundaries(m)).select("poi_id", "zone_id")


def zone_poi_counts(m) -> DataFrame:
    """Points of interest inside each outline, by the zone their own code names or another."""
    points = m.staged["tourism_poi"].select("poi_id", "code_commune", "longitude", "latitude")
    return spatial.polygon_counts(points, boundaries(m), "code_commune").withColumnsRenamed({"inside": "poi_inside", "inside_own": "poi_same_code"})


def poi_within_distance(m) -> DataFrame:
    return spatial.within_distance(_poi(m), hubs(m), NEAR_M, "hub_id").select("poi_id", "hub_id", "distance_m")


def hub_buffers(m) -> DataFrame:
    return spatial.buffer_counts(_poi(m), hubs(m), BUFFERS_M, "hub_id")


def nearest_hub(m) -> DataFrame:
    return spatial.nearest_sites(_poi(m), hubs(m), 1, "hub_id").select("poi_id", "hub_id", "distance_m", "ring")


def nearest_stations(m) -> DataFrame:
    """The three nearest stations of every sale."""
    sales = m.staged["dvf_mutations"].select("transaction_id", "longitude", "latitude")
    stations = hubs(m).where(F.col("hub_kind") == "gare").select("hub_id", "longitude", "latitude")
    return spatial.nearest_sites(sales, stations, 3, "hub_id").select("transaction_id", "rank", "hub_id", "distance_m")


# ---------------------------------------------------------------- oracle SQL

_XY = "CAST(round(longitude * 1000000) AS BIGINT) AS x, CAST(round(latitude * 1000000) AS BIGINT) AS y"
_COORDINATES = f"TRY_CAST({nz('longitude')} AS DOUBLE) AS longitude, TRY_CAST({nz('latitude')} AS DOUBLE) AS latitude"
_HUBS = f"(SELECT hub_id, lower({nz('hub_kind')}) AS hub_kind, {_COORDINATES} FROM raw_transport_hubs)"

_POLYGONS_SQL = f"""SELECT p.poi_id, p.code_commune, e.zone_id FROM
  (SELECT poi_id, code_commune, {_XY} FROM s_poi WHERE longitude IS NOT NULL AND latitude IS NOT NULL) p
  JOIN (SELECT zone_id, x AS x1, y AS y1, COALESCE(lead(x) OVER w, first(x) OVER w) AS x2, COALESCE(lead(y) OVER w, first(y) OVER w) AS y2,
          min(x) OVER z AS lo_x, max(x) OVER z AS hi_x, min(y) OVER z AS lo_y, max(y) OVER z AS hi_y
        FROM (SELECT code_commune AS zone_id, part, ring, CAST(vertex AS INTEGER) AS vertex, {_XY}
              FROM (SELECT code_commune, part, ring, vertex, {_COORDINATES} FROM raw_zone_boundaries) WHERE longitude IS NOT NULL)
        WINDOW w AS (PARTITION BY zone_id, part, ring ORDER BY vertex), z AS (PARTITION BY zone_id)) e
  ON p.x BETWEEN e.lo_x AND e.hi_x AND p.y BETWEEN e.lo_y AND e.hi_y
GROUP BY p.poi_id, p.code_commune, e.zone_id, p.x, p.y
HAVING bool_or((p.y - y1) * (x2 - x1) = (p.x - x1) * (y2 - y1) AND p.x BETWEEN least(x1, x2) AND greatest(x1, x2)
               AND p.y BETWEEN least(y1, y2) AND greatest(y1, y2))
  OR count_if((y1 > p.y) <> (y2 > p.y) AND CASE WHEN y2 > y1 THEN (p.y - y1) * (x2 - x1) < (p.x - x1) * (y2 - y1)
              ELSE (p.y - y1) * (x2 - x1) > (p.x - x1) * (y2 - y1) END) % 2 = 1"""


def _distance_sql(a: str, b: str) -> str:
    half_lat = f"sin(radians({b}.latitude - {a}.latitude) / 2)"
    half_lon = f"sin(radians({b}.longitude - {a}.longitude) / 2)"
    h = f"{half_lat} * {half_lat} + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * {half_lon} * {half_lon}"
    return f"CAST({2 * spatial.EARTH_RADIUS_M!r} AS DOUBLE) * asin(sqrt(least(CAST(1 AS DOUBLE), {h})))"


def _round_m(expr: str) -> str:
    return oracle.round_d(expr, 3)


_PAIRS_SQL = f"""SELECT p.poi_id, h.hub_id, {_distance_sql('p', 'h')} AS d FROM s_poi p JOIN {_HUBS} h
  ON p.longitude IS NOT NULL AND p.latitude IS NOT NULL AND h.longitude IS NOT NULL AND abs(p.latitude - h.latitude) < 0.1"""
_WITHIN_SQL = f"SELECT poi_id, hub_id, {_round_m('d')} AS distance_m FROM ({_PAIRS_SQL}) WHERE d <= {NEAR_M}"
_BUFFERS_SQL = ("SELECT h.hub_id, " + ", ".join(f"CAST(COALESCE(count_if(d <= {r}), 0) AS BIGINT) AS within_{int(r)}m" for r in BUFFERS_M)
                + f" FROM raw_transport_hubs h LEFT JOIN ({_PAIRS_SQL}) USING (hub_id) GROUP BY h.hub_id")


def _nearest_sql(points: str, key: str, where: str, k: int) -> str:
    side = spatial.POINT_CELL
    def cell(a, axis, off):
        return f"CAST(floor(({a}.{axis} + CAST({off} AS DOUBLE)) / CAST({side} AS DOUBLE)) AS BIGINT)"
    gaps = ", ".join(f"abs({cell('h', axis, off)} - {cell('p', axis, off)})" for axis, off in (("latitude", 90), ("longitude", 180)))
    return f"""SELECT p.{key}, r.hub_id, {_round_m('r.d')} AS distance_m, r.ring, CAST(r.rank AS INTEGER) AS rank FROM {points} p LEFT JOIN
  (SELECT p.{key}, h.hub_id, {_distance_sql('p', 'h')} AS d, greatest({gaps}) AS ring, row_number() OVER (PARTITION BY p.{key} ORDER BY d, h.hub_id) AS rank
   FROM {points} p JOIN {_HUBS} h ON p.longitude IS NOT NULL AND p.latitude IS NOT NULL AND h.longitude IS NOT NULL{where}
   QUALIFY rank <= {k}) r USING ({key})"""


assert math.isclose(spatial.METRES_PER_DEGREE * 0.1, 11119.5, rel_tol=1e-3)  # the latitude band of _PAIRS_SQL is wider than NEAR_M


def _sql(select: str, doubles=()) -> str:
    return oracle.with_ctes(oracle.rounded(select, list(doubles)))


def spatial_queries(Query) -> list:
    """(name, ids, builder, sql) entries; ``Query`` is the registry's record type."""
    return [
        Query("points_in_zones", "X4 point in polygon", points_in_zones, _sql(f"SELECT poi_id, zone_id FROM ({_POLYGONS_SQL})")),
        Query("zone_poi_counts", "X4 point in polygon, counted", zone_poi_counts,
              _sql("SELECT zone_id, count(*) AS poi_inside, CAST(COALESCE(count_if(code_commune = zone_id), 0) AS BIGINT) AS poi_same_code "
                   f"FROM ({_POLYGONS_SQL}) GROUP BY zone_id")),
        Query("poi_within_distance", "X4 distance within", poi_within_distance, _sql(_WITHIN_SQL, ["distance_m"])),
        Query("hub_buffers", "X4 buffers", hub_buffers, _sql(_BUFFERS_SQL)),
        Query("nearest_hub", "X4 nearest hub", nearest_hub,
              _sql("SELECT poi_id, hub_id, distance_m, ring FROM (" + _nearest_sql("s_poi", "poi_id", "", 1) + ")", ["distance_m"])),
        Query("nearest_stations", "X4 nearest three", nearest_stations,
              _sql("SELECT transaction_id, rank, hub_id, distance_m FROM ("
                   + _nearest_sql("s_sales", "transaction_id", " AND h.hub_kind = 'gare'", 3) + ")", ["distance_m"])),
    ]
