"""Spatial joins (X4): points in polygons, points near sites, nearest sites.

All three prune by an equi-join on grid cells and decide exactly afterwards;
none pairs all points with all polygons or sites.

* :func:`points_in_polygons`: the polygons are cut into cells.  Cells wholly
  inside a polygon decide without looking at an edge; a cell that an edge may
  touch carries the few edges that matter there, and the point is ray-cast
  against those alone.  Coordinates are whole millionths of a degree, so the
  tests are exact integer arithmetic; the boundary belongs to the polygon.
  :func:`polygon_counts` counts the points per polygon without those pairs.
* :func:`within_distance`: every site is copied to the cells its circle can
  touch and the copies are sent to the points, block by block; the great-circle
  distance decides.
* :func:`nearest_sites`: candidates are found per *cell of points*, not per
  point: from the whole globe downwards the cells of sites are refined, and a
  cell is dropped as soon as its nearest corner is farther than ``k`` sites
  are at most (the stop distance, proven from cell bounds).  A point then
  looks at its own cell's candidates only.

Points are the large side.  Cells with very many points are salted
(:func:`skewed_join`), so a cell holding a third of all points is split over
tasks.  Points without a coordinate lie nowhere.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonescope.functions.columns import round_half_up
from zonescope.session import scratch_path

#: Units of a degree in which polygon tests are exact.
UNITS = 1_000_000
#: Side of a polygon cover's cell, in units (0.05 degrees).
COVER_CELL = 50_000
#: A border cell with more spots than this is cut into ``CUT`` x ``CUT`` cells, while its side in units divides by ``CUT``.
SPOTS_PER_BORDER_CELL = 1 << 14
CUT = 5
#: Edges of a cover row that are tested without an array.
UNROLLED_EDGES = 8
#: Cells of a tile's side, whose spots and edges are one group of a task ...
TILE = 4
#: ... of at most about so many spots (edges).
SPOTS_PER_GROUP = 1 << 16
EDGES_PER_GROUP = 1 << 16
#: Pairs of a spot and an edge held at once.
PAIRS_AT_ONCE = 1 << 19
CELL_KEYS = ["_side", "_row", "_col"]
#: Mean earth radius (metres).
EARTH_RADIUS_M = 6_371_008.8
METRES_PER_DEGREE = math.pi * EARTH_RADIUS_M / 180.0
#: Side of a cell of points that shares its candidate sites, in degrees.
POINT_CELL = 0.1
#: Cells of sites are refined down to ``POINT_CELL / 4**FINER``.
FINER = 2
#: Cells of points are halved until a site's cell holds about so many sites, at most ``MOST_HALVINGS`` times ...
SITES_PER_CELL = 2
MOST_HALVINGS = 8
#: ... and while so many points share a cell.
POINTS_PER_CELL = 64
#: A key with more rows than this is salted ...
HOT_ROWS = 200_000
#: ... and at most so many keys are (the limit rises with the table), which bounds the broadcast list of them.
MOST_HOT_KEYS = 10_000
#: Rows without a key are dealt to so many salts.
NULL_SALTS = 4096
#: Copies of sites that are sent to the points at once (some 100 MB), and passes over the points before these are dealt by cell instead.
SITES_PER_BROADCAST = 1_000_000
MOST_BROADCASTS = 16
#: A side of at most so many rows, by construction, is broadcast.
SMALL_ROWS = 1 << 16


def _written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, f"spatial/{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --------------------------------------------------------------------------
# Hot keys
# --------------------------------------------------------------------------

def skewed_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", hot_rows: int | None = None) -> DataFrame:
    """``big`` joined with ``small`` on ``keys`` (``inner`` or ``left``), hot keys of ``big`` split over tasks.

    One counting pass (partial aggregates) finds the keys with more than
    ``hot_rows`` rows (``HOT_ROWS`` by default); their rows are dealt to numbered salts and their
    ``small`` rows copied to each.  Rows without a key match nothing and are
    spread.  ``big`` should be a table scan with projections: the salts follow
    its row order, so that copies of one row are split as well.
    """
    counts = _written(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    limit = max(HOT_ROWS if hot_rows is None else hot_rows, total // MOST_HOT_KEYS)
    hot = counts.where(F.col("_rows") > limit).select(*keys, F.ceil(F.col("_rows") / limit).cast("int").alias("_salts"))
    hot = F.broadcast(hot)  # at most MOST_HOT_KEYS rows
    salts = F.coalesce("_salts", F.lit(1))
    spread = F.when(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]), F.lit(NULL_SALTS)).otherwise(salts)
    dealt = big.join(hot, keys, "left").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), spread).cast("int")).drop("_salts")
    copied = small.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return dealt.join(copied, [*keys, "_salt"], how).drop("_salt")


# --------------------------------------------------------------------------
# Points in polygons
# --------------------------------------------------------------------------

def units(c: Column) -> Column:
    """Degrees as whole millionths."""
    return F.round(c * UNITS).cast("long")


def polygon_edges(vertices: DataFrame, zone: str = "zone_id", ring: tuple[str, ...] = ("part", "ring"), order: str = "vertex",
                  lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """(zone, x1, y1, x2, y2), ``y1 <= y2``: the edges of all rings, each ring closed from its last vertex to its first.

    Holes and further parts are rings as well (even-odd rule).  Vertices
    without a zone or coordinate are left out.
    """
    clean = vertices.where(F.col(zone).isNotNull() & F.col(lon).isNotNull() & F.col(lat).isNotNull())
    clean = clean.select(zone, *ring, order, units(F.col(lon)).alias("x"), units(F.col(lat)).alias("y"))
    along = Window.partitionBy(zone, *ring).orderBy(order)
    start, end = F.struct("y", "x"), F.struct(
        F.coalesce(F.lead("y").over(along), F.first("y").over(along)).alias("y"),
        F.coalesce(F.lead("x").over(along), F.first("x").over(along)).alias("x"))
    both = clean.select(zone, F.least(start, end).alias("a"), F.greatest(start, end).alias("b")).where("a != b")
    return both.select(zone, F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))


def polygon_cover(edges: DataFrame, zone: str = "zone_id", cell: int = COVER_CELL) -> DataFrame:
    """One row per (zone, cell) that may hold points of the zone: ``inner``, or else ``base`` and ``edges``.

    Every edge is followed through the rows of cells it crosses; the columns
    it may touch there (one unit of margin) are the border cells.  What lies
    between them in a row is wholly in or out, decided once at mid-height.  A
    border cell keeps the edges that touch it or end left of it within the
    row; edges left of it that cross the whole row only count into ``base``.
    The work is that of the polygons' edges and cells, whatever the points.
    """
    cut = edges.withColumn("_row", F.explode(F.sequence(F.floor(F.col("y1") / cell), F.floor(F.col("y2") / cell))))
    bands = cut.groupBy(zone, "_row").agg(F.collect_list(_in_row({k: F.col(k) for k in ("x1", "y1", "x2", "y2")}, cell)).alias("band"))
    columns = F.sequence(F.array_min(F.transform("band", lambda e: e["from"])), F.array_max(F.transform("band", lambda e: e["to"])))
    return _cells(bands.withColumns({"_columns": columns, "base": F.lit(0)}), zone, cell)


def finer_cover(border: DataFrame, zone: str, cell: int) -> DataFrame:
    """The cover of border cells of side ``cell`` by cells of a ``CUT``-th of it, each decided from its parent's edges alone."""
    side = cell // CUT
    first_row, first_col = F.col("_row") * CUT, F.col("_col") * CUT
    rows = border.select(zone, "base", "edges", F.sequence(first_col, first_col + (CUT - 1)).alias("_columns"),
                         F.explode(F.sequence(first_row, first_row + (CUT - 1))).alias("_row"))
    low, high = F.col("_row") * side, (F.col("_row") + 1) * side
    band = F.transform(F.filter("edges", lambda e: (e["y1"] < high) & (e["y2"] >= low)), lambda e: _in_row(e, side))
    return _cells(rows.select(zone, "_row", "base", "_columns", band.alias("band")), zone, side)


def _in_row(e, cell: int) -> Column:
    """An edge with the columns it may touch in the row of cells ``_row``, and whether it crosses the whole row."""
    low, high = F.col("_row") * cell, (F.col("_row") + 1) * cell
    slope = (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0))
    at_low = e["x1"] + (F.greatest(e["y1"], low) - e["y1"]) * slope
    at_high = e["x1"] + (F.least(e["y2"], high) - e["y1"]) * slope
    level = e["y1"] == e["y2"]
    left = F.when(level, F.least(e["x1"], e["x2"])).otherwise(F.floor(F.least(at_low, at_high))) - 1
    right = F.when(level, F.greatest(e["x1"], e["x2"])).otherwise(F.ceil(F.greatest(at_low, at_high))) + 1
    return F.struct(*[e[k].alias(k) for k in ("x1", "y1", "x2", "y2")], F.floor(left / cell).alias("from"), F.floor(right / cell).alias("to"),
                    ((e["y1"] <= low) & (e["y2"] >= high)).alias("whole"))


def _cells(bands: DataFrame, zone: str, cell: int) -> DataFrame:
    """The cover rows of the cells ``_columns`` of rows of cells; ``band`` are the row's edges, ``base`` those left of all of them."""
    cells = bands.withColumn("_col", F.explode("_columns"))
    col, middle = F.col("_col"), F.col("_row") * cell + cell // 2
    crossed = F.filter("band", lambda e: (e["to"] < col) & (e["y1"] <= middle) & (middle < e["y2"]))
    kept = F.filter("band", lambda e: (e["from"] <= col) & ~((e["to"] < col) & e["whole"]))
    cells = cells.select(
        zone, "_row", "_col",
        (~F.exists("band", lambda e: (e["from"] <= col) & (col <= e["to"]))).alias("inner"),
        (F.col("base") + F.size(F.filter("band", lambda e: (e["to"] < col) & e["whole"]))).alias("base"),
        F.transform(kept, lambda e: F.struct(e["x1"].alias("x1"), e["y1"].alias("y1"), e["x2"].alias("x2"), e["y2"].alias("y2"))).alias("edges"),
        ((F.col("base") + F.size(crossed)) % 2 == 1).alias("_odd"),
    )
    cells = cells.where(~F.col("inner") | F.col("_odd"))
    none = F.array().cast("array<struct<x1:bigint,y1:bigint,x2:bigint,y2:bigint>>")
    return cells.select(zone, "_row", "_col", "inner", "base", F.when(F.col("inner"), none).otherwise(F.col("edges")).alias("edges"))


def _at(points: DataFrame, sides: list[int]) -> DataFrame:
    """A row per point (``_x``, ``_y``) and cell side, with the cell it lies in."""
    sided = points.withColumn("_side", F.explode(F.array(*map(F.lit, sides))))
    return sided.withColumns({"_row": F.floor(F.col("_y") / F.col("_side")), "_col": F.floor(F.col("_x") / F.col("_side"))})


def fitted_cover(points: DataFrame, edges: DataFrame, zone: str, cell: int, most: int) -> tuple[DataFrame, list[int]]:
    """The cover by cells of several sides (``_side``), and the sides: border cells with over ``most`` points are cut further.

    So the tests of a point against an outline near it stay few however many
    points and outlines share a place; a crowded border cell costs ``CUT**2``
    cells instead of a test per point.
    """
    cover, sides, done = _written(polygon_cover(edges, zone, cell), f"cover-{cell}"), [cell], []
    while True:
        side = sides[-1]
        sided = cover.withColumn("_side", F.lit(side))
        crowded = None
        if side % CUT == 0:
            counted = _at(points, [side]).groupBy("_row", "_col").agg(F.count(F.lit(1)).alias("n"))
            crowded = _written(counted.where(F.col("n") > most).select("_row", "_col"), f"crowded-{side}")
        if crowded is None or crowded.isEmpty():
            return reduce(DataFrame.unionByName, [*done, sided]), sides
        border = cover.where("not inner")
        done += [sided.where("inner"), sided.where("not inner").join(crowded, ["_row", "_col"], "left_anti").select(sided.columns)]
        cover = _written(finer_cover(border.join(crowded, ["_row", "_col"], "left_semi"), zone, side), f"cover-{side // CUT}")
        sides.append(side // CUT)


def _holds(x: Column, y: Column) -> Column:
    """Whether a cover row's zone holds the point: on one of its edges, or an odd number of edges to the left."""
    def ahead(e):
        return (y - e["y1"]) * (e["x2"] - e["x1"])

    def beside(e):
        return (x - e["x1"]) * (e["y2"] - e["y1"])

    on_edge = F.exists("edges", lambda e: y.between(e["y1"], e["y2"]) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                       & (ahead(e) == beside(e)))
    to_the_left = F.size(F.filter("edges", lambda e: (e["y1"] <= y) & (y < e["y2"]) & (ahead(e) < beside(e))))
    return F.col("inner") | on_edge | ((F.col("base") + to_the_left) % 2 == 1)


def _unrolled(cover: DataFrame) -> DataFrame:
    """The cover with the edges of rows that hold at most ``UNROLLED_EDGES`` in columns of their own instead of ``edges``: start, width and end.

    Missing edges end below where they start, so that no point is level with them.
    """
    fits = F.col("inner") | (F.size("edges") <= UNROLLED_EDGES)
    ends = {}
    for i in range(UNROLLED_EDGES):
        edge = F.when(fits, F.get("edges", F.lit(i)))
        ends |= {f"_x_{i}": edge["x1"], f"_w_{i}": edge["x2"] - edge["x1"], f"_y_{i}": edge["y1"], f"_end_{i}": F.when(edge.isNull(), -1).otherwise(edge["y2"])}
    return cover.withColumns(ends).withColumn("edges", F.when(~fits, F.col("edges")))


def _never_null(df: DataFrame, names: list[str]) -> DataFrame:
    """Tell Spark that the columns, which hold no null, are not nullable: the compiled tests then look for none and stay short."""
    return df.withColumns({c: F.coalesce(c, F.lit(0).cast(df.schema[c].dataType)) for c in names})


def _holds_unrolled(x: Column, y: Column) -> Column:
    """As :func:`_holds` over the columns of :func:`_unrolled`: no arrays, so that it is compiled.  A sum that is null says that an edge holds the point."""
    total = F.col("base").cast("long")
    for i in range(UNROLLED_EDGES):
        x1, width, y1, y2 = (F.col(f"_{k}_{i}") for k in ("x", "w", "y", "end"))
        right, up = x - x1, y2 - y1
        gap = (y - y1) * width - right * up
        on_edge = (gap == 0) & ((up > 0) | right.between(F.lit(0), width))  # a level edge starts at its left end
        total += F.when((y < y1) | (y > y2), 0).when(on_edge, F.lit(None).cast("long")).when((gap < 0) & (y < y2), 1).otherwise(0)
    return F.col("inner") | F.coalesce(total % 2 == 1, F.lit(True))


def points_in_polygons(points: DataFrame, vertices: DataFrame, zone: str = "zone_id", lon: str = "longitude", lat: str = "latitude",
                       cell: int = COVER_CELL, hot_rows: int | None = None) -> DataFrame:
    """The columns of ``points`` and the polygon's ``zone`` for every point and polygon that meet.

    A point in no polygon has no row, one in several overlapping polygons a
    row for each; a point on an outer edge, a hole's edge or a vertex is in.
    ``vertices`` as in :func:`polygon_edges`; ``zone`` must not be a column of
    ``points``.  Cells with few edges, which are most, are tested by compiled
    arithmetic; the others, if there are any, are joined on their own.
    """
    cover = _written(_unrolled(polygon_cover(polygon_edges(vertices, zone), zone, cell)), "cover")
    x, y = units(F.col(lon)), units(F.col(lat))
    placed = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).withColumns(
        {"_x": x, "_y": y, "_row": F.floor(y / cell), "_col": F.floor(x / cell)})
    few = cover.where("edges is null").drop("edges")
    few = _never_null(few, [c for c in few.columns if c not in (zone, "_row", "_col")])
    met = skewed_join(_never_null(placed, ["_x", "_y"]), few, ["_row", "_col"], hot_rows=hot_rows).where(_holds_unrolled(F.col("_x"), F.col("_y")))
    met = met.select(*points.columns, zone)
    many = cover.where("edges is not null")
    if many.isEmpty():
        return met
    there = placed.join(many.select("_row", "_col").distinct(), ["_row", "_col"], "left_semi").select(placed.columns)
    more = skewed_join(there, many, ["_row", "_col"], hot_rows=hot_rows).where(_holds(F.col("_x"), F.col("_y")))
    return met.unionByName(more.select(*points.columns, zone))


def _in_units(points: DataFrame, lon: str, lat: str) -> DataFrame:
    return points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).withColumns({"_x": units(F.col(lon)), "_y": units(F.col(lat))})


def polygon_counts(points: DataFrame, vertices: DataFrame, own: str, zone: str = "zone_id", lon: str = "longitude", lat: str = "latitude",
                   cell: int = COVER_CELL, hot_rows: int | None = None, most: int = SPOTS_PER_BORDER_CELL) -> DataFrame:
    """(zone, inside, inside_own): per polygon that holds a point, how many it holds and how many of these name it in ``own``.

    The counts of :func:`points_in_polygons` without its pairs: the points of
    a cell wholly inside count at once, copies of a place are one spot, border
    cells count many spots at a time, and a point meets its own zone alone for
    the last column.
    """
    placed = _written(_in_units(points, lon, lat).groupBy(F.col(own).alias(zone), "_x", "_y").agg(F.count(F.lit(1)).alias("n")), "named-spots")
    spots = _written(placed.groupBy("_x", "_y").agg(F.sum("n").alias("n")), "spots")
    cover, sides = fitted_cover(spots, polygon_edges(vertices, zone), zone, cell, most)
    sided = _at(spots, sides)
    full = sided.groupBy(*CELL_KEYS).agg(F.sum("n").alias("n")).join(cover.where("inner").select(zone, *CELL_KEYS), CELL_KEYS)
    named = skewed_join(_at(placed.where(F.col(zone).isNotNull()), sides), cover, [zone, *CELL_KEYS], hot_rows=hot_rows)
    named = named.where(_holds(F.col("_x"), F.col("_y")))
    none = F.lit(0).cast("long")
    counts = [df.groupBy(zone).agg(F.sum("n").alias("n")).where("n > 0").select(zone, a.alias("inside"), b.alias("inside_own"))
              for df, a, b in ((full, F.col("n"), none), (_border_counts(sided, cover, zone), F.col("n"), none), (named, none, F.col("n")))]
    return reduce(DataFrame.unionByName, counts).groupBy(zone).agg(F.sum("inside").alias("inside"), F.sum("inside_own").alias("inside_own"))


def _border_counts(spots: DataFrame, cover: DataFrame, zone: str) -> DataFrame:
    """(zone, n) per border cell: the spots' ``n`` that the zone holds there.

    The spots and edges of a tile of ``TILE`` x ``TILE`` cells meet in a group;
    a tile with very many of either is dealt to several, every block of spots
    with every block of zones.
    """
    tile = {"_tile_row": F.floor(F.col("_row") / TILE), "_tile_col": F.floor(F.col("_col") / TILE)}
    tiles = ["_side", *tile]
    border = cover.where("not inner").select(zone, *CELL_KEYS, "base", F.explode("edges").alias("e"))
    edges = border.select(zone, *CELL_KEYS, "base", "e.*").withColumns(tile)
    spots = spots.join(cover.where("not inner").select(*CELL_KEYS).distinct(), CELL_KEYS, "left_semi").withColumns(tile)

    def blocks(df: DataFrame, most: int, name: str) -> DataFrame:
        sizes = df.groupBy(*tiles).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))
        return _written(sizes.where(F.col(name) > 1), name)

    split = blocks(spots, SPOTS_PER_GROUP, "_spot_blocks").join(blocks(edges, EDGES_PER_GROUP, "_edge_blocks"), tiles, "full")

    def dealt(df: DataFrame, by: list[str], own: str, other: str) -> DataFrame:
        known = df.join(split, tiles, "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_spot_blocks", "_edge_blocks")})
        known = known.withColumn("_" + own, F.pmod(F.xxhash64(*by), F.col(f"_{own}_blocks")).cast("int"))
        return known.withColumn("_" + other, F.explode(F.sequence(F.lit(0), F.col(f"_{other}_blocks") - 1))).drop("_spot_blocks", "_edge_blocks")

    keys, at_once = [*tiles, "_spot", "_edge"], PAIRS_AT_ONCE

    def count(spots: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        """As :func:`_holds`, for all spots and zones of a cell at a time."""
        cells = spots.groupby(["_row", "_col"]).indices
        x_all, y_all, n_all = (spots[c].to_numpy(np.int64) for c in ("_x", "_y", "n"))
        edges = edges.sort_values(["_row", "_col", zone])
        names, rows, cols = (edges[c].to_numpy() for c in (zone, "_row", "_col"))
        bases, *ends = (edges[c].to_numpy(np.int64) for c in ("base", "x1", "y1", "x2", "y2"))
        found_names, found = [], []
        turns = np.flatnonzero((rows[1:] != rows[:-1]) | (cols[1:] != cols[:-1])) + 1
        bounds = [0, *turns.tolist(), len(edges)] if len(edges) else [0]
        for a, b in zip(bounds, bounds[1:]):
            at = cells.get((rows[a], cols[a]))
            if at is None:
                continue
            starts = np.flatnonzero(np.concatenate([[True], names[a + 1 : b] != names[a : b - 1]]))
            base = bases[a:b][starts, None] % 2 == 1
            x1, y1, x2, y2 = (e[a:b, None] for e in ends)
            total, step = np.zeros(len(starts), np.int64), max(1, at_once // (b - a))
            for i in range(0, len(at), step):
                x, y, n = (v[at[i : i + step]] for v in (x_all, y_all, n_all))
                gap = (y - y1) * (x2 - x1) - (x - x1) * (y2 - y1)
                held = np.logical_xor.reduceat((y1 <= y) & (y < y2) & (gap < 0), starts, axis=0) ^ base
                if not gap.all():
                    on_edge = (gap == 0) & (y1 <= y) & (y <= y2) & (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2))
                    held |= np.logical_or.reduceat(on_edge, starts, axis=0)
                total += held @ n
            found_names.append(names[a:b][starts])
            found.append(total)
        if not found:
            return pd.DataFrame({zone: pd.Series([], dtype="object"), "n": pd.Series([], dtype="int64")})
        return pd.DataFrame({zone: np.concatenate(found_names), "n": np.concatenate(found)})

    schema = f"`{zone}` {edges.schema[zone].dataType.simpleString()}, n long"
    grouped = dealt(spots, ["_x", "_y"], "spot", "edge").groupBy(*keys)
    return grouped.cogroup(dealt(edges, [zone], "edge", "spot").groupBy(*keys)).applyInPandas(count, schema)


# --------------------------------------------------------------------------
# Distances
# --------------------------------------------------------------------------

def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def _sites(sites: DataFrame, site: str, lon: str, lat: str) -> DataFrame:
    return sites.where(F.col(site).isNotNull() & F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(
        F.col(site).alias("_site"), F.col(lon).cast("double").alias("_site_lon"), F.col(lat).cast("double").alias("_site_lat"))


def within_distance(points: DataFrame, sites: DataFrame, metres: float, site: str = "site_id", lon: str = "longitude",
                    lat: str = "latitude", hot_rows: int | None = None) -> DataFrame:
    """The columns of ``points``, the site's id and ``distance_m`` for every point at most ``metres`` from a site.

    Cells are as high as the circle.  A site is copied to the cells its circle
    can touch: two or three rows, and as many columns as its longitudes span
    at its latitude (all of them where the circle holds a pole); columns wrap
    at 180 degrees.  ``site`` must not be a column of ``points``.

    The points are not moved: blocks of at most ``SITES_PER_BROADCAST`` copies
    of sites are sent to them, each block in a pass over the points, so that
    nothing of the points' size is written and no cell is hot.  Only beyond
    ``MOST_BROADCASTS`` blocks are both sides dealt by cell.
    """
    columns = max(1, min(int(180.0 * METRES_PER_DEGREE / metres), 1 << 20))
    side, radius = 360.0 / columns, metres / METRES_PER_DEGREE
    small = _sites(sites, site, lon, lat)
    shrink = F.sin(F.radians(F.lit(min(radius, 90.0)))) / F.cos(F.radians("_site_lat"))
    polar = F.abs("_site_lat") + radius >= 90.0
    reach = F.when(polar, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), shrink)))) + 1e-9
    first = F.floor((F.col("_site_lon") + 180.0 - reach) / side)
    last = F.least(F.floor((F.col("_site_lon") + 180.0 + reach) / side), first + (columns - 1))
    rows = F.sequence(F.floor((F.col("_site_lat") + 90.0 - radius - 1e-9) / side), F.floor((F.col("_site_lat") + 90.0 + radius + 1e-9) / side))

    def cell(row: Column, col: Column) -> Column:
        return F.shiftleft(row, 32).bitwiseOR(F.pmod(col, F.lit(columns)))

    small = small.withColumn("_reach", reach).withColumn("_row", F.explode(rows)).withColumn("_col", F.explode(F.sequence(first, last)))
    small = small.select("_site", "_site_lon", "_site_lat", "_reach", cell(F.col("_row"), F.col("_col")).alias("_cell"))
    # Sorted, so that the copies of a cell lie side by side in the memory of those who look them up.
    copies = _written(small.orderBy("_cell").withColumn("_number", F.monotonically_increasing_id()), "site-copies")
    placed = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).withColumn(
        "_cell", cell(F.floor((F.col(lat) + 90.0) / side), F.floor((F.col(lon) + 180.0) / side)))
    # The circle's box, a little widened, spares most of the pairs outside the circle their trigonometry.
    gap = F.abs(F.col(lon) - F.col("_site_lon"))
    boxed = (F.abs(F.col(lat) - F.col("_site_lat")) <= radius + 1e-9) & (F.least(gap, F.abs(F.lit(360.0) - gap)) <= F.col("_reach"))
    blocks = max(1, math.ceil(copies.count() / SITES_PER_BROADCAST))
    if blocks > MOST_BROADCASTS:
        pairs = [skewed_join(placed, copies, ["_cell"], hot_rows=hot_rows)]
    else:
        pairs = [placed.join(F.broadcast(copies.where(F.pmod("_number", F.lit(blocks)) == b)), "_cell") for b in range(blocks)]
    near = [met.where(boxed).withColumn("_distance", haversine_m(F.col(lat), F.col(lon), F.col("_site_lat"), F.col("_site_lon"))).where(
        F.col("_distance") <= metres).select(*points.columns, F.col("_site").alias(site), round_half_up("_distance", 3).alias("distance_m")) for met in pairs]
    return reduce(DataFrame.unionByName, near)


def buffer_counts(points: DataFrame, sites: DataFrame, radii: tuple[float, ...], site: str = "site_id", hot_rows: int | None = None) -> DataFrame:
    """Per site: the number of points within each radius (columns ``within_<metres>m``); sites without points have zeros."""
    near = within_distance(points, sites, max(radii), site, hot_rows=hot_rows)
    names = [f"within_{int(r)}m" for r in radii]
    counted = near.groupBy(site).agg(*[F.count_if(F.col("distance_m") <= r).alias(n) for r, n in zip(radii, names, strict=True)])
    return sites.select(site).where(F.col(site).isNotNull()).distinct().join(counted, site, "left").select(
        site, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


# --------------------------------------------------------------------------
# Nearest sites
# --------------------------------------------------------------------------

def _box_bounds(row: Column, col: Column, side: Column) -> dict[str, Column]:
    """Degrees of a cell whose side is ``side`` degrees."""
    return {"s": row * side - 90.0, "n": F.least((row + 1) * side - 90.0, F.lit(90.0)), "w": col * side - 180.0, "e": (col + 1) * side - 180.0}


def _box_haversines(a: dict[str, Column], b: dict[str, Column]) -> tuple[Column, Column]:
    """Lower and upper bound of the haversine between a point of one box and a point of the other.

    Each term of the haversine grows with its difference, so the smallest
    (largest) differences and cosines bound it.
    """
    zero = F.lit(0.0)
    lat_gap = F.greatest(zero, F.greatest(a["s"], b["s"]) - F.least(a["n"], b["n"]))
    lat_span = F.greatest(a["n"], b["n"]) - F.least(a["s"], b["s"])
    lon_span = F.greatest(a["e"], b["e"]) - F.least(a["w"], b["w"])
    direct = F.greatest(zero, F.greatest(a["w"], b["w"]) - F.least(a["e"], b["e"]))
    lon_gap = F.least(direct, F.greatest(zero, F.lit(360.0) - lon_span))
    cosines = []
    for box in (a, b):
        edges = F.cos(F.radians(box["s"])), F.cos(F.radians(box["n"]))
        cosines.append((F.greatest(zero, F.least(*edges)), F.when((box["s"] <= 0) & (box["n"] >= 0), F.lit(1.0)).otherwise(F.greatest(*edges))))

    def half(angle):
        s = F.sin(F.radians(angle) / 2)
        return s * s

    low = half(lat_gap) + cosines[0][0] * cosines[1][0] * half(lon_gap)
    high = half(F.least(F.lit(180.0), lat_span)) + cosines[0][1] * cosines[1][1] * half(F.least(F.lit(180.0), lon_span))
    return low, F.least(F.lit(1.0), high)


def _prune(pairs: DataFrame, k: int) -> DataFrame:
    """Keep the site cells that may hold one of the ``k`` nearest sites of the point cell (its stop distance: where ``k`` sites are at most)."""
    own = Window.partitionBy("_row", "_col")
    reached = F.sum("n").over(own.orderBy("high", "low").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bounded = pairs.withColumn("_reached", reached).withColumn("_stop", F.min(F.when(F.col("_reached") >= k, F.col("high"))).over(own))
    return bounded.where(F.col("_stop").isNull() | (F.col("low") <= F.col("_stop") * (1 + 1e-9) + 1e-18)).drop("_reached", "_stop")


def candidate_sites(cells: DataFrame, sites: DataFrame, k: int, side: float = POINT_CELL) -> DataFrame:
    """(_row, _col, candidates): for every cell of points, all sites that may be among the ``k`` nearest of a point in it.

    ``cells`` are distinct (_row, _col) of ``side`` degrees; ``sites`` have
    ``_site``, ``_site_lon``, ``_site_lat``.  The cells of sites form a tree
    of factor 4 a side; each round opens the cells still in question and
    prunes.  A round is a join on the opened cell; the pairs stay at some tens
    per cell of points however unevenly the sites lie.
    """
    leaf = side / 4**FINER
    depth = next(d for d in range(40) if leaf * 4**d >= 360.0)
    placed = _written(sites.withColumns({"_r": F.floor((F.col("_site_lat") + 90.0) / leaf).cast("long"),
                                         "_c": F.floor((F.col("_site_lon") + 180.0) / leaf).cast("long")}), "sites")
    counts = _written(placed.groupBy("_r", "_c").agg(F.count(F.lit(1)).alias("n")), "site-cells")
    here = _box_bounds(F.col("_row"), F.col("_col"), F.lit(side))
    pairs = cells.select("_row", "_col", F.lit(0).cast("long").alias("_ur"), F.lit(0).cast("long").alias("_uc"))
    for level in range(depth - 1, -1, -1):
        shift = 2 * level
        opened = counts.groupBy(F.shiftright("_r", shift).alias("_r"), F.shiftright("_c", shift).alias("_c")).agg(F.sum("n").alias("n"))
        opened = opened.withColumns({"_ur": F.shiftright("_r", 2), "_uc": F.shiftright("_c", 2)})
        if 16 ** (depth - level) <= SMALL_ROWS:
            opened = F.broadcast(opened)
        met = pairs.join(opened, ["_ur", "_uc"])
        low, high = _box_haversines(here, _box_bounds(F.col("_r"), F.col("_c"), F.lit(leaf * 4**level)))
        pairs = _prune(met.withColumns({"low": low, "high": high}), k)
        pairs = _written(pairs.select("_row", "_col", F.col("_r").alias("_ur"), F.col("_c").alias("_uc")), f"open-{level}")
    met = pairs.withColumnsRenamed({"_ur": "_r", "_uc": "_c"}).join(placed, ["_r", "_c"])
    spot = {"s": F.col("_site_lat"), "n": F.col("_site_lat"), "w": F.col("_site_lon"), "e": F.col("_site_lon")}
    low, high = _box_haversines(here, spot)
    kept = _prune(met.withColumns({"low": low, "high": high, "n": F.lit(1)}), k)
    return kept.groupBy("_row", "_col").agg(F.collect_list(F.struct("_site", "_site_lat", "_site_lon")).alias("candidates"))


def shared_cells(counted: DataFrame, halvings: int) -> tuple[DataFrame, int]:
    """The cells of points, and how often they are halved: ``halvings`` times, or fewer where too few points would share one.

    ``counted`` has the points (``n``) per cell (_row, _col) of a side halved ``halvings`` times.
    """
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    while True:
        cells = counted.select("_row", "_col")
        if not halvings or total >= POINTS_PER_CELL * cells.count():
            return cells, halvings
        counted = counted.groupBy(F.shiftright("_row", 1).alias("_row"), F.shiftright("_col", 1).alias("_col")).agg(F.sum("n").alias("n"))
        halvings -= 1


def wanted_halvings(sites: DataFrame, side: float) -> int:
    """How often ``side`` is halved until a site shares its cell with few others, in the mean over sites."""
    cell = [F.floor((F.col("_site_lat") + 90.0) / side).alias("_r"), F.floor((F.col("_site_lon") + 180.0) / side).alias("_c")]
    counted = sites.groupBy(*cell).agg(F.count(F.lit(1)).cast("double").alias("n"))
    crowd = counted.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0] or 0.0
    return next((h for h in range(MOST_HALVINGS) if crowd <= SITES_PER_CELL * 4**h), MOST_HALVINGS)


def nearest_sites(points: DataFrame, sites: DataFrame, k: int = 1, site: str = "site_id", lon: str = "longitude", lat: str = "latitude",
                  side: float = POINT_CELL, hot_rows: int | None = None) -> DataFrame:
    """The columns of ``points`` with the ``k`` nearest sites of each, one row per point and ``rank``.

    Adds the site's id, ``distance_m``, ``rank`` (equal distances by site id)
    and ``ring``: how many rings of ``side``-degree cells lie between the
    point's cell and the site's, itself excluded.  A point without a coordinate
    keeps one row of nulls, as does every point when there is no site; fewer
    than ``k`` sites give fewer rows.
    """
    def place(step: float) -> dict[str, Column]:
        return {"_row": F.floor((F.col(lat) + 90.0) / step).cast("long"), "_col": F.floor((F.col(lon) + 180.0) / step).cast("long")}

    clean = _sites(sites, site, lon, lat)
    halvings = wanted_halvings(clean, side)
    placed = points.withColumns(place(side / 2**halvings))
    counted = placed.where("_row is not null and _col is not null").groupBy("_row", "_col").agg(F.count(F.lit(1)).alias("n"))
    cells, halvings = shared_cells(_written(counted, "point-cells"), halvings)
    fine = side / 2**halvings
    found = candidate_sites(cells, clean, k, fine).withColumn("candidates", F.transform("candidates", lambda s: F.struct(
        s["_site"].alias("site"), s["_site_lat"].alias("lat"), s["_site_lon"].alias("lon"), F.cos(F.radians(s["_site_lat"])).alias("cos"),
        F.floor((s["_site_lat"] + 90.0) / side).cast("long").alias("r"), F.floor((s["_site_lon"] + 180.0) / side).cast("long").alias("c"))))
    joined = skewed_join(points.withColumns(place(fine)), _written(found, "candidates"), ["_row", "_col"], "left", hot_rows)
    # As haversine_m, each term once: what does not depend on both is computed before, and the half angles are named.
    joined = joined.withColumns({"_cos": F.cos(F.radians(F.col(lat))), "_r": place(side)["_row"], "_c": place(side)["_col"]})
    halves = F.transform("candidates", lambda s: F.struct(
        F.sin(F.radians(s["lat"] - F.col(lat)) / 2).alias("a"), F.sin(F.radians(s["lon"] - F.col(lon)) / 2).alias("b"),
        s["cos"].alias("cos"), s["site"].alias("site"), F.greatest(F.abs(s["r"] - F.col("_r")), F.abs(s["c"] - F.col("_c"))).alias("ring")))
    measured = F.transform(halves, lambda s: F.struct(
        (F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), s["a"] * s["a"] + F.col("_cos") * s["cos"] * s["b"] * s["b"])))).alias("d"),
        s["site"].alias("site"), s["ring"].alias("ring")))
    best = joined.withColumn("_best", F.slice(F.array_sort(measured), 1, k))
    rows = best.select(*points.columns, F.posexplode_outer("_best").alias("_place", "_hit"))
    return rows.select(*points.columns, F.col("_hit.site").alias(site), round_half_up("_hit.d", 3).alias("distance_m"),
                       (F.col("_place") + 1).alias("rank"), F.col("_hit.ring").alias("ring"))
