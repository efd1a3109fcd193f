"""Zone typology (X13): Lloyd's algorithm as a fixed number of aggregates from far-point seeds.

Nothing is random: the first seed is the zone farthest from the mean, each
further one the zone farthest from the seeds so far, ties by zone id.  A step
assigns every zone to its nearest centre by a plain expression and averages the
zones of each centre: one partial aggregate of ``k`` rows.  Standardised values
and centres are rounded to ``DIGITS`` decimals, so that the order in which
sums are formed cannot move a zone to another centre.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonescope.functions.columns import round_half_up
from zonescope.session import Scratch

DIGITS = 9
CLUSTERS = 4
STEPS = 6


def standardised(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, columns) with mean 0 and deviation 1; NULL counts as 0 before, a constant column is 0 after."""
    filled = df.select(key, *[F.coalesce(F.col(c), F.lit(0.0)).cast("double").alias(c) for c in columns])
    stats = filled.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.avg, F.stddev_pop)]).first()

    def score(c: str) -> Column:
        mean, deviation = stats[f"avg_{c}"], stats[f"stddev_pop_{c}"]
        return round_half_up((F.col(c) - F.lit(mean)) / F.lit(deviation), DIGITS) if deviation else F.lit(0.0)

    return filled.select(key, *[score(c).alias(c) for c in columns])


def squared_distance(columns: list[str], centre: list[float]) -> Column:
    parts = [(F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x))) for c, x in zip(columns, centre, strict=True)]
    return round_half_up(reduce(lambda a, b: a + b, parts), DIGITS)


def far_seeds(data: DataFrame, key: str, columns: list[str], k: int) -> list[list[float]]:
    """``k`` seeds, or as many as there are distinct points: each is a top-1 over the data."""
    seeds: list[list[float]] = []
    nearest = squared_distance(columns, [0.0] * len(columns))
    while len(seeds) < k:
        best = data.select(key, *columns, nearest.alias("_d")).orderBy(F.col("_d").desc(), key).limit(1).collect()
        if not best or (seeds and best[0]["_d"] == 0):
            break
        seeds.append([best[0][c] for c in columns])
        nearest = F.least(*[squared_distance(columns, s) for s in seeds]) if len(seeds) > 1 else squared_distance(columns, seeds[0])
    return seeds


def _assigned(data: DataFrame, columns: list[str], centres: list[list[float]]) -> DataFrame:
    """``data`` with ``cluster`` (nearest centre, the first of equals) and ``distance_2``."""
    options = F.array(*[F.struct(squared_distance(columns, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)])
    return data.withColumn("_best", F.array_min(options)).select(*data.columns, F.col("_best.i").alias("cluster"), F.col("_best.d").alias("distance_2"))


def lloyd(df: DataFrame, key: str, columns: list[str], k: int = CLUSTERS, steps: int = STEPS) -> DataFrame:
    """(key, cluster, distance_2): every row's cluster after ``steps`` steps, and its squared distance to the centre.

    Clusters are numbered in the order of their seeds; a cluster that loses
    all its rows keeps its centre.  No rows: no result rows.  Rows without a
    key are clustered like others.
    """
    data = Scratch(df.sparkSession, "clusters").written(standardised(df, key, columns))
    centres = far_seeds(data, key, columns, k)
    if not centres:
        return data.select(key, F.lit(0).alias("cluster"), F.lit(0.0).alias("distance_2"))
    for _ in range(steps):
        means = _assigned(data, columns, centres).groupBy("cluster").agg(*[round_half_up(F.avg(c), DIGITS).alias(c) for c in columns])
        for row in means.collect():  # one row per cluster
            centres[row["cluster"]] = [row[c] for c in columns]
    return _assigned(data, columns, centres).select(key, "cluster", "distance_2")
