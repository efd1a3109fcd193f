"""Connected components of a link table by alternating large and small stars.

Every round is written to the shared checkpoint folder; the links themselves
never reach the driver, only a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonescope.llm.common import discard, stored

MAX_ROUNDS = 60


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _lowest(edges: DataFrame) -> DataFrame:
    return stored(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-min")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node with a link to another, the smallest node reachable.  Nulls and self-links are ignored."""
    links = links.where(F.col(a) != F.col(b))
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-links")
    before = _fingerprint(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both)
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = stored(large.distinct(), "cc-large")
        lower = _lowest(large)
        tied = large.join(lower, "u")
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(lower.select("u", F.col("m").alias("v")))
        new = stored(small.distinct(), "cc-links")
        for done in (edges, low, large, lower):
            discard(done)
        edges, after = new, _fingerprint(new)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
