"""Serving queries over the score table.

All of them read the score table (one row per zone) and return small frames:
the top-N ranking is ``orderBy().limit()``, planned as a per-task top-k plus
one merge (``TakeOrderedAndProject``), never a full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonescope.constants import (
    DEFAULT_PROFILE,
    DISPLAY_COLUMNS,
    FLAG_COLUMNS,
    PROFILE_LABELS,
    PROFILES,
    TOP_N_DEFAULT,
    TOP_N_MAX,
)

# Columns the serving layer reads from the score table.
SERVING_COLUMNS = (
    "zone_id",
    "zone_label",
    "real_estate_month_key",
    "nom_departement",
    "nom_region",
    "transaction_count",
    "median_price_m2_bati",
    "benchmark_entry_ticket_est",
    "tourism_poi_count",
    "nature_score",
    "access_score",
    "stability_score",
    "seasonality_intensity",
    "competition_proxy",
    "tourism_potential_proxy",
    "score_prudent",
    "score_rendement",
    "score_nature_premium",
    "score_petit_budget",
)


def score_column(profile: str) -> str:
    """Profile key or dashboard label -> score column."""
    labels = dict(PROFILE_LABELS)
    if profile in labels:
        return labels[profile]
    if profile in PROFILES:
        return f"score_{profile}"
    raise ValueError(f"unknown profile {profile!r}; expected one of {sorted(PROFILES)} or {sorted(labels)}")


def serving_view(scores: DataFrame) -> DataFrame:
    """The serving projection, ordered by the yield profile."""
    return scores.select(*SERVING_COLUMNS).orderBy(
        F.col("score_rendement").desc_nulls_last(), F.col("zone_id")
    )


def load_scores(spark: SparkSession, table: str) -> DataFrame | None:
    """Availability guard (S11): None when the table is missing; raise on empty."""
    if not spark.catalog.tableExists(table):
        return None
    df = spark.table(table).select(*SERVING_COLUMNS)
    if df.isEmpty():
        raise LookupError(f"{table} has no scored zone yet")
    return df


def filtered_zones(scores: DataFrame, min_transactions: int = 0, min_poi: int = 0) -> DataFrame:
    """Zones meeting the minimum sales and POI counts, NULL read as 0."""
    return scores.where(
        (F.coalesce(F.col("transaction_count"), F.lit(0)) >= min_transactions)
        & (F.coalesce(F.col("tourism_poi_count"), F.lit(0)) >= min_poi)
    )


def in_territory(zones: DataFrame, region: str | None = None, departement: str | None = None, territory: str | None = None) -> DataFrame:
    """Zones of a région, a département or a type of territory.

    ``territory`` is a label flag with or without its ``is_`` (``littoral``,
    ``mountain``, ...).  The filters are plain column predicates, so they reach
    the scan of a stored score table.
    """
    if region is not None:
        zones = zones.where(F.col("nom_region") == region)
    if departement is not None:
        zones = zones.where(F.col("code_departement") == departement)
    if territory is not None:
        flag = territory if territory in FLAG_COLUMNS else f"is_{territory}"
        if flag not in FLAG_COLUMNS:
            raise ValueError(f"unknown territory {territory!r}; expected one of {[f.removeprefix('is_') for f in FLAG_COLUMNS]}")
        zones = zones.where(F.col(flag) == 1)
    return zones


def rank_zones(
    scores: DataFrame,
    profile: str = DEFAULT_PROFILE,
    min_transactions: int = 0,
    min_poi: int = 0,
    top_n: int = TOP_N_DEFAULT,
    region: str | None = None,
    departement: str | None = None,
    territory: str | None = None,
) -> DataFrame:
    """Top-N zones for a profile, best first; ties broken by zone id (O2), within a territory if one is given."""
    score = score_column(profile)
    if top_n < 1:
        raise ValueError(f"top_n must be 1 or more, not {top_n}")
    return (
        filtered_zones(in_territory(scores, region, departement, territory), min_transactions, min_poi)
        .orderBy(F.col(score).desc_nulls_last(), F.col("zone_id").asc())
        .limit(int(top_n))
        .withColumn("score", F.col(score))
    )


def display_table(ranked: DataFrame) -> DataFrame:
    """The ranking with business column names (P13); zone id kept as the key."""
    return ranked.select("zone_id", *[F.col(src).alias(dst) for src, dst in DISPLAY_COLUMNS])


def kpi_summary(ranked: DataFrame) -> DataFrame:
    """Row count and medians over the visible rows (A13); NULL when all NULL."""
    return ranked.agg(
        F.count(F.lit(1)).alias("visible_zones"),
        F.median("benchmark_entry_ticket_est").alias("median_entry_ticket"),
        F.median("tourism_potential_proxy").alias("median_tourism_potential"),
        F.median("access_score").alias("median_access_score"),
    )


def filter_bounds(scores: DataFrame) -> DataFrame:
    """Slider bounds (A14): max sales / POI counts (NULL as 0), top-N range."""
    n = F.count(F.lit(1))
    return scores.agg(
        F.max(F.coalesce(F.col("transaction_count"), F.lit(0))).alias("max_transactions"),
        F.max(F.coalesce(F.col("tourism_poi_count"), F.lit(0))).alias("max_poi"),
        n.alias("zone_count"),
        F.least(F.lit(TOP_N_MAX).cast("long"), n).alias("top_n_max"),
        F.least(F.lit(TOP_N_DEFAULT).cast("long"), n).alias("top_n_default"),
    )


def chart_points(ranked: DataFrame) -> DataFrame:
    """Data behind the two charts (P15): bar (label, score, potential) and
    scatter (entry ticket, potential, POI count, label, score)."""
    return ranked.select(
        "zone_id",
        "zone_label",
        "score",
        "tourism_potential_proxy",
        "benchmark_entry_ticket_est",
        "tourism_poi_count",
    )
