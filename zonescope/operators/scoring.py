"""Zone scores: latest month, price/feature merge, metrics, min-max norms and
the four profile scores (P7, A12, J6, F13-F22, W1, P8).

The global min-max normalisation needs seven (min, max) pairs over all zones.
A window ``over ()`` would pull every row into one task.  Here the zone-level
metrics are checkpointed (reliable checkpoint in the shared folder), the
fourteen extremes are one global aggregate over them (partial per task, one
row at the end: a fixed-size result) and enter the plan as literals.  The
latest month is read the same way, so its filter is pushed into the mart scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonescope.constants import (
    ACCESS_SCALES,
    ATTRACTIVENESS_WEIGHTS,
    BENCHMARK_SURFACE_M2,
    DEFAULT_SEASONALITY,
    FLAG_COLUMNS,
    MISSING_MINUTES,
    NATURE_WEIGHTS,
    PROFILES,
)
from zonescope.functions.columns import round_half_up, weighted_sum
from zonescope.operators.features import MINUTE_COLUMNS, POI_COUNT_COLUMNS, SEASONAL_COLUMNS, SUPPLY_COLUMNS
from zonescope.session import ensure_checkpoint_dir

# metric column -> name of its normalised column
NORMALISED = (
    ("attractiveness_raw", "attractiveness_norm"),
    ("nature_raw", "nature_norm"),
    ("access_raw", "access_norm"),
    ("seasonality_intensity", "seasonality_norm"),
    ("stability_filled", "stability_norm"),
    ("benchmark_entry_ticket_est", "cost_norm"),
    ("competition_raw", "competition_norm"),
)

SCORE_COLUMNS = tuple(f"score_{p}" for p in PROFILES)

SCORE_TABLE_COLUMNS = (
    "zone_id",
    "zone_label",
    "real_estate_month_key",
    "code_departement",
    "nom_departement",
    "nom_region",
    "transaction_count",
    "median_price_m2_bati",
    "median_price_m2_terrain",
    "benchmark_entry_ticket_est",
    *POI_COUNT_COLUMNS,
    *FLAG_COLUMNS,
    *MINUTE_COLUMNS,
    "seasonality_intensity",
    "competition_proxy",
    "tourism_potential_proxy",
    "nature_score",
    "access_score",
    "stability_score",
    *SCORE_COLUMNS,
)


def latest_month_prices(zone_month: DataFrame, per_zone: bool = False) -> DataFrame:
    """Zone-month rows of the latest month.

    Default: one global latest month (a scalar subquery over ``month_key``), so
    zones without a sale that month have no price.  ``per_zone=True`` takes
    each zone's own latest month instead.
    """
    if per_zone:
        cols = [c for c in zone_month.columns if c != "zone_id"]
        latest = zone_month.where(F.col("month_key").isNotNull()).groupBy("zone_id").agg(
            F.max_by(F.struct(*cols), "month_key").alias("_row")
        )
        return latest.select("zone_id", *[F.col(f"_row.{c}").alias(c) for c in cols])
    latest_key = zone_month.agg(F.max("month_key")).first()[0]
    return zone_month.where(F.col("month_key") == F.lit(latest_key).cast("date"))


def _attach_prices(latest: DataFrame, features: DataFrame) -> DataFrame:
    """Full outer merge of latest prices and features by zone."""
    joined = latest.join(features, "zone_id", "full")
    return joined.select(
        "zone_id",
        F.coalesce(F.col("zone_label"), F.col("commune_label"), F.col("zone_id")).alias("zone_label"),
        F.col("month_key").alias("real_estate_month_key"),
        "transaction_count",
        "median_price_m2_bati",
        "median_price_m2_terrain",
        "code_departement",
        "nom_departement",
        "nom_region",
        *POI_COUNT_COLUMNS,
        *FLAG_COLUMNS,
        *MINUTE_COLUMNS,
        *SEASONAL_COLUMNS,
        *SUPPLY_COLUMNS,
    )


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def zone_metrics(latest: DataFrame, features: DataFrame) -> DataFrame:
    """Raw metrics per zone."""
    joined = _attach_prices(latest, features)
    seasonality = F.coalesce(
        F.col("peak_population_multiplier"), F.col("seasonal_population_ratio"), F.lit(DEFAULT_SEASONALITY)
    )
    access = None
    for column, scale in ACCESS_SCALES:
        minutes = F.coalesce(F.col(column), F.lit(float(MISSING_MINUTES)))
        term = F.lit(1.0) / (F.lit(1.0) + minutes / F.lit(scale))
        access = term if access is None else access + term
    kinds = _zero("hotel_count") + _zero("camping_count") + _zero("guest_house_count") + _zero(
        "holiday_village_count"
    )
    return joined.select(
        "*",
        (F.coalesce(F.col("median_price_m2_bati"), F.col("median_price_m2_terrain"), F.lit(0.0))
         * F.lit(float(BENCHMARK_SURFACE_M2))).alias("benchmark_entry_ticket_est"),
        weighted_sum((_zero(c), w) for c, w in ATTRACTIVENESS_WEIGHTS).alias("attractiveness_raw"),
        weighted_sum((_zero(c), w) for c, w in NATURE_WEIGHTS).alias("nature_raw"),
        access.alias("access_raw"),
        seasonality.alias("seasonality_intensity"),
        F.when(seasonality > 0, F.lit(1.0) / seasonality).alias("stability_raw"),
        F.greatest(_zero("accommodation_count"), kinds).alias("competition_raw"),
    ).withColumn("stability_filled", F.coalesce(F.col("stability_raw"), F.lit(0.0)))


def with_norms(metrics: DataFrame) -> DataFrame:
    """Min-max normalise the seven metrics over all zones.

    A zero range gives NULL (the term then contributes 0 to every score).
    """
    ensure_checkpoint_dir(metrics.sparkSession)
    metrics = metrics.checkpoint()
    extremes = metrics.agg(
        *[agg(F.col(m)).alias(f"{name}_{m}") for m, _ in NORMALISED for name, agg in (("min", F.min), ("max", F.max))]
    ).first()
    norms = []
    for metric, norm in NORMALISED:
        lo, hi = extremes[f"min_{metric}"], extremes[f"max_{metric}"]
        if lo is None or hi is None or hi - lo == 0:
            norms.append(F.lit(None).cast("double").alias(norm))   # zero range: the term counts 0
        else:
            norms.append(((F.col(metric) - F.lit(float(lo))) / F.lit(float(hi - lo))).alias(norm))
    return metrics.select("*", *norms)


def profile_score(profile: str) -> Column:
    """round(100 * Σ weight·term, 2) with NULL norms as 0."""
    total = None
    for norm, weight, kind in PROFILES[profile]:
        value = F.coalesce(F.col(norm), F.lit(0.0))
        if kind == "inverse":
            term = F.lit(weight) * (F.lit(1.0) - value)
        else:
            term = F.lit(weight) * value
        if total is None:
            total = -term if kind == "minus" else term
        else:
            total = total - term if kind == "minus" else total + term
    return round_half_up(F.lit(100.0) * total, 2)


def zone_scores(zone_month: DataFrame, features: DataFrame, per_zone_latest: bool = False) -> DataFrame:
    """The score table: one row per zone (35 columns)."""
    metrics = zone_metrics(latest_month_prices(zone_month, per_zone_latest), features)
    normed = with_norms(metrics)
    return normed.select(
        *SCORE_TABLE_COLUMNS[:26],
        F.col("competition_raw").alias("competition_proxy"),
        F.col("attractiveness_raw").alias("tourism_potential_proxy"),
        F.col("nature_raw").alias("nature_score"),
        F.col("access_raw").alias("access_score"),
        F.col("stability_filled").alias("stability_score"),
        *[profile_score(p).alias(f"score_{p}") for p in PROFILES],
    ).where(F.col("zone_id").isNotNull())


def zone_norms(zone_month: DataFrame, features: DataFrame) -> DataFrame:
    """zone_id with its seven normalised metrics."""
    metrics = zone_metrics(latest_month_prices(zone_month), features)
    return with_norms(metrics).select("zone_id", *[n for _, n in NORMALISED])
