"""Per-zone tourism features from six sources.

``zone_features`` stacks the six staged sources in long form (one union with a
source tag, NULL keys removed first) and aggregates once by zone: one shuffle,
partial aggregation on the map side, so a zone that holds a large share of the
points of interest is combined per task before anything moves.

``zone_features_join_chain`` is the literal shape — six per-source aggregates
chained by full outer joins on the merged key — kept to prove the two forms
equal.  It costs ten shuffles instead of one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonescope.constants import (
    AMENITY_CATEGORIES,
    FLAG_COLUMNS,
    HERITAGE_CATEGORIES,
    NATURE_CATEGORIES,
)

MINUTE_COLUMNS = ("minutes_to_gare", "minutes_to_motorway", "minutes_to_airport", "drive_time_to_metropole")
SEASONAL_COLUMNS = ("seasonal_population_ratio", "peak_population_multiplier")
SUPPLY_COLUMNS = ("accommodation_count", "hotel_count", "camping_count", "guest_house_count", "holiday_village_count")
GEO_COLUMNS = ("code_departement", "nom_departement", "nom_region")
POI_COUNT_COLUMNS = ("tourism_poi_count", "nature_poi_count", "heritage_poi_count", "amenity_poi_count")

# Order in which a source's label wins for ``zone_label``.
LABEL_PRIORITY = ("poi", "labels", "access", "seasonal", "supply", "geo")

FEATURE_COLUMNS = (
    "zone_id",
    "zone_label",
    *GEO_COLUMNS,
    *POI_COUNT_COLUMNS,
    *FLAG_COLUMNS,
    *MINUTE_COLUMNS,
    *SEASONAL_COLUMNS,
    *SUPPLY_COLUMNS,
)


def _keyed(df: DataFrame, tag: str, cols: list[Column]) -> DataFrame:
    return df.where(F.col("code_commune").isNotNull()).select(
        F.col("code_commune").alias("zone_id"), F.lit(tag).alias("_src"), F.col("nom_commune"), *cols
    )


def stacked_sources(staged: dict[str, DataFrame]) -> DataFrame:
    """The six staged sources as one long frame tagged by ``_src``."""
    poi = staged["tourism_poi"]
    parts = [
        _keyed(poi, "poi", [
            F.col("poi_category").isin(*NATURE_CATEGORIES).alias("_nature"),
            F.col("poi_category").isin(*HERITAGE_CATEGORIES).alias("_heritage"),
            F.col("poi_category").isin(*AMENITY_CATEGORIES).alias("_amenity"),
        ]),
        _keyed(staged["tourism_labels"], "labels", [F.col(c) for c in FLAG_COLUMNS]),
        _keyed(staged["mobility_access"], "access", [F.col(c) for c in MINUTE_COLUMNS]),
        _keyed(staged["seasonal_population"], "seasonal", [F.col(c) for c in SEASONAL_COLUMNS]),
        _keyed(staged["tourism_supply_proxy"], "supply", [F.col(c) for c in SUPPLY_COLUMNS]),
        _keyed(staged["geographic_reference"], "geo", [F.col(c) for c in GEO_COLUMNS]),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def zone_features(staged: dict[str, DataFrame]) -> DataFrame:
    """One row per zone known to any of the six sources (27 columns).

    Two steps: per (zone, source and the texts of the row) everything but the
    texts is a number, so the raw rows are combined by hash; the texts' maxima
    are then taken over a zone's few distinct ones.  A maximum of text over raw
    rows would have each task sort them all.
    """
    src = F.col("_src")
    texts = ["nom_commune", *GEO_COLUMNS]
    combined = stacked_sources(staged).groupBy("zone_id", "_src", *texts).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c)).alias(c) for c in ("_nature", "_heritage", "_amenity")],
        *[F.max(c).alias(c) for c in FLAG_COLUMNS],
        *[F.min(c).alias(c) for c in MINUTE_COLUMNS],
        *[f(c).alias(f"_{f.__name__}_{c}") for c in SEASONAL_COLUMNS for f in (F.sum, F.count)],
        *[F.max(c).alias(c) for c in SUPPLY_COLUMNS],
    )
    is_poi = src == "poi"
    label = F.coalesce(*[F.max(F.when(src == tag, F.col("nom_commune"))) for tag in LABEL_PRIORITY])

    def poi(column: str) -> Column:
        return F.sum(F.when(is_poi, F.col(column)).otherwise(0))

    aggregated = combined.groupBy("zone_id").agg(
        label.alias("zone_label"),
        *[F.max(c).alias(c) for c in GEO_COLUMNS],
        poi("_rows").alias("tourism_poi_count"),
        poi("_nature").alias("nature_poi_count"),
        poi("_heritage").alias("heritage_poi_count"),
        poi("_amenity").alias("amenity_poi_count"),
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in FLAG_COLUMNS],
        *[F.min(c).alias(c) for c in MINUTE_COLUMNS],
        *[(F.sum(f"_sum_{c}") / F.nullif(F.sum(f"_count_{c}"), F.lit(0))).alias(c) for c in SEASONAL_COLUMNS],
        *[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in SUPPLY_COLUMNS],
    )
    return aggregated.select(*FEATURE_COLUMNS)


def per_source_aggregates(staged: dict[str, DataFrame]) -> list[tuple[str, DataFrame]]:
    """The six per-zone source aggregates (POI counts, label flags, travel
    minutes, seasonal averages, supply maxima, geography), each keyed by
    ``code_commune`` with its own ``nom_<source>`` label.  Every aggregate is
    partial-aggregated per task, so a zone with many rows is combined before
    the shuffle."""

    def keyed(name):
        return staged[name].where(F.col("code_commune").isNotNull())

    cat = F.col("poi_category")
    poi = keyed("tourism_poi").groupBy("code_commune").agg(
        F.max("nom_commune").alias("nom_poi"),
        F.count(F.lit(1)).alias("tourism_poi_count"),
        F.count_if(cat.isin(*NATURE_CATEGORIES)).alias("nature_poi_count"),
        F.count_if(cat.isin(*HERITAGE_CATEGORIES)).alias("heritage_poi_count"),
        F.count_if(cat.isin(*AMENITY_CATEGORIES)).alias("amenity_poi_count"),
    )
    labels = keyed("tourism_labels").groupBy("code_commune").agg(
        F.max("nom_commune").alias("nom_labels"), *[F.max(c).alias(c) for c in FLAG_COLUMNS]
    )
    access = keyed("mobility_access").groupBy("code_commune").agg(
        F.max("nom_commune").alias("nom_access"), *[F.min(c).alias(c) for c in MINUTE_COLUMNS]
    )
    seasonal = keyed("seasonal_population").groupBy("code_commune").agg(
        F.max("nom_commune").alias("nom_seasonal"), *[F.avg(c).alias(c) for c in SEASONAL_COLUMNS]
    )
    supply = keyed("tourism_supply_proxy").groupBy("code_commune").agg(
        F.max("nom_commune").alias("nom_supply"), *[F.max(c).alias(c) for c in SUPPLY_COLUMNS]
    )
    geo = keyed("geographic_reference").groupBy("code_commune").agg(
        F.max("nom_commune").alias("nom_geo"), *[F.max(c).alias(c) for c in GEO_COLUMNS]
    )
    return [("poi", poi), ("labels", labels), ("access", access), ("seasonal", seasonal),
            ("supply", supply), ("geo", geo)]


def zone_features_join_chain(staged: dict[str, DataFrame]) -> DataFrame:
    """Same result as :func:`zone_features` via five chained full outer joins."""
    parts = per_source_aggregates(staged)
    # Joining by column name merges the key, so a zone seen by any source is one row.
    joined = reduce(lambda a, b: a.join(b, "code_commune", "full"), [df for _, df in parts])
    return joined.select(
        F.col("code_commune").alias("zone_id"),
        F.coalesce(*[F.col(f"nom_{tag}") for tag in LABEL_PRIORITY]).alias("zone_label"),
        *GEO_COLUMNS,
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in POI_COUNT_COLUMNS],
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in FLAG_COLUMNS],
        *MINUTE_COLUMNS,
        *SEASONAL_COLUMNS,
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in SUPPLY_COLUMNS],
    )
