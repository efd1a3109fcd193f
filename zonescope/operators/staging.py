"""Typed staging projections (P3) and the sales fact.

Each function maps one raw (all-text) dataset to its typed contract.  They are
lazy projections: Catalyst inlines them into whatever reads them, prunes the
columns nobody uses and pushes filters down to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonescope.constants import FLAG_COLUMNS
from zonescope.functions.columns import (
    clean_numeric,
    empty_to_null,
    fingerprint,
    parse_date,
    price_per_m2,
    to_date,
    to_double,
    to_int,
    truthy_flag,
)


def _tail() -> list:
    return [to_date("_snapshot_date").alias("snapshot_date"), F.col("_source_file")]


def stg_sales(raw: DataFrame) -> DataFrame:
    """Property sales (21 columns).  The numbers are parsed in a step of their own: the prices use them several times."""
    parsed = raw.withColumns({
        "_value": clean_numeric("valeur_fonciere"),
        "_built": clean_numeric("surface_reelle_bati"),
        "_land": clean_numeric("surface_terrain"),
    })
    value, built, land = F.col("_value"), F.col("_built"), F.col("_land")
    return parsed.select(
        fingerprint("date_mutation", "valeur_fonciere", "code_commune", "nom_commune", "id_parcelle",
                    "_source_file").alias("transaction_id"),
        parse_date("date_mutation").alias("date_mutation"),
        empty_to_null("nature_mutation").alias("nature_mutation"),
        value.alias("valeur_fonciere"),
        empty_to_null("code_postal").alias("code_postal"),
        empty_to_null("code_commune").alias("code_commune"),
        empty_to_null("nom_commune").alias("nom_commune"),
        empty_to_null("code_departement").alias("code_departement"),
        empty_to_null("type_local").alias("type_local"),
        built.alias("surface_reelle_bati"),
        land.alias("surface_terrain"),
        to_int("nombre_pieces_principales").alias("nombre_pieces_principales"),
        to_double("longitude").alias("longitude"),
        to_double("latitude").alias("latitude"),
        empty_to_null("h3_res8").alias("h3_res8"),
        empty_to_null("h3_res9").alias("h3_res9"),
        empty_to_null("id_parcelle").alias("id_parcelle"),
        *_tail(),
        price_per_m2(value, built).alias("price_m2_bati"),
        price_per_m2(value, land).alias("price_m2_terrain"),
    )


def stg_poi(raw: DataFrame) -> DataFrame:
    """Points of interest (12 columns)."""
    return raw.select(
        fingerprint("code_commune", "poi_category", "poi_label", "latitude", "longitude",
                    "_source_file").alias("poi_id"),
        empty_to_null("code_commune").alias("code_commune"),
        empty_to_null("nom_commune").alias("nom_commune"),
        F.lower(empty_to_null("poi_category")).alias("poi_category"),
        F.lower(empty_to_null("poi_subcategory")).alias("poi_subcategory"),
        empty_to_null("poi_label").alias("poi_label"),
        to_double("latitude").alias("latitude"),
        to_double("longitude").alias("longitude"),
        empty_to_null("h3_res8").alias("h3_res8"),
        empty_to_null("h3_res9").alias("h3_res9"),
        *_tail(),
    )


def stg_labels(raw: DataFrame) -> DataFrame:
    """Tourism labels as 0/1 integer flags (11 columns)."""
    return raw.select(
        empty_to_null("code_commune").alias("code_commune"),
        empty_to_null("nom_commune").alias("nom_commune"),
        *[truthy_flag(c).alias(c) for c in FLAG_COLUMNS],
        *_tail(),
    )


def stg_mobility(raw: DataFrame) -> DataFrame:
    """Travel times in minutes (8 columns)."""
    return raw.select(
        empty_to_null("code_commune").alias("code_commune"),
        empty_to_null("nom_commune").alias("nom_commune"),
        *[clean_numeric(c).alias(c) for c in
          ("minutes_to_gare", "minutes_to_motorway", "minutes_to_airport", "drive_time_to_metropole")],
        *_tail(),
    )


def stg_supply(raw: DataFrame) -> DataFrame:
    """Accommodation supply counts (9 columns)."""
    return raw.select(
        empty_to_null("code_commune").alias("code_commune"),
        empty_to_null("nom_commune").alias("nom_commune"),
        *[clean_numeric(c).alias(c) for c in
          ("accommodation_count", "hotel_count", "camping_count", "guest_house_count", "holiday_village_count")],
        *_tail(),
    )


def stg_seasonal(raw: DataFrame) -> DataFrame:
    """Seasonal population ratios (6 columns)."""
    return raw.select(
        empty_to_null("code_commune").alias("code_commune"),
        empty_to_null("nom_commune").alias("nom_commune"),
        clean_numeric("seasonal_population_ratio").alias("seasonal_population_ratio"),
        clean_numeric("peak_population_multiplier").alias("peak_population_multiplier"),
        *_tail(),
    )


def stg_geo(raw: DataFrame) -> DataFrame:
    """Commune / département / region lookup (7 columns)."""
    return raw.select(
        *[empty_to_null(c).alias(c) for c in
          ("code_commune", "nom_commune", "code_departement", "nom_departement", "nom_region")],
        *_tail(),
    )


STAGING = {
    "dvf_mutations": stg_sales,
    "tourism_poi": stg_poi,
    "tourism_labels": stg_labels,
    "mobility_access": stg_mobility,
    "tourism_supply_proxy": stg_supply,
    "seasonal_population": stg_seasonal,
    "geographic_reference": stg_geo,
}


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: fn(raw[name]) for name, fn in STAGING.items() if name in raw}


# Column of the sales fact -> staging column.
FACT_COLUMNS = {
    "transaction_id": "transaction_id",
    "date_mutation": "date_mutation",
    "zone_id": "code_commune",
    "code_commune": "code_commune",
    "nom_commune": "nom_commune",
    "code_departement": "code_departement",
    "type_local": "type_local",
    "valeur_fonciere": "valeur_fonciere",
    "surface_reelle_bati": "surface_reelle_bati",
    "surface_terrain": "surface_terrain",
    "price_m2_bati": "price_m2_bati",
    "price_m2_terrain": "price_m2_terrain",
    "id_parcelle": "id_parcelle",
}


def sales_fact(sales: DataFrame) -> DataFrame:
    """Sales fact (13 columns): the staging row keyed by ``zone_id``."""
    return sales.select(*[F.col(source).alias(name) for name, source in FACT_COLUMNS.items()])
