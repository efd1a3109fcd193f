"""Dataset specifications.

A ``DatasetSpec`` says where a source's files are, how to read them and which
columns an absent optional source must still expose.  Specs are plain driver
objects; nothing here touches data.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

from zonescope.constants import METADATA_COLUMNS


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    path_glob: str
    format: str = "csv"
    delimiter: str = ","
    table_name: str = ""
    required: bool = False
    expected_columns: tuple[str, ...] = field(default_factory=tuple)
    description: str = ""
    multiline: bool | None = None  # quoted cells spanning lines (such files are not splittable); None: found out per file

    @property
    def table(self) -> str:
        return self.table_name or self.name

    def raw_schema(self) -> T.StructType:
        """All expected columns plus metadata, every one as text."""
        names = [*self.expected_columns, *METADATA_COLUMNS]
        return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# --------------------------------------------------------------------------
# The eight source datasets, their formats, requirement flags
# and expected columns (natural order).
# --------------------------------------------------------------------------
DEFAULT_SPECS: dict[str, DatasetSpec] = {
    spec.name: spec
    for spec in (
        DatasetSpec(
            "dvf_mutations", "dvf/*", "csv", "|", "dvf_mutations", True,
            ("date_mutation", "nature_mutation", "valeur_fonciere", "code_postal", "code_commune",
             "nom_commune", "code_departement", "type_local", "surface_reelle_bati", "surface_terrain",
             "nombre_pieces_principales", "longitude", "latitude", "id_parcelle"),
            "property sales export, pipe-delimited",
        ),
        DatasetSpec(
            "tourism_poi", "tourism/poi/*", "csv", ",", "tourism_poi", True,
            ("code_commune", "nom_commune", "poi_category", "poi_subcategory", "poi_label",
             "latitude", "longitude"),
            "tourism points of interest",
        ),
        DatasetSpec(
            "tourism_labels", "tourism/labels/*", "csv", ",", "tourism_labels", True,
            ("code_commune", "nom_commune", "is_littoral", "is_mountain", "is_lake_area",
             "is_natural_park", "is_classified_tourism_station", "is_classified_village",
             "is_heritage_village"),
            "commune tourism labels",
        ),
        DatasetSpec(
            "mobility_access", "accessibility/*", "csv", ",", "mobility_access", True,
            ("code_commune", "nom_commune", "minutes_to_gare", "minutes_to_motorway",
             "minutes_to_airport", "drive_time_to_metropole"),
            "travel times",
        ),
        DatasetSpec(
            "tourism_supply_proxy", "tourism/supply/*", "csv", ",", "tourism_supply_proxy", False,
            ("code_commune", "nom_commune", "accommodation_count", "hotel_count", "camping_count",
             "guest_house_count", "holiday_village_count"),
            "accommodation supply",
        ),
        DatasetSpec(
            "seasonal_population", "demography/*", "csv", ",", "seasonal_population", False,
            ("code_commune", "nom_commune", "seasonal_population_ratio", "peak_population_multiplier"),
            "seasonal population",
        ),
        DatasetSpec(
            "geographic_reference", "reference/*", "csv", ",", "geographic_reference", False,
            ("code_commune", "nom_commune", "code_departement", "nom_departement", "nom_region"),
            "commune / département / region lookup",
        ),
        DatasetSpec(
            "cadastre_reference", "cadastre/*", "parquet", ",", "cadastre_reference", False,
            ("id_parcelle", "section", "code_commune"),
            "parcel extract (bronze only)",
        ),
    )
}

# Datasets that carry coordinates and therefore grid-cell columns.
GRID_DATASETS = ("dvf_mutations", "tourism_poi")
GRID_COLUMNS = ("h3_res8", "h3_res9")


def load_manifest(path: str | Path) -> dict[str, DatasetSpec]:
    """Read a YAML manifest ``{datasets: {name: {path_glob, format, ...}}}``."""
    import yaml

    with Path(path).open("r", encoding="utf-8") as stream:
        doc = yaml.safe_load(stream) or {}
    specs = {}
    for name, cfg in (doc.get("datasets") or {}).items():
        specs[name] = DatasetSpec(
            name=name,
            path_glob=cfg["path_glob"],
            format=cfg.get("format", "csv"),
            delimiter=cfg.get("delimiter", ","),
            table_name=cfg.get("table_name", name),
            required=bool(cfg.get("required_for_mvp", cfg.get("required", False))),
            expected_columns=tuple(cfg.get("expected_columns", ())),
            description=cfg.get("description", ""),
            multiline=None if cfg.get("multiline") is None else bool(cfg["multiline"]),
        )
    return specs
