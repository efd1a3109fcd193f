"""Render the driver's TPC-H-like tables as the raw text source datasets.

The pipeline consumes commune-level drops (sales, points of interest, labels,
travel times, supply, seasonal population, geography).  The test tables hold
none of those, so this adapter derives each raw dataset from them, row for
row, as *text* exactly like a CSV drop would arrive: decimal commas, units,
empty cells, two date layouts, unreadable values.  Zone = supplier, so the
number of zones grows with the scale factor; sales and points of interest are
one row per ``lineitem`` row, so the heavy inputs grow with it too.

The renderings are plain SQL expressions in the dialect shared by Spark SQL
and DuckDB, so the independent DuckDB oracle (``zonescope.plans.oracle``)
starts from byte-identical raw rows.  Only the adapter is shared: staging,
marts and serving are written separately on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonescope.functions.columns import grid_cell, to_double
from zonescope.sources.specs import DEFAULT_SPECS, GRID_DATASETS
from zonescope.sources.tables import read_table, spread

SNAPSHOT_DATE = "2024-06-30"
INGESTED_AT = "2024-07-01T00:00:00"


def zone_code(key: str) -> str:
    text = f"cast({key} as string)"
    return f"lpad({text}, cast(greatest(5, length({text})) as int), '0')"


def _pick(index_expr: str, values: list[str]) -> str:
    """CASE choosing ``values[index_expr]`` (0-based)."""
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index_expr} {arms} end"


def _coordinate(int_part: str, frac_seed: str) -> str:
    return f"cast({int_part} as string) || '.' || lpad(cast(({frac_seed}) % 1000000 as string), 6, '0')"


def _meta(dataset: str, source_file: str) -> list[str]:
    return [
        f"'{dataset}' as _dataset_name",
        f"{source_file} as _source_file",
        f"'{SNAPSHOT_DATE}' as _snapshot_date",
        f"'{INGESTED_AT}' as _ingested_at",
    ]


# Category vocabulary of the rendered points of interest: mixed case, one
# value outside every group and one empty value.
POI_CATEGORY_VOCAB = ["Nature", "outdoor", "Lake", "heritage", "Museum", "village", "restaurant",
                      "Market", "wellness", "shop", "", "park", "MONUMENT"]
# Spellings of a label flag, truthy and not.
FLAG_VOCAB = ["oui", "TRUE", "1", "non", "", "t", "Yes", "0", "vrai", "OUI", "false"]
FLAG_MULTIPLIERS = [2, 3, 5, 7, 13, 17, 19]

_ISO = "cast(cast(l_shipdate as date) as string)"

SALES_EXPRS = [
    "case when l_linenumber = 7 then 'inconnue'"
    f" when l_linenumber = 6 and l_returnflag = 'R' then replace({_ISO}, '-', '/')"
    f" when l_orderkey % 2 = 0 then {_ISO}"
    f" else substr({_ISO}, 9, 2) || '/' || substr({_ISO}, 6, 2) || '/' || substr({_ISO}, 1, 4) end as date_mutation",
    "case when l_linestatus = 'F' then 'Vente' else '' end as nature_mutation",
    "replace(cast(cast(l_extendedprice as decimal(18,2)) as string), '.', ',') || ' EUR' as valeur_fonciere",
    f"{zone_code('l_suppkey')} as code_postal",
    "case when l_linenumber = 4 and l_returnflag = 'R' then ''"
    f" when l_linenumber = 7 and l_linestatus = 'O' then '97' || {zone_code('l_suppkey')}"
    f" else {zone_code('l_suppkey')} end as code_commune",
    f"case when l_linenumber = 1 then upper('Commune ' || {zone_code('l_suppkey')})"
    f" else 'Commune ' || {zone_code('l_suppkey')} end as nom_commune",
    "lpad(cast(l_suppkey % 95 as string), 2, '0') as code_departement",
    "case l_returnflag when 'A' then 'Maison' when 'N' then 'Appartement' else 'Local industriel' end as type_local",
    "case l_linenumber when 3 then '' when 5 then '0'"
    " else cast(cast(l_quantity as decimal(18,1)) as string) end as surface_reelle_bati",
    "cast(cast(l_discount * 5000 as decimal(18,0)) as string) as surface_terrain",
    "case when l_linenumber = 2 then '2.0' else cast(l_linenumber as string) end as nombre_pieces_principales",
    f"case when l_linenumber = 6 then '' else {_coordinate('l_suppkey % 12 - 4', 'l_orderkey * 6007')} end as longitude",
    f"case when l_linenumber = 6 then '' else "
    f"{_coordinate('41 + l_suppkey % 9', 'l_partkey * 7919 + l_linenumber * 104729')} end as latitude",
    "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id_parcelle",
    *_meta("dvf_mutations", "'dvf/ventes_' || cast(year(l_shipdate) as string) || '.txt'"),
]

POI_EXPRS = [
    "case when l_suppkey % 10 = 9 then '' when l_linenumber = 7 and l_returnflag = 'N' then ''"
    f" else {zone_code('l_suppkey')} end as code_commune",
    f"'Commune ' || {zone_code('l_suppkey')} as nom_commune",
    f"{_pick('l_partkey % 13', POI_CATEGORY_VOCAB)} as poi_category",
    "'Type ' || l_returnflag as poi_subcategory",
    "'POI ' || cast(l_orderkey as string) || '/' || cast(l_linenumber as string) as poi_label",
    "case when l_linenumber = 5 and l_linestatus = 'F' then '' else "
    f"{_coordinate('42 + l_suppkey % 7', 'l_orderkey * 3571 + l_linenumber')} end as latitude",
    "case when l_linenumber = 5 and l_linestatus = 'F' then '' else "
    f"{_coordinate('l_suppkey % 10 - 3', 'l_partkey * 2741')} end as longitude",
    *_meta("tourism_poi", "'tourism/poi/poi_' || lower(l_linestatus) || '.csv'"),
]


def _label_exprs(offset: int, file_name: str) -> list[str]:
    flags = [
        f"{_pick(f'(s_suppkey * {m} + {i + offset}) % {len(FLAG_VOCAB)}', FLAG_VOCAB)} as {name}"
        for i, (m, name) in enumerate(zip(FLAG_MULTIPLIERS, DEFAULT_SPECS["tourism_labels"].expected_columns[2:]))
    ]
    return [
        f"case when s_acctbal < 0 then '' else {zone_code('s_suppkey')} end as code_commune",
        f"'Commune ' || {zone_code('s_suppkey')} || ' L' as nom_commune",
        *flags,
        *_meta("tourism_labels", f"'tourism/labels/{file_name}'"),
    ]


LABELS_A_EXPRS = _label_exprs(0, "labels_a.csv")
LABELS_B_EXPRS = _label_exprs(4, "labels_b.csv")

_MOBILITY_HEAD = [
    f"case when s_nationkey = 7 then '' else {zone_code('s_suppkey')} end as code_commune",
    f"lower('Commune ' || {zone_code('s_suppkey')}) as nom_commune",
]
MOBILITY_A_EXPRS = [
    *_MOBILITY_HEAD,
    "cast(s_suppkey % 60 as string) || ' min' as minutes_to_gare",
    "cast((s_suppkey * 7) % 45 as string) || ',5' as minutes_to_motorway",
    "case when s_suppkey % 11 = 0 then '' else cast(30 + s_suppkey % 90 as string) end as minutes_to_airport",
    "cast(20 + (s_suppkey * 3) % 150 as string) || ' mn' as drive_time_to_metropole",
    *_meta("mobility_access", "'accessibility/access_a.csv'"),
]
MOBILITY_B_EXPRS = [
    *_MOBILITY_HEAD,
    "cast((s_suppkey * 13) % 75 as string) as minutes_to_gare",
    "'' as minutes_to_motorway",
    "cast(45 + (s_suppkey * 5) % 70 as string) || '.25' as minutes_to_airport",
    "case when s_suppkey % 4 = 0 then 'n/a' else cast(10 + s_suppkey % 200 as string) end as drive_time_to_metropole",
    *_meta("mobility_access", "'accessibility/access_b.csv'"),
]

SUPPLY_EXPRS = [
    f"case when s_nationkey = 11 then '' else {zone_code('s_suppkey')} end as code_commune",
    f"'Commune ' || {zone_code('s_suppkey')} || ' P' as nom_commune",
    "cast(s_suppkey % 40 as string) as accommodation_count",
    "case when s_suppkey % 6 = 0 then '' else cast(s_suppkey % 9 as string) end as hotel_count",
    "cast(s_suppkey % 5 as string) as camping_count",
    "cast((s_suppkey * 13) % 17 as string) as guest_house_count",
    "case when s_suppkey % 4 = 0 then 'n/a' else cast(s_suppkey % 3 as string) end as holiday_village_count",
    *_meta("tourism_supply_proxy", "'tourism/supply/supply.csv'"),
]

_SEASONAL_HEAD = [
    f"case when s_nationkey = 3 then '' else {zone_code('s_suppkey')} end as code_commune",
    f"case when s_suppkey % 3 = 0 then '' else 'Commune ' || {zone_code('s_suppkey')} || ' S' end as nom_commune",
]
SEASONAL_A_EXPRS = [
    *_SEASONAL_HEAD,
    "cast(1 + s_suppkey % 4 as string) || ',' || cast(s_suppkey % 10 as string) as seasonal_population_ratio",
    "case s_suppkey % 9 when 0 then '0' when 1 then ''"
    " else cast(1 + s_suppkey % 3 as string) || '.' || cast(s_suppkey % 7 as string) end as peak_population_multiplier",
    *_meta("seasonal_population", "'demography/seasonal_a.csv'"),
]
SEASONAL_B_EXPRS = [
    *_SEASONAL_HEAD,
    "cast(1 + s_suppkey % 3 as string) || ',' || cast((s_suppkey * 7) % 10 as string) || '5' as seasonal_population_ratio",
    "case when s_suppkey % 9 = 0 or s_suppkey % 5 = 0 then ''"
    " else cast(2 + s_suppkey % 2 as string) end as peak_population_multiplier",
    *_meta("seasonal_population", "'demography/seasonal_b.csv'"),
]

GEO_EXPRS = [
    f"{zone_code('s_suppkey + 3')} as code_commune",
    f"'Commune ' || {zone_code('s_suppkey + 3')} || ' G' as nom_commune",
    "lpad(cast(s_nationkey as string), 2, '0') as code_departement",
    "n_name as nom_departement",
    "r_name as nom_region",
    *_meta("geographic_reference", "'reference/communes.csv'"),
]

CADASTRE_EXPRS = [
    "cast(p_partkey as string) || '-1' as id_parcelle",
    "upper(substr(p_type, 1, 2)) as section",
    f"{zone_code('p_size')} as code_commune",
    *_meta("cadastre_reference", "'cadastre/parcels.parquet'"),
]

# --------------------------------------------------------------------------
# Datasets of the documented extensions: zone boundaries, transport hubs,
# listings, their stays and their nightly calendar.
# --------------------------------------------------------------------------

def _degrees(micro: str) -> str:
    """Whole millionths of a degree as decimal text."""
    return f"cast(cast(cast({micro} as decimal(18,0)) * cast(0.000001 as decimal(7,6)) as decimal(18,6)) as string)"


def _euros(cents: str) -> str:
    """Whole cents as decimal text."""
    return f"cast(cast(cast({cents} as decimal(18,0)) * cast(0.01 as decimal(3,2)) as decimal(18,2)) as string)"


# Outlines in thousandths of a degree around a zone's centre, scaled per zone: a concave outer ring, a hole that a
# third of the zones have, a second part that a fifth have.  (part, ring, present if, vertices)
_OUTLINE = [
    (0, 0, "true", [(350, 0), (120, 110), (0, 330), (-140, 120), (-360, 40), (-110, -90), (20, -310), (130, -120)]),
    (0, 1, "s_suppkey % 3 = 0", [(60, 0), (0, 60), (-60, 0), (0, -60)]),
    (1, 0, "s_suppkey % 5 = 0", [(500, 400), (700, 400), (600, 600)]),
]
_CENTRE_X = "(s_suppkey % 10 - 3) * 1000000 + 200000 + (s_suppkey * 7919 % 600) * 1000"
_CENTRE_Y = "(42 + s_suppkey % 7) * 1000000 + 200000 + (s_suppkey * 104729 % 600) * 1000"
_ZONE_SCALE = "(1 + s_suppkey % 3) * 500"

BOUNDARY_RENDERINGS = [
    [
        f"{zone_code('s_suppkey')} as code_commune",
        f"'{part}' as part",
        f"'{ring}' as ring",
        f"'{vertex}' as vertex",
        f"case when {present} then {_degrees(f'{_CENTRE_X} + {dx} * {_ZONE_SCALE}')} else '' end as longitude",
        f"case when {present} then {_degrees(f'{_CENTRE_Y} + {dy} * {_ZONE_SCALE}')} else '' end as latitude",
        *_meta("zone_boundaries", "'reference/contours.csv'"),
    ]
    for part, ring, present, vertices in _OUTLINE
    for vertex, (dx, dy) in enumerate(vertices)
]

HUB_EXPRS = [
    "'H' || cast(s_suppkey as string) as hub_id",
    f"{_pick('s_nationkey % 4', ['Gare', 'Aeroport', 'gare', 'Port'])} as hub_kind",
    f"case when s_suppkey % 17 = 5 then '' else {_degrees('(s_suppkey * 1299709) % 10000000 - 3000000')} end as longitude",
    f"case when s_suppkey % 17 = 5 then '' else {_degrees('42000000 + (s_suppkey * 611953) % 7000000')} end as latitude",
    *_meta("transport_hubs", "'accessibility/hubs.csv'"),
]

LISTING_EXPRS = [
    "cast(p_partkey as string) as listing_id",
    "case when p_partkey % 53 = 7 then '' else "
    f"{zone_code('cast(floor(p_partkey / 20) as bigint)')} end as code_commune",
    "case when p_size % 4 = 0 then 'Appartement' else 'Maison' end as property_type",
    "case when p_partkey % 7 = 0 then '1998-03-15' else '1996-01-01' end as open_from",
    "case when p_partkey % 11 = 0 then '2000-02-10' else '2002-01-01' end as open_to",
    *_meta("listings", "'listings/listings.csv'"),
]

STAY_EXPRS = [
    "cast(l_partkey as string) as listing_id",
    f"case when l_linenumber = 7 and l_returnflag = 'R' then 'bientot' else {_ISO} end as arrival",
    "case when l_linenumber = 6 then '0' else cast(cast(l_quantity as int) as string) end as nights",
    "case when l_linenumber = 5 and l_returnflag = 'A' then '' else "
    f"'$' || {_euros('cast(floor(l_extendedprice) as bigint) % 12000 + 4000')} end as price_per_night",
    "case l_returnflag when 'N' then 'booked' when 'A' then 'Booked' else 'blocked' end as status",
    *_meta("stays", "'listings/stays.csv'"),
]

CALENDAR_EXPRS = [
    "cast(l_partkey as string) as listing_id",
    f"case when l_linenumber = 7 and l_returnflag = 'R' then 'bientot' else {_ISO} end as date",
    "case when l_returnflag = 'R' then 't' when l_linenumber = 6 then '' else 'f' end as available",
    "case when l_linenumber = 3 then '$1,' || lpad(cast(l_partkey % 1000 as string), 3, '0') || '.50'"
    f" else '$' || {_euros('cast(floor(l_extendedprice) as bigint) % 12000 + 4000')} end as price",
    f"case when l_linenumber % 2 = 0 then '' else replace({_euros('cast(floor(l_extendedprice) as bigint) % 9000 + 3500')}, '.', ',')"
    " || ' EUR' end as adjusted_price",
    *_meta("calendar", "'listings/calendar.csv'"),
]

EXTENSION_RENDERINGS: dict[str, tuple[str, list[list[str]]]] = {
    "zone_boundaries": ("supplier", BOUNDARY_RENDERINGS),
    "transport_hubs": ("supplier", [HUB_EXPRS]),
    "listings": ("part", [LISTING_EXPRS]),
    "stays": ("lineitem", [STAY_EXPRS]),
    "calendar": ("lineitem", [CALENDAR_EXPRS]),
}

# dataset -> (driver table(s), list of renderings (one per "file"))
RENDERINGS: dict[str, tuple[str, list[list[str]]]] = {
    "dvf_mutations": ("lineitem", [SALES_EXPRS]),
    "tourism_poi": ("lineitem", [POI_EXPRS]),
    "tourism_labels": ("supplier", [LABELS_A_EXPRS, LABELS_B_EXPRS]),
    "mobility_access": ("supplier", [MOBILITY_A_EXPRS, MOBILITY_B_EXPRS]),
    "tourism_supply_proxy": ("supplier", [SUPPLY_EXPRS]),
    "seasonal_population": ("supplier", [SEASONAL_A_EXPRS, SEASONAL_B_EXPRS]),
    "geographic_reference": ("supplier_geo", [GEO_EXPRS]),
    "cadastre_reference": ("part", [CADASTRE_EXPRS]),
}

# Sources whose row count is that of the fact table (the rest are dimension-sized).
FACT_SOURCES = ("lineitem",)

# Driver columns each rendering reads (keeps the Parquet scans pruned).
SOURCE_COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"],
    "supplier": ["s_suppkey", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_type", "p_size"],
}


def _source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "supplier_geo":
        supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
        nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
        region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
        return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
            region, nation.n_regionkey == region.r_regionkey
        )
    df = read_table(spark, sf_dir, name, SOURCE_COLUMNS[name])
    # Only the fact-sized source is worth spreading; dimension scans stay as they are.
    return spread(df, spark) if name in FACT_SOURCES else df


def raw_dataset(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """One raw dataset as bronze would hold it: text columns + metadata (+ grid cells)."""
    table, renderings = (RENDERINGS | EXTENSION_RENDERINGS)[dataset]
    source = _source(spark, sf_dir, table)
    frames = [source.selectExpr(*exprs) for exprs in renderings]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    if dataset in GRID_DATASETS:
        parsed = out.withColumns({"_lat": to_double("latitude"), "_lon": to_double("longitude")})  # once for both levels
        out = parsed.withColumns({f"h3_res{level}": grid_cell("_lat", "_lon", level) for level in (8, 9)}).drop("_lat", "_lon")
    return out


def raw_datasets(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    names = names or list(RENDERINGS)
    return {n: raw_dataset(spark, sf_dir, n) for n in names}

