"""Independent DuckDB SQL for every registered query.

Only the raw-data renderings are shared with the Spark side (see
``zonescope.sources.adapter``); staging, marts and serving are written again
here in plain SQL so the two implementations check each other.  Every
floating-point output is rounded the same way on both sides (to 6 decimals
through decimal(28,10); scores to 2 decimals through decimal(28,6)).
"""

from __future__ import annotations

from zonescope.constants import (
    ACCESS_SCALES,
    AMENITY_CATEGORIES,
    ATTRACTIVENESS_WEIGHTS,
    BENCHMARK_SURFACE_M2,
    DEFAULT_SEASONALITY,
    DISPLAY_COLUMNS,
    FLAG_COLUMNS,
    HERITAGE_CATEGORIES,
    MISSING_MINUTES,
    NATURE_CATEGORIES,
    NATURE_WEIGHTS,
    PROFILES,
    TOP_N_DEFAULT,
    TRUTHY_VALUES,
)
from zonescope.sources.adapter import EXTENSION_RENDERINGS, RENDERINGS


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _d(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def clean_num(col: str) -> str:
    return (
        f"TRY_CAST(NULLIF(REPLACE(REGEXP_REPLACE(COALESCE(CAST({col} AS VARCHAR), ''), "
        f"'[^0-9,.\\-]', '', 'g'), ',', '.'), '') AS DOUBLE)"
    )


def nz(col: str) -> str:
    return f"NULLIF(CAST({col} AS VARCHAR), '')"


def grid(lat: str, lon: str, level: int) -> str:
    rows, cols = float(2 ** (level + 6)), float(2 ** (level + 7))
    row = f"CAST(FLOOR(({lat} + {_d(90.0)}) / {_d(180.0)} * {_d(rows)}) AS BIGINT)"
    col = f"CAST(FLOOR(({lon} + {_d(180.0)}) / {_d(360.0)} * {_d(cols)}) AS BIGINT)"
    return (
        f"CASE WHEN {lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180 "
        f"THEN 'g{level}:' || CAST({row} AS VARCHAR) || ':' || CAST({col} AS VARCHAR) END"
    )


def round_d(expr: str, digits: int = 6) -> str:
    return f"CAST(ROUND(TRY_CAST({expr} AS DECIMAL(28,{digits + 4})), {digits}) AS DOUBLE)"


# --------------------------------------------------------------------------
# Raw datasets (shared renderings).
# --------------------------------------------------------------------------

def _raw_cte(dataset: str) -> str:
    table, renderings = (RENDERINGS | EXTENSION_RENDERINGS)[dataset]
    source = {
        "supplier_geo": "(SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey "
                        "JOIN region ON n_regionkey = r_regionkey)",
    }.get(table, table)
    body = " UNION ALL ".join(f"SELECT {', '.join(exprs)} FROM {source}" for exprs in renderings)
    if dataset in ("dvf_mutations", "tourism_poi"):
        lat, lon = "TRY_CAST(NULLIF(latitude, '') AS DOUBLE)", "TRY_CAST(NULLIF(longitude, '') AS DOUBLE)"
        body = f"SELECT *, {grid(lat, lon, 8)} AS h3_res8, {grid(lat, lon, 9)} AS h3_res9 FROM ({body})"
    return f"raw_{dataset} AS ({body})"


RAW_CTES = [_raw_cte(n) for n in [*RENDERINGS, *EXTENSION_RENDERINGS]]

# --------------------------------------------------------------------------
# Staging.
# --------------------------------------------------------------------------

_DATE = (
    "CASE WHEN regexp_full_match(date_mutation, '\\d{4}-\\d{2}-\\d{2}') "
    "THEN CAST(try_strptime(date_mutation, '%Y-%m-%d') AS DATE) "
    "WHEN regexp_full_match(date_mutation, '\\d{2}/\\d{2}/\\d{4}') "
    "THEN CAST(try_strptime(date_mutation, '%d/%m/%Y') AS DATE) END"
)
_SNAP = "TRY_CAST(NULLIF(_snapshot_date, '') AS DATE) AS snapshot_date, _source_file"


def _int_text(col: str) -> str:
    """An integer written as a float ('3.0') read as the integer's text."""
    return f"regexp_replace({col}, '^([+-]?[0-9]+)[.]0*$', '\\1')"


def _md5(cols) -> str:
    return "md5(concat_ws('||', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in cols) + "))"


STAGING_CTES = [
    f"""s_sales AS (
  SELECT {_md5(['date_mutation', 'valeur_fonciere', 'code_commune', 'nom_commune', 'id_parcelle', '_source_file'])} AS transaction_id,
    {_DATE} AS date_mutation,
    {nz('nature_mutation')} AS nature_mutation,
    {clean_num('valeur_fonciere')} AS valeur_fonciere,
    {nz('code_postal')} AS code_postal, {nz('code_commune')} AS code_commune, {nz('nom_commune')} AS nom_commune,
    {nz('code_departement')} AS code_departement, {nz('type_local')} AS type_local,
    {clean_num('surface_reelle_bati')} AS surface_reelle_bati,
    {clean_num('surface_terrain')} AS surface_terrain,
    CASE WHEN regexp_full_match({_int_text('nombre_pieces_principales')}, '\\s*[+-]?\\d+\\s*')
         THEN TRY_CAST({_int_text('nombre_pieces_principales')} AS INTEGER) END AS nombre_pieces_principales,
    TRY_CAST({nz('longitude')} AS DOUBLE) AS longitude, TRY_CAST({nz('latitude')} AS DOUBLE) AS latitude,
    {nz('h3_res8')} AS h3_res8, {nz('h3_res9')} AS h3_res9, {nz('id_parcelle')} AS id_parcelle,
    {_SNAP},
    CASE WHEN {clean_num('surface_reelle_bati')} > 0
         THEN {clean_num('valeur_fonciere')} / {clean_num('surface_reelle_bati')} END AS price_m2_bati,
    CASE WHEN {clean_num('surface_terrain')} > 0
         THEN {clean_num('valeur_fonciere')} / {clean_num('surface_terrain')} END AS price_m2_terrain
  FROM raw_dvf_mutations)""",
    f"""s_poi AS (
  SELECT {_md5(['code_commune', 'poi_category', 'poi_label', 'latitude', 'longitude', '_source_file'])} AS poi_id,
    {nz('code_commune')} AS code_commune, {nz('nom_commune')} AS nom_commune,
    lower({nz('poi_category')}) AS poi_category, lower({nz('poi_subcategory')}) AS poi_subcategory,
    {nz('poi_label')} AS poi_label,
    TRY_CAST({nz('latitude')} AS DOUBLE) AS latitude, TRY_CAST({nz('longitude')} AS DOUBLE) AS longitude,
    {nz('h3_res8')} AS h3_res8, {nz('h3_res9')} AS h3_res9, {_SNAP}
  FROM raw_tourism_poi)""",
    "s_labels AS (SELECT " + f"{nz('code_commune')} AS code_commune, {nz('nom_commune')} AS nom_commune, "
    + ", ".join(
        f"CASE WHEN lower({_int_text(f'COALESCE(CAST({f} AS VARCHAR), {chr(39)}{chr(39)})')}) "
        f"IN ({_in_list(TRUTHY_VALUES)}) THEN 1 ELSE 0 END AS {f}"
        for f in FLAG_COLUMNS
    )
    + f", {_SNAP} FROM raw_tourism_labels)",
    "s_access AS (SELECT " + f"{nz('code_commune')} AS code_commune, {nz('nom_commune')} AS nom_commune, "
    + ", ".join(f"{clean_num(c)} AS {c}" for c, _ in ACCESS_SCALES)
    + f", {_SNAP} FROM raw_mobility_access)",
    "s_supply AS (SELECT " + f"{nz('code_commune')} AS code_commune, {nz('nom_commune')} AS nom_commune, "
    + ", ".join(f"{clean_num(c)} AS {c}" for c in
                ("accommodation_count", "hotel_count", "camping_count", "guest_house_count", "holiday_village_count"))
    + f", {_SNAP} FROM raw_tourism_supply_proxy)",
    "s_seasonal AS (SELECT " + f"{nz('code_commune')} AS code_commune, {nz('nom_commune')} AS nom_commune, "
    + f"{clean_num('seasonal_population_ratio')} AS seasonal_population_ratio, "
    + f"{clean_num('peak_population_multiplier')} AS peak_population_multiplier, {_SNAP} FROM raw_seasonal_population)",
    "s_geo AS (SELECT " + ", ".join(f"{nz(c)} AS {c}" for c in
                                    ("code_commune", "nom_commune", "code_departement", "nom_departement", "nom_region"))
    + f", {_SNAP} FROM raw_geographic_reference)",
    """fact AS (
  SELECT transaction_id, date_mutation, code_commune AS zone_id, code_commune, nom_commune, code_departement,
    type_local, valeur_fonciere, surface_reelle_bati, surface_terrain, price_m2_bati, price_m2_terrain, id_parcelle
  FROM s_sales)""",
]

# --------------------------------------------------------------------------
# Marts.
# --------------------------------------------------------------------------

_MINUTES = [c for c, _ in ACCESS_SCALES]
_SUPPLY = ["accommodation_count", "hotel_count", "camping_count", "guest_house_count", "holiday_village_count"]

MART_CTES = [
    """zone_month AS (
  SELECT zone_id, CAST(date_trunc('month', date_mutation) AS DATE) AS month_key,
    max(nom_commune) AS commune_label, count(*) AS transaction_count,
    quantile_cont(price_m2_bati, 0.5) AS median_price_m2_bati,
    quantile_cont(price_m2_terrain, 0.5) AS median_price_m2_terrain,
    avg(price_m2_bati) AS avg_price_m2_bati, stddev_samp(price_m2_bati) AS stddev_price_m2_bati
  FROM fact WHERE zone_id IS NOT NULL
  GROUP BY zone_id, CAST(date_trunc('month', date_mutation) AS DATE))""",
    f"""a_poi AS (
  SELECT code_commune, max(nom_commune) AS nom, count(*) AS tourism_poi_count,
    CAST(count_if(poi_category IN ({_in_list(NATURE_CATEGORIES)})) AS BIGINT) AS nature_poi_count,
    CAST(count_if(poi_category IN ({_in_list(HERITAGE_CATEGORIES)})) AS BIGINT) AS heritage_poi_count,
    CAST(count_if(poi_category IN ({_in_list(AMENITY_CATEGORIES)})) AS BIGINT) AS amenity_poi_count
  FROM s_poi WHERE code_commune IS NOT NULL GROUP BY code_commune)""",
    "a_labels AS (SELECT code_commune, max(nom_commune) AS nom, "
    + ", ".join(f"max({f}) AS {f}" for f in FLAG_COLUMNS)
    + " FROM s_labels WHERE code_commune IS NOT NULL GROUP BY code_commune)",
    "a_access AS (SELECT code_commune, max(nom_commune) AS nom, "
    + ", ".join(f"min({c}) AS {c}" for c in _MINUTES)
    + " FROM s_access WHERE code_commune IS NOT NULL GROUP BY code_commune)",
    "a_seasonal AS (SELECT code_commune, max(nom_commune) AS nom, "
    "avg(seasonal_population_ratio) AS seasonal_population_ratio, "
    "avg(peak_population_multiplier) AS peak_population_multiplier "
    "FROM s_seasonal WHERE code_commune IS NOT NULL GROUP BY code_commune)",
    "a_supply AS (SELECT code_commune, max(nom_commune) AS nom, "
    + ", ".join(f"max({c}) AS {c}" for c in _SUPPLY)
    + " FROM s_supply WHERE code_commune IS NOT NULL GROUP BY code_commune)",
    "a_geo AS (SELECT code_commune, max(nom_commune) AS nom, max(code_departement) AS code_departement, "
    "max(nom_departement) AS nom_departement, max(nom_region) AS nom_region "
    "FROM s_geo WHERE code_commune IS NOT NULL GROUP BY code_commune)",
    "zones AS (SELECT code_commune FROM a_poi UNION SELECT code_commune FROM a_labels "
    "UNION SELECT code_commune FROM a_access UNION SELECT code_commune FROM a_seasonal "
    "UNION SELECT code_commune FROM a_supply UNION SELECT code_commune FROM a_geo)",
    "features AS (SELECT z.code_commune AS zone_id, "
    "COALESCE(p.nom, l.nom, a.nom, s.nom, u.nom, g.nom) AS zone_label, "
    "g.code_departement, g.nom_departement, g.nom_region, "
    + ", ".join(f"COALESCE(p.{c}, 0) AS {c}" for c in
                ("tourism_poi_count", "nature_poi_count", "heritage_poi_count", "amenity_poi_count"))
    + ", "
    + ", ".join(f"COALESCE(l.{f}, 0) AS {f}" for f in FLAG_COLUMNS)
    + ", "
    + ", ".join(f"a.{c}" for c in _MINUTES)
    + ", s.seasonal_population_ratio, s.peak_population_multiplier, "
    + ", ".join(f"COALESCE(u.{c}, {_d(0)}) AS {c}" for c in _SUPPLY)
    + " FROM zones z LEFT JOIN a_poi p ON p.code_commune = z.code_commune "
    "LEFT JOIN a_labels l ON l.code_commune = z.code_commune "
    "LEFT JOIN a_access a ON a.code_commune = z.code_commune "
    "LEFT JOIN a_seasonal s ON s.code_commune = z.code_commune "
    "LEFT JOIN a_supply u ON u.code_commune = z.code_commune "
    "LEFT JOIN a_geo g ON g.code_commune = z.code_commune)",
]


def _wsum(terms) -> str:
    return " + ".join(f"{_d(w)} * COALESCE({c}, 0)" for c, w in terms)


def _profile_sql(profile: str) -> str:
    out = ""
    for i, (norm, weight, kind) in enumerate(PROFILES[profile]):
        value = f"COALESCE({norm}, {_d(0)})"
        term = f"{_d(weight)} * ({_d(1)} - {value})" if kind == "inverse" else f"{_d(weight)} * {value}"
        if i == 0:
            out = f"-({term})" if kind == "minus" else term
        else:
            out += f" - {term}" if kind == "minus" else f" + {term}"
    return f"CAST(ROUND(TRY_CAST({_d(100)} * ({out}) AS DECIMAL(28,6)), 2) AS DOUBLE)"


_ACCESS = " + ".join(
    f"{_d(1)} / ({_d(1)} + COALESCE({c}, {_d(MISSING_MINUTES)}) / {_d(s)})" for c, s in ACCESS_SCALES
)
_SEASON = f"COALESCE(peak_population_multiplier, seasonal_population_ratio, {_d(DEFAULT_SEASONALITY)})"
_NORMED = (
    ("attractiveness_raw", "attractiveness_norm"),
    ("nature_raw", "nature_norm"),
    ("access_raw", "access_norm"),
    ("seasonality_intensity", "seasonality_norm"),
    ("stability_filled", "stability_norm"),
    ("benchmark_entry_ticket_est", "cost_norm"),
    ("competition_raw", "competition_norm"),
)

GLOBAL_LATEST = "SELECT * FROM zone_month WHERE month_key = (SELECT max(month_key) FROM zone_month)"
PER_ZONE_LATEST = ("SELECT * FROM zone_month WHERE month_key IS NOT NULL "
                   "QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY month_key DESC) = 1")


def score_ctes(latest: str = GLOBAL_LATEST, sfx: str = "") -> list[str]:
    """The score stage; ``latest`` picks each zone's price month."""
    return [c.replace("{sfx}", sfx).replace("{latest}", latest) for c in _SCORE_TEMPLATES]


_SCORE_TEMPLATES = [

    "latest{sfx} AS ({latest})",
    "merged{sfx} AS (SELECT COALESCE(r.zone_id, f.zone_id) AS zone_id, "
    "COALESCE(f.zone_label, r.commune_label, COALESCE(r.zone_id, f.zone_id)) AS zone_label, "
    "r.month_key AS real_estate_month_key, r.transaction_count, r.median_price_m2_bati, r.median_price_m2_terrain, "
    "f.* EXCLUDE (zone_id, zone_label) FROM latest{sfx} r FULL OUTER JOIN features f ON r.zone_id = f.zone_id)",
    f"""metrics{{sfx}} AS (SELECT *,
    COALESCE(median_price_m2_bati, median_price_m2_terrain, {_d(0)}) * {_d(BENCHMARK_SURFACE_M2)} AS benchmark_entry_ticket_est,
    {_wsum(ATTRACTIVENESS_WEIGHTS)} AS attractiveness_raw,
    {_wsum(NATURE_WEIGHTS)} AS nature_raw,
    {_ACCESS} AS access_raw,
    {_SEASON} AS seasonality_intensity,
    CASE WHEN {_SEASON} > 0 THEN {_d(1)} / {_SEASON} END AS stability_raw,
    COALESCE(CASE WHEN {_SEASON} > 0 THEN {_d(1)} / {_SEASON} END, {_d(0)}) AS stability_filled,
    greatest(COALESCE(accommodation_count, 0),
             COALESCE(hotel_count, 0) + COALESCE(camping_count, 0) + COALESCE(guest_house_count, 0)
             + COALESCE(holiday_village_count, 0)) AS competition_raw
  FROM merged{{sfx}})""",
    "extremes{sfx} AS (SELECT " + ", ".join(f"min({m}) AS lo_{m}, max({m}) AS hi_{m}" for m, _ in _NORMED)
    + " FROM metrics{sfx})",
    "normed{sfx} AS (SELECT m.*, " + ", ".join(
        f"(m.{m} - e.lo_{m}) / NULLIF(e.hi_{m} - e.lo_{m}, 0) AS {n}" for m, n in _NORMED
    ) + " FROM metrics{sfx} m CROSS JOIN extremes{sfx} e)",
    "scores{sfx} AS (SELECT zone_id, zone_label, real_estate_month_key, code_departement, nom_departement, nom_region, "
    "transaction_count, median_price_m2_bati, median_price_m2_terrain, benchmark_entry_ticket_est, "
    "tourism_poi_count, nature_poi_count, heritage_poi_count, amenity_poi_count, "
    + ", ".join(FLAG_COLUMNS) + ", " + ", ".join(_MINUTES)
    + ", seasonality_intensity, competition_raw AS competition_proxy, attractiveness_raw AS tourism_potential_proxy, "
    "nature_raw AS nature_score, access_raw AS access_score, stability_filled AS stability_score, "
    + ", ".join(f"{_profile_sql(p)} AS score_{p}" for p in PROFILES)
    + " FROM normed{sfx} WHERE zone_id IS NOT NULL)",
]

SCORE_CTES = score_ctes() + score_ctes(PER_ZONE_LATEST, "_pz")

ALL_CTES = RAW_CTES + STAGING_CTES + MART_CTES + SCORE_CTES


def with_ctes(select: str) -> str:
    return "WITH " + ",\n".join(ALL_CTES) + "\n" + select


def rounded(select: str, double_cols) -> str:
    """Wrap a query so the listed double columns are rounded like the Spark side."""
    if not double_cols:
        return select
    repl = ", ".join(f"{round_d(c)} AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({repl}) FROM ({select}) AS q"


def top_zones_sql(profile: str, min_transactions: int = 0, min_poi: int = 0, top_n: int = TOP_N_DEFAULT,
                  extra_columns: tuple[str, ...] = ()) -> str:
    score = f"score_{profile}"
    cols = [("zone_id", "zone_id")] + [(score if src == "score" else src, dst) for src, dst in DISPLAY_COLUMNS]
    cols += [(c, c) for c in extra_columns]
    select = ", ".join(f"{src} AS {dst}" for src, dst in cols)
    return (
        f"SELECT {select} FROM scores WHERE COALESCE(transaction_count, 0) >= {min_transactions} "
        f"AND COALESCE(tourism_poi_count, 0) >= {min_poi} "
        f"ORDER BY {score} DESC NULLS LAST, zone_id LIMIT {top_n}"
    )
