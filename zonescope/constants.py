"""Fixed values that decide the results.

Everything in this module must stay equal to the scoring rules being
reproduced: category groups, the truthy vocabulary, metric weights, access
scales, defaults and the four investor profiles.  They are kept together here,
in their natural order, so no other module carries a literal weight.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Point-of-interest category groups (compared after lower()).
# --------------------------------------------------------------------------
NATURE_CATEGORIES = ("nature", "outdoor", "lake", "littoral", "mountain", "park", "leisure")
HERITAGE_CATEGORIES = ("heritage", "culture", "museum", "village", "monument")
AMENITY_CATEGORIES = ("activity", "wellness", "gastronomy", "restaurant", "market")

# --------------------------------------------------------------------------
# Text accepted as "true" for a label flag (compared lower-cased).
# --------------------------------------------------------------------------
TRUTHY_VALUES = ("1", "true", "t", "yes", "oui")

# --------------------------------------------------------------------------
# The seven label flags, in their natural order.
# --------------------------------------------------------------------------
FLAG_COLUMNS = (
    "is_littoral",
    "is_mountain",
    "is_lake_area",
    "is_natural_park",
    "is_classified_tourism_station",
    "is_classified_village",
    "is_heritage_village",
)

# --------------------------------------------------------------------------
# Tourism attractiveness = weighted sum (term -> weight).
# --------------------------------------------------------------------------
ATTRACTIVENESS_WEIGHTS = (
    ("nature_poi_count", 1.30),
    ("heritage_poi_count", 1.10),
    ("amenity_poi_count", 0.60),
    ("is_littoral", 8.00),
    ("is_mountain", 8.00),
    ("is_lake_area", 6.00),
    ("is_natural_park", 6.00),
    ("is_classified_tourism_station", 5.00),
    ("is_classified_village", 4.00),
    ("is_heritage_village", 3.00),
)

# --------------------------------------------------------------------------
# Nature score = weighted sum (term -> weight).
# --------------------------------------------------------------------------
NATURE_WEIGHTS = (
    ("is_littoral", 3.00),
    ("is_mountain", 3.00),
    ("is_lake_area", 2.00),
    ("is_natural_park", 2.00),
    ("is_classified_village", 1.50),
    ("nature_poi_count", 0.50),
)

# --------------------------------------------------------------------------
# Access score = sum of 1 / (1 + minutes / scale); a missing
# travel time counts as MISSING_MINUTES.
# --------------------------------------------------------------------------
ACCESS_SCALES = (
    ("minutes_to_gare", 30.0),
    ("minutes_to_motorway", 20.0),
    ("minutes_to_airport", 60.0),
    ("drive_time_to_metropole", 90.0),
)
MISSING_MINUTES = 999

# Seasonality when neither peak multiplier nor ratio is known.
DEFAULT_SEASONALITY = 1.0

# Surface (m²) of the benchmark dwelling used for the entry ticket.
BENCHMARK_SURFACE_M2 = 60

# --------------------------------------------------------------------------
# Investor profiles.  Each term is (normalised metric, weight,
# kind); kind "plus" adds weight*norm, "minus" subtracts weight*norm and
# "inverse" adds weight*(1 - norm).  Terms are listed in summation order.
# --------------------------------------------------------------------------
PROFILES = {
    "prudent": (
        ("attractiveness_norm", 0.25, "plus"),
        ("access_norm", 0.20, "plus"),
        ("stability_norm", 0.25, "plus"),
        ("cost_norm", 0.20, "minus"),
        ("competition_norm", 0.10, "minus"),
    ),
    "rendement": (
        ("attractiveness_norm", 0.35, "plus"),
        ("access_norm", 0.20, "plus"),
        ("seasonality_norm", 0.10, "plus"),
        ("cost_norm", 0.20, "minus"),
        ("competition_norm", 0.15, "minus"),
    ),
    "nature_premium": (
        ("nature_norm", 0.35, "plus"),
        ("attractiveness_norm", 0.20, "plus"),
        ("access_norm", 0.15, "plus"),
        ("cost_norm", 0.10, "minus"),
        ("competition_norm", 0.10, "minus"),
    ),
    "petit_budget": (
        ("cost_norm", 0.40, "inverse"),
        ("access_norm", 0.20, "plus"),
        ("attractiveness_norm", 0.20, "plus"),
        ("stability_norm", 0.10, "plus"),
        ("competition_norm", 0.10, "minus"),
    ),
}

# Dashboard profile labels -> score column.
PROFILE_LABELS = (
    ("Prudent", "score_prudent"),
    ("Rendement", "score_rendement"),
    ("Nature premium", "score_nature_premium"),
    ("Petit budget", "score_petit_budget"),
)
DEFAULT_PROFILE = "rendement"

# Serving limits (top-N slider 5..min(50, n), default min(15, n)).
TOP_N_MIN = 5
TOP_N_MAX = 50
TOP_N_DEFAULT = 15

# The serving table's business column names (source -> shown).
DISPLAY_COLUMNS = (
    ("zone_label", "commune"),
    ("nom_departement", "departement"),
    ("nom_region", "region"),
    ("score", "score"),
    ("benchmark_entry_ticket_est", "ticket_entree_benchmark"),
    ("tourism_potential_proxy", "potentiel_touristique"),
    ("nature_score", "nature"),
    ("access_score", "accessibilite"),
    ("stability_score", "stabilite"),
    ("seasonality_intensity", "intensite_saisonniere"),
    ("competition_proxy", "concurrence"),
    ("transaction_count", "transactions_dvf"),
)

# --------------------------------------------------------------------------
# Cell texts a CSV drop uses for "missing" (the default missing
# markers of the common CSV readers); they become NULL at ingestion.
# --------------------------------------------------------------------------
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                  "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Metadata columns appended to every ingested row.
METADATA_COLUMNS = ("_dataset_name", "_source_file", "_snapshot_date", "_ingested_at")
