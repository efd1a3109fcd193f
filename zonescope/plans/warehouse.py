"""Registered queries: roll-ups over two hierarchies (X9), location history (X15), quarantine (X11), what-if."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonescope.operators import analytics, dimensions, quarantine, rollup, scenarios, serving
from zonescope.operators.staging import stg_geo
from zonescope.plans import oracle, stays
from zonescope.plans.extensions import breakdown_sql, normed
from zonescope.sources.adapter import SNAPSHOT_DATE

LATER_SNAPSHOTS = ("2024-07-31", "2024-08-31")
LOCATION_ATTRIBUTES = ["nom_commune", "code_departement", "nom_departement", "nom_region"]
SCENARIOS = scenarios.grid(budgets=(60_000, 90_000, 150_000), occupancies=(0.8, 1.0, 1.3), prices=(0.9, 1.0, 1.15), running_rates=(0.25, 0.4))
TOP = 10


def delivered_locations(raw: DataFrame) -> DataFrame:
    """The geographic reference in three deliveries: one renames communes, drops some and twins others, the next brings those back."""
    code = F.col("code_commune")
    second = raw.where(~code.endswith("7")).withColumn("nom_commune", F.when(code.endswith("3"), F.concat(F.col("nom_commune"), F.lit(" Nouvelle"))).otherwise(F.col("nom_commune")))
    second = second.unionByName(second.where(code.endswith("4")).withColumn("nom_region", F.lit("")))
    third = raw.where(~code.endswith("9")).withColumn("nom_region", F.when(code.endswith("5"), F.lit("NOUVELLE REGION")).otherwise(F.col("nom_region")))
    out = raw
    for date, delivery in zip(LATER_SNAPSHOTS, (second, third), strict=True):
        out = out.unionByName(delivery.withColumn("_snapshot_date", F.lit(date)))
    return out


def dim_location(m) -> DataFrame:
    return m._get("dim_location", lambda: m._mart(
        dimensions.history(stg_geo(delivered_locations(m.raw["geographic_reference"])), "code_commune", LOCATION_ATTRIBUTES), "dim_location"))


def sales_locations(m) -> DataFrame:
    """Sales counted by zone and the month they are looked up in (0 to 3 months after the first delivery), with the version valid then."""
    later = F.coalesce(F.pmod(F.day("date_mutation"), F.lit(4)), F.lit(0))
    dated = m.fact.select("zone_id", F.add_months(F.lit(SNAPSHOT_DATE).cast("date"), later).alias("seen_on"))
    counted = dated.groupBy("zone_id", "seen_on").agg(F.count(F.lit(1)).alias("sales"))
    return dimensions.as_of(counted.withColumnRenamed("zone_id", "code_commune"), dim_location(m), "code_commune", "seen_on", ["nom_commune", "nom_region", "version"])


def _separated(m) -> tuple[DataFrame, DataFrame]:
    return m._get("separated_sales", lambda: quarantine.separated(quarantine.judged_sales(m.staged["dvf_mutations"])))


def sales_accepted(m) -> DataFrame:
    return _separated(m)[0].select("transaction_id", "code_commune", "date_mutation", "type_local", "valeur_fonciere",
                                   "corrected_surface_m2", "corrected_price_m2", F.array_join("notes", ",").alias("notes"))


def sales_rejected(m) -> DataFrame:
    return _separated(m)[1].select("transaction_id", "type_local", "valeur_fonciere", F.array_join("reasons", ",").alias("reasons"),
                                   F.array_join("notes", ",").alias("notes"))


def quarantine_report(m) -> DataFrame:
    """Rows per set of reasons; the total is the input's."""
    accepted, rejected = _separated(m)
    reasons = accepted.select(F.lit("").alias("reasons")).unionByName(rejected.select(F.array_join("reasons", ",").alias("reasons")))
    return reasons.groupBy("reasons").agg(F.count(F.lit(1)).alias("row_count"))


def scenario_zones(m) -> DataFrame:
    """Each zone's last month with a known entry cost, with that month's nightly price and occupancy."""
    from zonescope.operators.stays import zone_yields

    occupancy = stays.occupancy(m)
    yields = zone_yields(occupancy, m.zone_month).select("zone_id", "month_key", "entry_cost_eur")
    both = yields.join(occupancy.select("zone_id", "month_key", "adr", "occupancy_rate"), ["zone_id", "month_key"])
    latest = both.where("entry_cost_eur is not null").groupBy("zone_id").agg(F.max(F.struct("month_key", "entry_cost_eur", "adr", "occupancy_rate")).alias("_last"))
    return latest.select("zone_id", "_last.entry_cost_eur", "_last.adr", "_last.occupancy_rate")


def scenario_ranking(m) -> DataFrame:
    return scenarios.scenario_ranking(scenario_zones(m), SCENARIOS, TOP)


REGION, TERRITORY = "EUROPE", "littoral"


def top_zones_territory(m) -> DataFrame:
    """The best seaside zones of one région."""
    return serving.display_table(serving.rank_zones(m.scores, "nature_premium", top_n=20, region=REGION, territory=TERRITORY))


def zone_comparison(m) -> DataFrame:
    """The five best zones by yield, term by term."""
    return analytics.compare_zones(normed(m), serving.rank_zones(m.scores, top_n=5))


# ---------------------------------------------------------------- oracle SQL

def _levels_sql() -> str:
    places = [("admin", "commune", "zone_id", "zone_id IS NOT NULL"), ("admin", "departement", "code_departement", "zone_id IS NOT NULL"),
              ("admin", "region", "nom_region", "zone_id IS NOT NULL"), ("grid", "cell9", "h3_res9", "h3_res9 IS NOT NULL"), ("grid", "cell8", "h3_res8", "h3_res8 IS NOT NULL")]
    parts = []
    for hierarchy, level, key, where in places:
        for unit in ("month", "quarter", "year"):
            period = f"CAST(date_trunc('{unit}', date_mutation) AS DATE)"
            parts.append(f"SELECT '{hierarchy}' AS hierarchy, '{level}' AS place_level, {key} AS place_id, '{unit}' AS time_level, {period} AS period, "
                         "count(*) AS transactions, count(price_m2_bati) AS priced_transactions, avg(price_m2_bati) AS avg_price_m2_bati, "
                         "stddev_samp(price_m2_bati) AS stddev_price_m2_bati, min(price_m2_bati) AS min_price_m2_bati, max(price_m2_bati) AS max_price_m2_bati "
                         f"FROM located WHERE {where} GROUP BY {key}, {period}")
    return ("WITH located AS (SELECT s.code_commune AS zone_id, s.h3_res8, s.h3_res9, s.date_mutation, s.price_m2_bati, g.code_departement, g.nom_region "
            "FROM s_sales s LEFT JOIN features g ON g.zone_id = s.code_commune) " + " UNION ALL ".join(parts))


_DISPLAY_DOUBLES = ["score", "ticket_entree_benchmark", "potentiel_touristique", "nature", "accessibilite", "stabilite", "intensite_saisonniere", "concurrence"]
_LEVEL_DOUBLES = ["avg_price_m2_bati", "stddev_price_m2_bati", "min_price_m2_bati", "max_price_m2_bati"]

_COLUMNS = ", ".join(["nom_commune", "code_departement", "nom_departement", "nom_region"])
_DELIVERIES_SQL = f"""SELECT code_commune, nom_commune, code_departement, nom_departement, nom_region, DATE '{SNAPSHOT_DATE}' AS snap FROM raw_geographic_reference
  UNION ALL SELECT code_commune, CASE WHEN code_commune LIKE '%3' THEN nom_commune || ' Nouvelle' ELSE nom_commune END, code_departement, nom_departement,
    nom_region, DATE '{LATER_SNAPSHOTS[0]}' FROM raw_geographic_reference WHERE code_commune NOT LIKE '%7'
  UNION ALL SELECT code_commune, nom_commune, code_departement, nom_departement, CASE WHEN code_commune LIKE '%5' THEN 'NOUVELLE REGION' ELSE nom_region END,
    DATE '{LATER_SNAPSHOTS[1]}' FROM raw_geographic_reference WHERE code_commune NOT LIKE '%9'"""
_SAME = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in LOCATION_ATTRIBUTES)
LOCATION_SQL = f"""WITH v AS ({_DELIVERIES_SQL}),
  s AS (SELECT snap, lead(snap) OVER (ORDER BY snap) AS next_snap, lag(snap) OVER (ORDER BY snap) AS prev_snap FROM (SELECT DISTINCT snap FROM v)),
  d AS (SELECT v.*, s.next_snap, s.prev_snap FROM v JOIN s USING (snap)),
  starts AS (SELECT a.* FROM d a WHERE NOT EXISTS (SELECT 1 FROM d b WHERE b.code_commune = a.code_commune AND b.snap = a.prev_snap AND {_SAME})),
  ends AS (SELECT a.code_commune, a.snap, a.next_snap FROM d a WHERE NOT EXISTS (SELECT 1 FROM d b WHERE b.code_commune = a.code_commune AND b.snap = a.next_snap AND {_SAME}))
SELECT md5(code_commune || '||' || CAST(x.snap AS VARCHAR)) AS location_key, code_commune, {_COLUMNS},
  CAST(row_number() OVER (PARTITION BY code_commune ORDER BY x.snap) AS INTEGER) AS version, x.snap AS valid_from, valid_to, valid_to IS NULL AS is_current
FROM (SELECT a.*, (SELECT arg_min(e.next_snap, e.snap) FROM ends e WHERE e.code_commune = a.code_commune AND e.snap >= a.snap) AS valid_to FROM starts a) x"""

SEEN_SQL = f"""SELECT f.code_commune, f.seen_on, f.sales, l.nom_commune, l.nom_region, l.version FROM
  (SELECT zone_id AS code_commune, CAST(DATE '{SNAPSHOT_DATE}' + to_months(CAST(COALESCE(day(date_mutation) % 4, 0) AS INTEGER)) AS DATE) AS seen_on, count(*) AS sales
   FROM fact GROUP BY 1, 2) f LEFT JOIN ({LOCATION_SQL}) l ON l.code_commune = f.code_commune AND f.seen_on >= l.valid_from AND (l.valid_to IS NULL OR f.seen_on < l.valid_to)"""

_LIMITS = quarantine.SurfaceLimits()
_RANGE = f"(surface_reelle_bati < {_LIMITS.least_m2} OR surface_reelle_bati > {_LIMITS.most_m2})"
_ROOMS = f"(nombre_pieces_principales > 0 AND surface_reelle_bati / nombre_pieces_principales < {_LIMITS.least_per_room_m2})"
QUARANTINE_SQL = f"""WITH n AS (SELECT *, CASE WHEN NOT (COALESCE({_RANGE}, false) OR COALESCE({_ROOMS}, false)) THEN surface_reelle_bati END AS corrected_surface_m2,
    concat_ws(',', CASE WHEN {_RANGE} THEN 'surface_out_of_range' END, CASE WHEN {_ROOMS} THEN 'surface_below_rooms' END) AS notes FROM s_sales),
  p AS (SELECT *, CASE WHEN corrected_surface_m2 > 0 THEN valeur_fonciere / corrected_surface_m2 END AS corrected_price_m2 FROM n),
  q AS (SELECT type_local, quantile_cont(ln(corrected_price_m2), 0.25) AS q1, quantile_cont(ln(corrected_price_m2), 0.75) AS q3
        FROM p WHERE corrected_price_m2 > 0 GROUP BY type_local)
SELECT p.transaction_id, p.code_commune, p.date_mutation, p.type_local, p.valeur_fonciere, corrected_surface_m2, corrected_price_m2, notes,
  concat_ws(',', CASE WHEN date_mutation IS NULL THEN 'no_date' END, CASE WHEN COALESCE(valeur_fonciere <= 0, true) THEN 'no_value' END,
    CASE WHEN code_commune IS NULL THEN 'no_commune' END,
    CASE WHEN corrected_price_m2 > 0 AND (ln(corrected_price_m2) < q1 - (q3 - q1) * {quarantine.FAR_FENCE}
              OR ln(corrected_price_m2) > q3 + (q3 - q1) * {quarantine.FAR_FENCE}) THEN 'price_outlier' END) AS reasons
FROM p LEFT JOIN q ON q.type_local IS NOT DISTINCT FROM p.type_local"""


def _scenario_sql() -> str:
    rows = ", ".join(f"({i}, " + ", ".join(f"CAST({v!r} AS DOUBLE)" for v in (s.budget_eur, s.occupancy_factor, s.price_factor, s.running_rate, s.target_yield)) + ")"
                     for i, s in enumerate(SCENARIOS))
    return f"""WITH y AS ({stays._yields_sql(stays.st.EntryCost())}), o AS ({stays.OCCUPANCY_SQL}),
  z AS (SELECT y.zone_id, entry_cost_eur, adr, occupancy_rate FROM y JOIN o ON o.zone_id = y.zone_id AND o.month_key = y.month_key
        WHERE entry_cost_eur IS NOT NULL QUALIFY row_number() OVER (PARTITION BY y.zone_id ORDER BY y.month_key DESC) = 1),
  s(scenario, budget_eur, occupancy_factor, price_factor, running_rate, target_yield) AS (VALUES {rows}),
  c AS (SELECT s.*, z.zone_id, entry_cost_eur, CAST(365 AS DOUBLE) * (CASE WHEN occupancy_rate IS NOT NULL THEN least(1.0, occupancy_rate * occupancy_factor) END)
          * (adr * price_factor) AS revenue_eur FROM z CROSS JOIN s),
  f AS (SELECT *, revenue_eur * (CAST(1 AS DOUBLE) - running_rate) AS cash_flow_eur FROM c),
  n AS (SELECT *, CASE WHEN entry_cost_eur > 0 THEN cash_flow_eur / entry_cost_eur END AS net_yield FROM f WHERE entry_cost_eur <= budget_eur)
SELECT CAST(scenario AS INTEGER) AS scenario, budget_eur, occupancy_factor, price_factor, running_rate, zone_id, entry_cost_eur, revenue_eur, cash_flow_eur, net_yield,
  CASE WHEN cash_flow_eur > 0 THEN entry_cost_eur / cash_flow_eur END AS payback_years,
  CAST(row_number() OVER (PARTITION BY scenario ORDER BY net_yield DESC, zone_id) AS INTEGER) AS rank, net_yield >= target_yield AS on_target
FROM n WHERE net_yield IS NOT NULL QUALIFY rank <= {TOP}"""


def _sql(select: str, doubles=()) -> str:
    return oracle.with_ctes(oracle.rounded(select, list(doubles)))


def warehouse_queries(Query) -> list:
    """(name, ids, builder, sql) entries; ``Query`` is the registry's record type."""
    accepted = f"""SELECT transaction_id, code_commune, date_mutation, type_local, valeur_fonciere, corrected_surface_m2, corrected_price_m2, notes
      FROM ({QUARANTINE_SQL}) WHERE reasons = ''"""
    territory = oracle.top_zones_sql("nature_premium", top_n=20).replace(" FROM scores WHERE ", f" FROM scores WHERE nom_region = '{REGION}' AND is_{TERRITORY} = 1 AND ")
    terms = f"SELECT * FROM ({breakdown_sql()}) b WHERE zone_id IN (SELECT zone_id FROM ({oracle.top_zones_sql('rendement', top_n=5)}))"
    rules = " UNION ALL ".join(
        f"SELECT 'zone_month_occupancy' AS model, '{rule}' AS rule, '{column}' AS column_name, count(*) AS row_count, CAST(COALESCE(sum({failing}), 0) AS BIGINT) AS failing, "
        f"COALESCE(sum({failing}), 0) = 0 AS passed FROM o"
        for rule, column, failing in (
            ("rate_in_0_1", "occupancy_rate", "CASE WHEN occupancy_rate < 0 OR occupancy_rate > 1 THEN 1 ELSE 0 END"),
            ("positive", "adr,revenue_eur", "CASE WHEN adr <= 0 OR revenue_eur < 0 THEN 1 ELSE 0 END"),
            ("booked_within_open", "booked_nights", "CASE WHEN booked_nights > open_nights THEN 1 ELSE 0 END"),
            ("unique", "zone_id,month_key", "CASE WHEN n > 1 THEN 1 ELSE 0 END"),
            ("not_null", "month_key", "CASE WHEN month_key IS NULL THEN 1 ELSE 0 END")))
    return [
        Query("top_zones_territory", "X14 région and territory", top_zones_territory, _sql(territory, _DISPLAY_DOUBLES)),
        Query("zone_comparison", "X14 zones side by side", zone_comparison,
              _sql(f"SELECT *, max(contribution) OVER (PARTITION BY profile, term) - contribution AS gap_to_best FROM ({terms}) t",
                   ["weight", "norm", "contribution", "gap_to_best"])),
        Query("occupancy_rules", "X7 rates, uniqueness", lambda m: analytics.occupancy_rules(stays.occupancy(m)),
              _sql(f"SELECT * FROM (WITH o AS (SELECT *, count(*) OVER (PARTITION BY zone_id, month_key) AS n FROM ({stays.OCCUPANCY_SQL})) {rules})")),
        Query("price_levels", "X9 two hierarchies, cells", lambda m: rollup.price_levels(m.staged["dvf_mutations"], m.features), _sql(_levels_sql(), _LEVEL_DOUBLES)),
        Query("dim_location", "X15 location history", dim_location, _sql(f"SELECT * FROM ({LOCATION_SQL})")),
        Query("sales_locations", "X15 version valid on a date", sales_locations, _sql(SEEN_SQL)),
        Query("sales_accepted", "X11 accepted, surfaces corrected", sales_accepted, _sql(accepted, ["valeur_fonciere", "corrected_surface_m2", "corrected_price_m2"])),
        Query("sales_rejected", "X11 quarantine", sales_rejected,
              _sql(f"SELECT transaction_id, type_local, valeur_fonciere, reasons, notes FROM ({QUARANTINE_SQL}) WHERE reasons <> ''", ["valeur_fonciere"])),
        Query("quarantine_report", "X11 accepted + rejected = input", quarantine_report,
              _sql(f"SELECT reasons, count(*) AS row_count FROM ({QUARANTINE_SQL}) GROUP BY reasons")),
        Query("scenario_ranking", "X16 what-if", scenario_ranking,
              _sql(_scenario_sql(), ["entry_cost_eur", "revenue_eur", "cash_flow_eur", "net_yield", "payback_years"])),
    ]
