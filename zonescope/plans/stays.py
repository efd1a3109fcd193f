"""Registered queries on listings, stays and yields (X1-X3) and their SQL, which does explode every night."""

from __future__ import annotations

from zonescope.operators import stays as st
from zonescope.plans import oracle
from zonescope.plans.oracle import nz


def _stays(m):
    return st.stg_stays(m.extra("stays"))


def _listings(m):
    return st.stg_listings(m.extra("listings"))


def occupancy(m):
    """The zone-month occupancy table, written once per run: several analyses read it."""
    return m._get("occupancy", lambda: m._mart(st.zone_month_occupancy(_stays(m), _listings(m)), "zone_month_occupancy"))


# ---------------------------------------------------------------- oracle SQL

def _price(col: str) -> str:
    kept = f"regexp_replace(COALESCE(CAST({col} AS VARCHAR), ''), '[^0-9,.]', '', 'g')"
    return f"TRY_CAST(NULLIF(replace(regexp_replace({kept}, '[,.]([0-9]{{3}})', '\\1', 'g'), ',', '.'), '') AS DOUBLE)"


CALENDAR_SQL = f"""SELECT {nz('listing_id')} AS listing_id, TRY_CAST({nz('date')} AS DATE) AS stay_date,
  CASE WHEN lower(available) = 't' THEN 1 ELSE 0 END AS is_available, COALESCE({_price('adjusted_price')}, {_price('price')}) AS price_eur,
  TRY_CAST({nz('_snapshot_date')} AS DATE) AS snapshot_date FROM raw_calendar"""

_LISTINGS_SQL = f"""(SELECT listing_id, {nz('code_commune')} AS zone_id, CAST(open_from AS DATE) AS open_from, CAST(open_to AS DATE) AS open_to
  FROM raw_listings)"""

CALENDAR_ZONE_SQL = f"""SELECT zone_id, CAST(date_trunc('month', stay_date) AS DATE) AS month_key, count(*) AS nights,
  avg(price_eur) FILTER (WHERE is_available = 0) AS adr_est, 1 - avg(is_available) AS occupancy_calendar_proxy,
  avg(price_eur) * (1 - avg(is_available)) AS revpar_proxy
FROM ({CALENDAR_SQL}) c JOIN {_LISTINGS_SQL} l ON l.listing_id = c.listing_id WHERE zone_id IS NOT NULL
GROUP BY zone_id, CAST(date_trunc('month', stay_date) AS DATE)"""

_NIGHTS_SQL = f"""SELECT listing_id, day, max(open) AS open, sum(booked) AS booked, sum(blocked) AS blocked, sum(priced) AS priced, sum(cents) AS cents FROM (
  SELECT listing_id, CAST(unnest(generate_series(open_from, open_to - 1, INTERVAL 1 DAY)) AS DATE) AS day, 1 AS open, 0 AS booked, 0 AS blocked,
    0 AS priced, 0 AS cents FROM {_LISTINGS_SQL}
  UNION ALL
  SELECT listing_id, CAST(unnest(generate_series(arrival, arrival + nights - 1, INTERVAL 1 DAY)) AS DATE), 0,
    CAST(status = 'booked' AS INTEGER), CAST(status = 'blocked' AS INTEGER), CAST(status = 'booked' AND cents IS NOT NULL AS INTEGER),
    CASE WHEN status = 'booked' THEN COALESCE(cents, 0) ELSE 0 END
  FROM (SELECT listing_id, TRY_CAST({nz('arrival')} AS DATE) AS arrival, CAST(nights AS INTEGER) AS nights, lower(status) AS status,
          CAST(round({_price('price_per_night')} * 100) AS BIGINT) AS cents FROM raw_stays)
  WHERE arrival IS NOT NULL AND nights > 0) GROUP BY listing_id, day"""

OCCUPANCY_SQL = f"""SELECT zone_id, month_key, CAST(count_if(open_nights > 0) AS BIGINT) AS listings, CAST(sum(open_nights) AS BIGINT) AS open_nights,
  CAST(sum(booked_nights) AS BIGINT) AS booked_nights, CAST(sum(overbooked) AS BIGINT) AS overbooked_nights,
  CAST(sum(cents) AS DOUBLE) / 100 AS revenue_eur, CAST(sum(cents) AS DOUBLE) / 100 / NULLIF(sum(priced), 0) AS adr,
  CAST(sum(booked_nights) AS DOUBLE) / sum(open_nights) AS occupancy_rate,
  CAST(sum(cents) AS DOUBLE) / 100 / NULLIF(sum(priced), 0) * (CAST(sum(booked_nights) AS DOUBLE) / sum(open_nights)) AS revpar
FROM (SELECT listing_id, CAST(date_trunc('month', day) AS DATE) AS month_key, count_if(booked > 0 OR (open = 1 AND blocked = 0)) AS open_nights,
        count_if(booked > 0) AS booked_nights, sum(greatest(booked - 1, 0)) AS overbooked, sum(priced) AS priced, sum(cents) AS cents
      FROM ({_NIGHTS_SQL}) GROUP BY listing_id, CAST(date_trunc('month', day) AS DATE)) n
JOIN {_LISTINGS_SQL} l USING (listing_id) WHERE zone_id IS NOT NULL GROUP BY zone_id, month_key HAVING sum(open_nights) > 0"""


def _yields_sql(cost: st.EntryCost) -> str:
    def d(x: float) -> str:
        return f"CAST({x!r} AS DOUBLE)"
    purchase = f"price_m2 * {d(cost.surface_m2)}"
    entry = f"({purchase} * {d(1 + cost.notary_rate + cost.acquisition_rate)} + {d(cost.works_per_m2 * cost.surface_m2 + cost.furniture_eur)})"
    net = f"(gross_year_eur * {d(1 - cost.running_rate)} - {d(cost.fixed_charges_eur)})"
    land = f"(land_price_m2 * {d(cost.land_m2)})"
    return f"""WITH o AS ({OCCUPANCY_SQL}),
  y AS (SELECT a.zone_id, a.month_key, sum(b.revenue_eur / b.listings) AS gross_year_eur FROM o a JOIN o b ON a.zone_id = b.zone_id
        AND b.month_key <= a.month_key AND b.month_key > a.month_key - INTERVAL 12 MONTH GROUP BY a.zone_id, a.month_key),
  b AS (SELECT zone_id, month_key, median_price_m2_bati FROM zone_month WHERE month_key IS NOT NULL AND median_price_m2_bati IS NOT NULL),
  t AS (SELECT zone_id, month_key, median_price_m2_terrain FROM zone_month WHERE month_key IS NOT NULL AND median_price_m2_terrain IS NOT NULL),
  k AS (SELECT y.*, b.month_key AS price_month, b.median_price_m2_bati AS price_m2, t.median_price_m2_terrain AS land_price_m2
        FROM y ASOF LEFT JOIN b ON y.zone_id = b.zone_id AND y.month_key >= b.month_key
        ASOF LEFT JOIN t ON y.zone_id = t.zone_id AND y.month_key >= t.month_key)
SELECT zone_id, month_key, gross_year_eur, {net} AS net_year_eur, price_month, price_m2, land_price_m2, {entry} AS entry_cost_eur,
  CASE WHEN {entry} > 0 THEN gross_year_eur / {entry} END AS gross_yield, CASE WHEN {entry} > 0 THEN {net} / {entry} END AS net_yield,
  CASE WHEN {net} > 0 THEN {entry} / {net} END AS payback_years,
  CASE WHEN {purchase} > 0 THEN gross_year_eur / ({purchase}) END AS revenue_to_price,
  CASE WHEN {land} > 0 THEN gross_year_eur / {land} END AS revenue_to_land FROM k"""


YIELD_DOUBLES = ["gross_year_eur", "net_year_eur", "price_m2", "land_price_m2", "entry_cost_eur", "gross_yield", "net_yield", "payback_years",
                 "revenue_to_price", "revenue_to_land"]
OCCUPANCY_DOUBLES = ["revenue_eur", "adr", "occupancy_rate", "revpar"]


def _sql(select: str, doubles=()) -> str:
    return oracle.with_ctes(oracle.rounded(select, list(doubles)))


def stay_queries(Query) -> list:
    """(name, ids, builder, sql) entries; ``Query`` is the registry's record type."""
    return [
        Query("calendar_staging", "X1", lambda m: st.stg_calendar(m.extra("calendar")), _sql(CALENDAR_SQL, ["price_eur"])),
        Query("calendar_zone_month", "X2 proxies", lambda m: st.calendar_zone_month(st.stg_calendar(m.extra("calendar")), _listings(m)),
              _sql(CALENDAR_ZONE_SQL, ["adr_est", "occupancy_calendar_proxy", "revpar_proxy"])),
        Query("zone_month_occupancy", "X2 occupancy, ADR, RevPAR", occupancy, _sql(OCCUPANCY_SQL, OCCUPANCY_DOUBLES)),
        Query("zone_yields", "X3", lambda m: st.zone_yields(occupancy(m), m.zone_month), _sql(_yields_sql(st.EntryCost()), YIELD_DOUBLES)),
    ]
