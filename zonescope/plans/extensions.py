"""Registered queries for the documented extensions (X4-X15) and the stream (ST1)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonescope.constants import PROFILES
from zonescope.operators import analytics as an
from zonescope.operators import clusters, scoring
from zonescope.operators.staging import stg_sales
from zonescope.plans import oracle
from zonescope.plans.oracle import clean_num
from zonescope.session import scratch_path
from zonescope.sources.adapter import RENDERINGS
from zonescope.sources.specs import DEFAULT_SPECS

REDELIVERY_SNAPSHOT = "2024-07-31"
#: Rows of a file of a delivery: files are compressed, so each is read by one task.
ROWS_PER_DELIVERED_FILE = 500_000
#: Raw columns that the deduplicated sales are chosen by or made of.
DEDUP_READS = ("date_mutation", "valeur_fonciere", "code_commune", "nom_commune", "id_parcelle", "_source_file", "_snapshot_date", "_ingested_at")


def normed(m) -> DataFrame:
    """Metrics with their norms, one row per zone; written once per run because
    several analyses (11 sensitivity scenarios, the breakdown) read it."""
    def build():
        m.build_marts()
        metrics = scoring.zone_metrics(scoring.latest_month_prices(m.zone_month), m.features)
        return m._mart(scoring.with_norms(metrics), "zone_norms")

    return m._get("normed", build)


def redelivered_sales(raw_sales: DataFrame) -> DataFrame:
    """The sales drop plus a later snapshot re-delivering the completed sales
    with corrected values (a tenfold value, as a typo fix would look)."""
    again = raw_sales.where(F.col("nature_mutation") == "Vente").withColumn(
        "valeur_fonciere", F.replace(F.col("valeur_fonciere"), F.lit(" EUR"), F.lit("0 EUR"))
    ).withColumn("_snapshot_date", F.lit(REDELIVERY_SNAPSHOT))
    return raw_sales.unionByName(again)


def latest_snapshot_dedup(m) -> DataFrame:
    """The columns that neither the result nor the choice reads stay out of the shuffle: the kept row travels as one value."""
    raw = m.raw["dvf_mutations"]
    read = [c for c in raw.columns if c in DEDUP_READS]
    kept = an.latest_snapshot_rows(redelivered_sales(raw).select(*read))
    kept = kept.withColumns({c: F.lit(None).cast("string") for c in raw.columns if c not in read})
    return stg_sales(kept).select("id_parcelle", "code_commune", "snapshot_date", "valeur_fonciere", "transaction_id")


def incremental_zone_month(m) -> DataFrame:
    """ST1 end to end: the sales rendering is dropped as compressed CSV files in two deliveries, each written at the
    scan's own width and ingested by the streaming job, so the second reopens months published by the first; the
    monthly mart it maintains is returned."""
    from zonescope.streaming.incremental import read_monthly_mart, start_sales_stream

    spec = DEFAULT_SPECS["dvf_mutations"]
    run = scratch_path(m.spark, f"stream-run-{uuid.uuid4().hex[:12]}")
    external = f"{run}/external"
    drop = f"{external}/{os.path.dirname(spec.path_glob)}"
    rows = m.raw["dvf_mutations"].select(*spec.expected_columns)
    for delivery in range(2):
        half = rows.where(F.pmod(F.xxhash64(*spec.expected_columns), F.lit(2)) == delivery)
        (half.write.mode("append").option("header", True).option("sep", spec.delimiter).option("escape", '"')
         .option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_DELIVERED_FILE).csv(drop))
        start_sales_stream(m.spark, external, f"{run}/lake", "2024-06-30",
                           checkpoint=f"{run}/checkpoint").awaitTermination()
    return read_monthly_mart(m.spark, f"{run}/lake")


# ---------------------------------------------------------------- oracle SQL

_ROLLUP_SQL = """SELECT code_departement, zone_id, year, quarter, month_key,
  CAST(GROUPING(code_departement, zone_id, year, quarter, month_key) AS INTEGER) AS level,
  count(*) AS transactions, count(price_m2_bati) AS priced_transactions, avg(price_m2_bati) AS avg_price_m2_bati,
  min(price_m2_bati) AS min_price_m2_bati, max(price_m2_bati) AS max_price_m2_bati
FROM (SELECT g.code_departement, f.zone_id, CAST(year(f.date_mutation) AS INTEGER) AS year,
        CAST(quarter(f.date_mutation) AS INTEGER) AS quarter,
        CAST(date_trunc('month', f.date_mutation) AS DATE) AS month_key, f.price_m2_bati
      FROM fact f LEFT JOIN features g ON g.zone_id = f.zone_id WHERE f.zone_id IS NOT NULL) b
GROUP BY ROLLUP (code_departement, zone_id, year, quarter, month_key)"""


def _w(n: int) -> str:
    return f"OVER (PARTITION BY zone_id ORDER BY mi RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_TREND_SQL = f"""SELECT zone_id, month_key, transaction_count, median_price_m2_bati,
  CAST(sum(transaction_count) {_w(3)} AS BIGINT) AS sales_3m,
  CAST(sum(transaction_count) {_w(6)} AS BIGINT) AS sales_6m,
  CAST(sum(transaction_count) {_w(12)} AS BIGINT) AS sales_12m,
  avg(median_price_m2_bati) {_w(3)} AS median_avg_3m,
  avg(median_price_m2_bati) {_w(12)} AS median_avg_12m,
  stddev_samp(median_price_m2_bati) {_w(12)} / NULLIF(avg(median_price_m2_bati) {_w(12)}, 0) AS median_cv_12m,
  lag(month_key) OVER (PARTITION BY zone_id ORDER BY mi) AS previous_month_key,
  CAST(mi - lag(mi) OVER (PARTITION BY zone_id ORDER BY mi) AS INTEGER) AS months_since_previous_sale,
  median_price_m2_bati - lag(median_price_m2_bati) OVER (PARTITION BY zone_id ORDER BY mi) AS median_change
FROM (SELECT *, year(month_key) * 12 + month(month_key) - 1 AS mi FROM zone_month WHERE month_key IS NOT NULL) m"""

_LONG_METRICS = " UNION ALL ".join(
    f"SELECT zone_id, '{name}' AS metric, CAST({col} AS DOUBLE) AS value FROM scores" for name, col in an.SCORE_METRICS
)

_ROBUST_SQL = f"""SELECT l.zone_id, l.metric, l.value, q.q_low, q.q_high,
  CASE WHEN l.value IS NOT NULL AND q.q_high <> q.q_low
       THEN least(1.0, greatest(0.0, (l.value - q.q_low) / (q.q_high - q.q_low))) END AS robust_norm
FROM ({_LONG_METRICS}) l
LEFT JOIN (SELECT metric, quantile_cont(value, 0.05) AS q_low, quantile_cont(value, 0.95) AS q_high
           FROM ({_LONG_METRICS}) GROUP BY metric) q ON q.metric = l.metric"""

_PRANK_SQL = """SELECT zone_id, nom_region, score_rendement,
  percent_rank() OVER (PARTITION BY nom_region ORDER BY score_rendement) AS percent_rank FROM scores"""


def breakdown_sql() -> str:
    parts = []
    for profile, terms in PROFILES.items():
        for norm, weight, kind in terms:
            k = f"CAST({100.0 * weight!r} AS DOUBLE)"
            v = f"COALESCE({norm}, CAST(0 AS DOUBLE))"
            contrib = {"inverse": f"{k} * (CAST(1 AS DOUBLE) - {v})", "minus": f"-({k} * {v})"}.get(kind, f"{k} * {v}")
            parts.append(f"SELECT zone_id, '{profile}' AS profile, '{norm}' AS term, '{kind}' AS kind, "
                         f"CAST({weight!r} AS DOUBLE) AS weight, {norm} AS norm, {contrib} AS contribution FROM normed")
    return " UNION ALL ".join(parts)


def _sensitivity_sql(profile: str = "rendement", delta: float = 0.2, k: int = 10) -> str:
    scenarios = an.sensitivity_scenarios(profile, delta)
    rows = ", ".join(
        "('" + name + "', " + ", ".join(f"CAST({w!r} AS DOUBLE)" for _, w, _ in terms) + ")" for name, terms in scenarios
    )
    base = scenarios[0][1]
    total = ""
    for i, (norm, _, kind) in enumerate(base):
        v = f"COALESCE(n.{norm}, CAST(0 AS DOUBLE))"
        term = f"s.w{i} * (CAST(1 AS DOUBLE) - {v})" if kind == "inverse" else f"s.w{i} * {v}"
        total = (f"-({term})" if kind == "minus" else term) if i == 0 else (
            total + (f" - {term}" if kind == "minus" else f" + {term}"))
    cols = ", ".join(f"w{i}" for i in range(len(base)))
    return f"""WITH s AS (SELECT * FROM (VALUES {rows}) AS t(scenario, {cols})),
  sc AS (SELECT s.scenario, n.zone_id,
           CAST(ROUND(TRY_CAST(CAST(100 AS DOUBLE) * ({total}) AS DECIMAL(28,6)), 2) AS DOUBLE) AS score
         FROM normed n CROSS JOIN s),
  r AS (SELECT scenario, CAST(row_number() OVER (PARTITION BY scenario ORDER BY score DESC NULLS LAST, zone_id)
               AS INTEGER) AS rank, zone_id, score FROM sc QUALIFY rank <= {k})
SELECT r.scenario, r.rank, r.zone_id, r.score, b.zone_id IS NOT NULL AS in_baseline_top
FROM r LEFT JOIN (SELECT zone_id FROM r WHERE scenario = 'baseline') b ON b.zone_id = r.zone_id"""


_BBOX = an.FRANCE_BBOX
_QUALITY_SQL = f"""
SELECT 'fact_real_estate_transactions' AS model, 'unique' AS rule, 'transaction_id' AS column_name,
  CAST(sum(c) AS BIGINT) AS row_count, CAST(COALESCE(sum(CASE WHEN c > 1 THEN c END), 0) AS BIGINT) AS failing
FROM (SELECT transaction_id, count(*) AS c FROM fact GROUP BY transaction_id)
UNION ALL SELECT 'fact_real_estate_transactions', 'positive', 'valeur_fonciere', count(*),
  CAST(count_if(valeur_fonciere <= 0) AS BIGINT) FROM fact
UNION ALL SELECT 'fact_real_estate_transactions', 'non_negative', 'surface_reelle_bati', count(*),
  CAST(count_if(surface_reelle_bati < 0) AS BIGINT) FROM fact
UNION ALL SELECT 'fact_real_estate_transactions', 'within_p01_p99', 'price_m2_bati', count(*),
  CAST(count_if(price_m2_bati < (SELECT quantile_cont(price_m2_bati, 0.01) FROM fact)
        OR price_m2_bati > (SELECT quantile_cont(price_m2_bati, 0.99) FROM fact)) AS BIGINT)
  FROM fact WHERE price_m2_bati IS NOT NULL
UNION ALL SELECT 'stg_dvf_transactions', 'in_france_bbox', 'latitude,longitude', count(*),
  CAST(count_if(latitude IS NOT NULL AND longitude IS NOT NULL AND (latitude < {_BBOX['lat_min']}
    OR latitude > {_BBOX['lat_max']} OR longitude < {_BBOX['lon_min']} OR longitude > {_BBOX['lon_max']})) AS BIGINT) FROM s_sales
UNION ALL SELECT 'fact_real_estate_transactions', 'zone_in_features', 'zone_id', count(*), CAST(count_if(g.zone_id IS NULL) AS BIGINT)
  FROM fact f LEFT JOIN features g ON g.zone_id = f.zone_id WHERE f.zone_id IS NOT NULL
UNION ALL SELECT 'stg_seasonal_population', 'non_negative', 'seasonal_population_ratio', count(*),
  CAST(count_if(seasonal_population_ratio < 0) AS BIGINT) FROM s_seasonal
UNION ALL SELECT 'stg_dvf_transactions', 'fresh_within_365_days', 'date_mutation', count(*),
  CAST(CASE WHEN date_diff('day', max(date_mutation), max(snapshot_date)) > 365 THEN 1 ELSE 0 END AS BIGINT)
  FROM s_sales"""

_RAW_NAMES = tuple(RENDERINGS)


def _monitoring_sql() -> str:
    parts = []
    for name in _RAW_NAMES:
        for col in DEFAULT_SPECS[name].expected_columns:
            empty = f"CAST(count_if({col} IS NULL OR {col} = '') AS BIGINT)"
            parts.append(
                f"SELECT '{name}' AS dataset, count(*) AS row_count, max(_snapshot_date) AS last_snapshot, "
                f"max(_ingested_at) AS last_ingested_at, '{col}' AS column_name, {empty} AS empty_count, "
                f"CAST({empty} AS DOUBLE) / NULLIF(count(*), 0) AS empty_rate FROM raw_{name}")
    return " UNION ALL ".join(parts)


def _match_sql() -> str:
    codes = "(SELECT DISTINCT code_commune FROM raw_geographic_reference WHERE code_commune <> '')"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS row_count, count(c.code_commune) AS matched, "
        f"CAST(count(c.code_commune) AS DOUBLE) / NULLIF(count(*), 0) AS match_rate "
        f"FROM raw_{name} r LEFT JOIN {codes} c ON c.code_commune = r.code_commune"
        for name in _RAW_NAMES if name != "geographic_reference"
    )


_DEDUP_SQL = f"""SELECT id_parcelle, NULLIF(code_commune, '') AS code_commune, TRY_CAST(NULLIF(_snapshot_date, '') AS DATE) AS snapshot_date,
  {clean_num('valeur_fonciere')} AS valeur_fonciere,
  md5(concat_ws('||', COALESCE(date_mutation, ''), COALESCE(valeur_fonciere, ''), COALESCE(code_commune, ''),
      COALESCE(nom_commune, ''), COALESCE(id_parcelle, ''), COALESCE(_source_file, ''))) AS transaction_id
FROM (SELECT * FROM (
        SELECT * FROM raw_dvf_mutations
        UNION ALL
        SELECT * REPLACE (replace(valeur_fonciere, ' EUR', '0 EUR') AS valeur_fonciere,
                          '{REDELIVERY_SNAPSHOT}' AS _snapshot_date)
        FROM raw_dvf_mutations WHERE nature_mutation = 'Vente') b
      QUALIFY row_number() OVER (PARTITION BY id_parcelle, date_mutation, code_commune
                                 ORDER BY _snapshot_date DESC, _ingested_at DESC, valeur_fonciere DESC) = 1) k"""

_ANOMALY_SQL = f"""WITH priced AS (SELECT transaction_id, zone_id, price_m2_bati FROM fact
                   WHERE zone_id IS NOT NULL AND price_m2_bati IS NOT NULL),
  med AS (SELECT zone_id, quantile_cont(price_m2_bati, 0.5) AS zone_median FROM priced GROUP BY zone_id),
  dev AS (SELECT p.*, m.zone_median, abs(p.price_m2_bati - m.zone_median) AS d FROM priced p JOIN med m
          ON m.zone_id = p.zone_id),
  mad AS (SELECT zone_id, quantile_cont(d, 0.5) AS zone_mad FROM dev GROUP BY zone_id),
  z AS (SELECT dev.transaction_id, dev.zone_id, dev.price_m2_bati, dev.zone_median, mad.zone_mad,
          CAST({an.MAD_SCALE!r} AS DOUBLE) * (dev.price_m2_bati - dev.zone_median) / NULLIF(mad.zone_mad, 0)
          AS robust_z FROM dev JOIN mad ON mad.zone_id = dev.zone_id)
SELECT * FROM z WHERE abs(robust_z) > {an.ANOMALY_THRESHOLD!r}"""

_DENSITY_SQL = """SELECT COALESCE(p.h3_res8, s.h3_res8) AS h3_res8, COALESCE(p.poi_count, 0) AS poi_count,
  COALESCE(s.sales_count, 0) AS sales_count, s.avg_price_m2_bati
FROM (SELECT h3_res8, count(*) AS poi_count FROM s_poi WHERE h3_res8 IS NOT NULL GROUP BY h3_res8) p
FULL OUTER JOIN (SELECT h3_res8, count(*) AS sales_count, avg(price_m2_bati) AS avg_price_m2_bati FROM s_sales
                 WHERE h3_res8 IS NOT NULL GROUP BY h3_res8) s ON s.h3_res8 = p.h3_res8"""

_MONTHS_SQL = """SELECT CAST(m AS DATE) AS month_key, CAST(year(m) AS INTEGER) AS year,
  CAST(quarter(m) AS INTEGER) AS quarter, CAST(month(m) AS INTEGER) AS month
FROM (SELECT unnest(generate_series(CAST(min(month_key) AS TIMESTAMP), CAST(max(month_key) AS TIMESTAMP),
      INTERVAL 1 MONTH)) AS m FROM zone_month)"""

def _lloyd_sql(source: str, key: str, columns: list[str], rounded, k: int = clusters.CLUSTERS, steps: int = clusters.STEPS) -> str:
    """The Lloyd steps of ``operators.clusters`` unrolled as SQL over the relation ``source`` (``rounded(expr, digits)`` renders the rounding)."""
    def distance(a: str, b: str) -> str:
        return rounded(" + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in columns), clusters.DIGITS)

    names = ", ".join(columns)
    filled = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), CAST(0 AS DOUBLE)) AS {c}" for c in columns)
    scored = ", ".join(f"COALESCE({rounded(f'({c} - avg({c}) OVER ()) / NULLIF(stddev_pop({c}) OVER (), 0)', clusters.DIGITS)}, CAST(0 AS DOUBLE)) AS {c}" for c in columns)
    zero = ", ".join(f"CAST(0 AS DOUBLE) AS {c}" for c in columns)
    ctes = [f"pt AS MATERIALIZED (SELECT {key}, {scored} FROM (SELECT {key}, {filled} FROM {source}))",
            f"origin AS (SELECT {zero})",
            f"seed0 AS MATERIALIZED (SELECT 0 AS i, {names} FROM (SELECT pt.*, {distance('pt', 'origin')} AS d FROM pt CROSS JOIN origin ORDER BY d DESC, {key} LIMIT 1))"]
    for i in range(1, k):
        ctes.append(f"seed{i} AS MATERIALIZED (SELECT * FROM seed{i - 1} UNION ALL SELECT {i}, {names} FROM (SELECT pt.{key}, "
                    + ", ".join(f"pt.{c}" for c in columns)
                    + f", min({distance('pt', 's')}) AS d FROM pt CROSS JOIN seed{i - 1} s GROUP BY ALL HAVING d > 0 ORDER BY d DESC, pt.{key} LIMIT 1))")
    previous = f"seed{k - 1}"
    for step in range(steps + 1):
        ctes.append(f"near{step} AS MATERIALIZED (SELECT pt.*, s.i, {distance('pt', 's')} AS d FROM pt CROSS JOIN {previous} s "
                    f"QUALIFY row_number() OVER (PARTITION BY pt.{key} ORDER BY d, s.i) = 1)")
        means = ", ".join(f"COALESCE({rounded(f'n.{c}', clusters.DIGITS)}, s.{c}) AS {c}" for c in columns)
        averages = ", ".join(f"avg({c}) AS {c}" for c in columns)
        ctes.append(f"centre{step} AS MATERIALIZED (SELECT s.i, {means} FROM {previous} s LEFT JOIN (SELECT i, {averages} FROM near{step} GROUP BY i) n ON n.i = s.i)")
        previous = f"centre{step}"
    return f"WITH {', '.join(ctes)} SELECT {key}, CAST(i AS INTEGER) AS cluster, d AS distance_2 FROM near{steps}"


_CLUSTERED = [column for _, column in an.SCORE_METRICS]

_ZM_DOUBLES = ["median_price_m2_bati", "median_price_m2_terrain", "avg_price_m2_bati", "stddev_price_m2_bati"]


def _sql(select: str, doubles=()) -> str:
    return oracle.with_ctes(oracle.rounded(select, list(doubles)))


def extension_queries(Query) -> list:
    """(name, ids, builder, sql) entries; ``Query`` is the registry's record type."""
    return [
        Query("price_rollup", "X9", lambda m: an.price_rollup(m.fact, m.features),
              _sql(_ROLLUP_SQL, ["avg_price_m2_bati", "min_price_m2_bati", "max_price_m2_bati"])),
        Query("price_trend", "X10", lambda m: an.price_trend(m.zone_month),
              _sql(_TREND_SQL, ["median_price_m2_bati", "median_avg_3m", "median_avg_12m", "median_cv_12m",
                                "median_change"])),
        Query("robust_norms", "X5", lambda m: an.robust_norms(m.scores),
              _sql(_ROBUST_SQL, ["value", "q_low", "q_high", "robust_norm"])),
        Query("segment_percent_rank", "X5", lambda m: an.segment_percent_rank(m.scores),
              _sql(_PRANK_SQL, ["score_rendement", "percent_rank"])),
        Query("score_breakdown", "X14", lambda m: an.score_breakdown(normed(m)),
              _sql(breakdown_sql(), ["weight", "norm", "contribution"])),
        Query("weight_sensitivity", "X6", lambda m: an.weight_sensitivity(normed(m)),
              _sql(_sensitivity_sql(), ["score"])),
        Query("quality_rules", "X7",
              lambda m: an.quality_rules(m.staged["dvf_mutations"], m.fact, m.features,
                                         m.staged["seasonal_population"]),
              _sql("SELECT *, failing = 0 AS passed FROM (" + _QUALITY_SQL + ")")),
        Query("load_monitoring", "X8",
              lambda m: an.load_monitoring(m.raw, {n: DEFAULT_SPECS[n].expected_columns for n in m.raw}),
              _sql(_monitoring_sql(), ["empty_rate"])),
        Query("geo_match_rate", "X8", lambda m: an.geo_match_rate(m.raw), _sql(_match_sql(), ["match_rate"])),
        Query("latest_snapshot_dedup", "X11", latest_snapshot_dedup, _sql(_DEDUP_SQL, ["valeur_fonciere"])),
        Query("price_anomalies", "X12", lambda m: an.price_anomalies(m.fact),
              _sql(_ANOMALY_SQL, ["price_m2_bati", "zone_median", "zone_mad", "robust_z"])),
        Query("grid_density", "X4", lambda m: an.grid_density(m.staged["dvf_mutations"], m.staged["tourism_poi"]),
              _sql(_DENSITY_SQL, ["avg_price_m2_bati"])),
        Query("month_dimension", "X15", lambda m: an.month_dimension(m.zone_month), _sql(_MONTHS_SQL)),
        Query("zone_clusters", "X13 (Lloyd steps from far-point seeds)", lambda m: clusters.lloyd(m.scores, "zone_id", _CLUSTERED),
              _sql("SELECT * FROM (" + _lloyd_sql("scores", "zone_id", _CLUSTERED, oracle.round_d) + ")", ["distance_2"])),
        Query("incremental_zone_month", "ST1 (Structured Streaming)", incremental_zone_month,
              _sql("SELECT * FROM zone_month", _ZM_DOUBLES)),
    ]

