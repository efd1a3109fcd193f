"""Registered queries: name -> Spark builder, and name -> oracle SQL.

Every builder takes ``(spark, sf_dir)``, renders the raw datasets from the
driver tables at ``sf_dir`` (whole tables), runs the pipeline lazily and
returns a DataFrame.  Double columns are rounded to 6 decimals (half-up through
decimal(28,10)) so the comparison with the oracle is exact.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonescope.constants import PROFILES, TOP_N_DEFAULT
from zonescope.functions.columns import round_half_up
from zonescope.operators import features as feat
from zonescope.operators import quality, scoring, serving
from zonescope.operators.monthly import zone_month_prices
from zonescope.operators.staging import FACT_COLUMNS, sales_fact, stage_all
from zonescope.plans import oracle
from zonescope.plans.materialize import TableStore
from zonescope.session import Scratch, keep_methods_compiled
from zonescope.sources.adapter import raw_dataset, raw_datasets


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column half-up (comparison-stable output)."""
    return df.select(
        *[
            round_half_up(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


class Models:
    """Lazily built staging and mart DataFrames for one input folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize_marts: bool = True):
        keep_methods_compiled(spark)
        self.spark, self.sf_dir = spark, sf_dir
        self.materialize_marts = materialize_marts
        self._cache: dict[str, object] = {}
        self._store: TableStore | None = None

    def _mart(self, df: DataFrame, name: str) -> DataFrame:
        """Marts are written once and read back (see ``plans.materialize``)."""
        if not self.materialize_marts:
            return df
        if self._store is None:
            self._store = TableStore(self.spark)
        return self._store.materialize(df, name)

    def _get(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    @property
    def raw(self) -> dict[str, DataFrame]:
        return self._get("raw", lambda: raw_datasets(self.spark, self.sf_dir))

    def extra(self, dataset: str) -> DataFrame:
        """A raw dataset of the documented extensions."""
        return self._get(dataset, lambda: raw_dataset(self.spark, self.sf_dir, dataset))

    @property
    def staged(self) -> dict[str, DataFrame]:
        return self._get("staged", lambda: stage_all(self.raw))

    @property
    def fact(self) -> DataFrame:
        return self._get("fact", lambda: sales_fact(self.staged["dvf_mutations"]))

    @property
    def zone_month(self) -> DataFrame:
        def build():
            if not self.materialize_marts:
                return zone_month_prices(self.fact)
            scratch = Scratch(self.spark, "zone-months")
            mart = self._mart(zone_month_prices(self.fact, scratch=scratch), "real_estate_zone_monthly")
            scratch.clear()
            return mart

        return self._get("zone_month", build)

    @property
    def features(self) -> DataFrame:
        return self._get("features", lambda: self._mart(feat.zone_features(self.staged), "tourism_zone_features"))

    def build_marts(self) -> None:
        """Build the two independent marts concurrently (separate Spark jobs
        submitted from two driver threads share the executors)."""
        missing = [k for k in ("zone_month", "features") if k not in self._cache]
        if len(missing) == 2 and self.materialize_marts:
            with ThreadPoolExecutor(max_workers=2) as pool:
                for future in [pool.submit(lambda k=k: getattr(self, k)) for k in missing]:
                    future.result()

    @property
    def scores(self) -> DataFrame:
        def build():
            self.build_marts()
            return scoring.zone_scores(self.zone_month, self.features)

        return self._get("scores", build)


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    build: Callable[[Models], DataFrame]
    sql: str | None


def _source_agg(tag: str) -> Callable[[Models], DataFrame]:
    def build(m: Models) -> DataFrame:
        return dict(feat.per_source_aggregates(m.staged))[tag]

    return build


_SALES_DOUBLES = ["valeur_fonciere", "surface_reelle_bati", "surface_terrain", "price_m2_bati", "price_m2_terrain"]
_ZM_DOUBLES = ["median_price_m2_bati", "median_price_m2_terrain", "avg_price_m2_bati", "stddev_price_m2_bati"]
_FEATURE_DOUBLES = [*feat.MINUTE_COLUMNS, *feat.SEASONAL_COLUMNS, *feat.SUPPLY_COLUMNS]
_SCORE_DOUBLES = [
    "median_price_m2_bati", "median_price_m2_terrain", "benchmark_entry_ticket_est", *feat.MINUTE_COLUMNS,
    "seasonality_intensity", "competition_proxy", "tourism_potential_proxy", "nature_score", "access_score",
    "stability_score", *scoring.SCORE_COLUMNS,
]
_METRIC_COLUMNS = ["zone_id", "zone_label", "real_estate_month_key", "benchmark_entry_ticket_est",
                   "attractiveness_raw", "nature_raw", "access_raw", "seasonality_intensity", "stability_raw",
                   "competition_raw"]
_DISPLAY_DOUBLES = ["score", "ticket_entree_benchmark", "potentiel_touristique", "nature", "accessibilite",
                    "stabilite", "intensite_saisonniere", "concurrence"]


def _sql(select: str, doubles=()) -> str:
    return oracle.with_ctes(oracle.rounded(select, list(doubles)))


def _top(profile: str) -> Query:
    return Query(
        f"top_zones_{profile}",
        "P12 P13 P14 O2",
        lambda m: serving.display_table(serving.rank_zones(m.scores, profile)),
        _sql(oracle.top_zones_sql(profile), _DISPLAY_DOUBLES),
    )


def _scores_per_zone_latest(m: Models) -> DataFrame:
    m.build_marts()
    return scoring.zone_scores(m.zone_month, m.features, per_zone_latest=True)


def _not_null_sql() -> str:
    tables = {
        "stg_dvf_transactions": "s_sales", "stg_tourism_poi": "s_poi", "stg_tourism_labels": "s_labels",
        "stg_mobility_access": "s_access", "fact_real_estate_transactions": "fact",
        "tourism_zone_features": "features", "location_tourism_score_latest": "scores",
    }
    parts = [
        f"SELECT '{model}' AS model, 'not_null' AS rule, '{col}' AS column_name, count(*) AS row_count, "
        f"CAST(count_if({col} IS NULL) AS BIGINT) AS failing, CAST(count_if({col} IS NULL) AS BIGINT) = 0 AS passed FROM {tables[model]}"
        for model, col in quality.NOT_NULL_RULES
    ]
    return " UNION ALL ".join(parts)


def _not_null(m: Models) -> DataFrame:
    tables = {
        "stg_dvf_transactions": m.staged["dvf_mutations"],
        "stg_tourism_poi": m.staged["tourism_poi"],
        "stg_tourism_labels": m.staged["tourism_labels"],
        "stg_mobility_access": m.staged["mobility_access"],
        "fact_real_estate_transactions": m.fact,
        "tourism_zone_features": m.features,
        "location_tourism_score_latest": m.scores,
    }
    return quality.not_null_report(tables, {"fact_real_estate_transactions": ("stg_dvf_transactions", FACT_COLUMNS)})


def _ingest_counts(m: Models) -> DataFrame:
    frames = [df.select("_dataset_name", "_source_file") for df in m.raw.values()]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f)
    return stacked.groupBy("_dataset_name", "_source_file").agg(F.count(F.lit(1)).alias("row_count"))


_INGEST_SQL = "SELECT _dataset_name, _source_file, count(*) AS row_count FROM (" + " UNION ALL ".join(
    f"SELECT _dataset_name, _source_file FROM raw_{n}" for n in
    ("dvf_mutations", "tourism_poi", "tourism_labels", "mobility_access", "tourism_supply_proxy",
     "seasonal_population", "geographic_reference", "cadastre_reference")
) + ") GROUP BY _dataset_name, _source_file"


def _bag_union(m: Models) -> DataFrame:
    return m.raw["tourism_labels"].unionByName(m.raw["geographic_reference"], allowMissingColumns=True).select(
        "code_commune", "nom_commune", "nom_departement", "_dataset_name", "_source_file")


_BAG_UNION_SQL = ("SELECT code_commune, nom_commune, CAST(NULL AS VARCHAR) AS nom_departement, _dataset_name, _source_file "
                  "FROM raw_tourism_labels UNION ALL SELECT code_commune, nom_commune, nom_departement, _dataset_name, "
                  "_source_file FROM raw_geographic_reference")


def _grid_cells(m: Models) -> DataFrame:
    sales = m.staged["dvf_mutations"]
    return sales.groupBy("h3_res8", "h3_res9").agg(
        F.count(F.lit(1)).alias("sales"),
        F.count("price_m2_bati").alias("priced_sales"),
        F.max("price_m2_bati").alias("max_price_m2_bati"),
    )


_GRID_SQL = ("SELECT h3_res8, h3_res9, count(*) AS sales, count(price_m2_bati) AS priced_sales, "
             "max(price_m2_bati) AS max_price_m2_bati FROM s_sales GROUP BY h3_res8, h3_res9")


def _source_sql(cte: str, tag: str, cols) -> str:
    return f"SELECT code_commune, nom AS nom_{tag}, {', '.join(cols)} FROM {cte}"


QUERIES: list[Query] = [
    Query("zone_scores", "F21 (flagship: whole score table)", lambda m: m.scores,
          _sql("SELECT * FROM scores", _SCORE_DOUBLES)),
    Query("zone_scores_per_zone_latest", "F21 with each zone's own latest month (option)",
          lambda m: _scores_per_zone_latest(m),
          _sql("SELECT * FROM scores_pz", _SCORE_DOUBLES)),
    Query("zone_month_prices", "A1-A7 P5 F12", lambda m: m.zone_month,
          _sql("SELECT * FROM zone_month", _ZM_DOUBLES)),
    Query("sales_staging", "P3 F1 F2 F4 F5 F8 F9 F10 F11", lambda m: m.staged["dvf_mutations"],
          _sql("SELECT * FROM s_sales", [*_SALES_DOUBLES, "longitude", "latitude"])),
    Query("sales_fact", "P4", lambda m: m.fact, _sql("SELECT * FROM fact", _SALES_DOUBLES)),
    Query("poi_staging", "P3 F6 F7", lambda m: m.staged["tourism_poi"],
          _sql("SELECT * FROM s_poi", ["latitude", "longitude"])),
    Query("labels_staging", "P3 F3", lambda m: m.staged["tourism_labels"], _sql("SELECT * FROM s_labels")),
    Query("access_staging", "P3 F1", lambda m: m.staged["mobility_access"],
          _sql("SELECT * FROM s_access", list(feat.MINUTE_COLUMNS))),
    Query("supply_staging", "P3 F1", lambda m: m.staged["tourism_supply_proxy"],
          _sql("SELECT * FROM s_supply", list(feat.SUPPLY_COLUMNS))),
    Query("seasonal_staging", "P3 F1", lambda m: m.staged["seasonal_population"],
          _sql("SELECT * FROM s_seasonal", list(feat.SEASONAL_COLUMNS))),
    Query("geo_staging", "P3 F4", lambda m: m.staged["geographic_reference"], _sql("SELECT * FROM s_geo")),
    Query("poi_category_counts", "A2 A3 A4 P6 P10", _source_agg("poi"),
          _sql(_source_sql("a_poi", "poi", feat.POI_COUNT_COLUMNS))),
    Query("label_flags", "A8 P6", _source_agg("labels"), _sql(_source_sql("a_labels", "labels", feat.FLAG_COLUMNS))),
    Query("access_minutes", "A9 P6", _source_agg("access"),
          _sql(_source_sql("a_access", "access", feat.MINUTE_COLUMNS), feat.MINUTE_COLUMNS)),
    Query("seasonal_avg", "A10 P6", _source_agg("seasonal"),
          _sql(_source_sql("a_seasonal", "seasonal", feat.SEASONAL_COLUMNS), feat.SEASONAL_COLUMNS)),
    Query("supply_max", "A11 P6", _source_agg("supply"),
          _sql(_source_sql("a_supply", "supply", feat.SUPPLY_COLUMNS), feat.SUPPLY_COLUMNS)),
    Query("geo_labels", "A4 P6", _source_agg("geo"), _sql(_source_sql("a_geo", "geo", feat.GEO_COLUMNS))),
    Query("zone_features", "J1-J5 F13 (long form, one shuffle)", lambda m: m.features,
          _sql("SELECT * FROM features", _FEATURE_DOUBLES)),
    Query("zone_features_join_chain", "J1-J5 (chained full outer joins)",
          lambda m: feat.zone_features_join_chain(m.staged), _sql("SELECT * FROM features", _FEATURE_DOUBLES)),
    Query("latest_month_prices", "P7 A12", lambda m: scoring.latest_month_prices(m.zone_month),
          _sql("SELECT * FROM latest", _ZM_DOUBLES)),
    Query("zone_metrics", "J6 F13-F20",
          lambda m: scoring.zone_metrics(scoring.latest_month_prices(m.zone_month), m.features).select(*_METRIC_COLUMNS),
          _sql(f"SELECT {', '.join(_METRIC_COLUMNS)} FROM metrics", _METRIC_COLUMNS[3:])),
    Query("zone_norms", "W1 F22", lambda m: scoring.zone_norms(m.zone_month, m.features),
          _sql("SELECT zone_id, " + ", ".join(n for _, n in scoring.NORMALISED) + " FROM normed",
               [n for _, n in scoring.NORMALISED])),
    *[_top(p) for p in PROFILES],
    Query("top_zones_filtered", "P12 O2 (minimums above zero, more than fifty zones)",
          lambda m: serving.display_table(serving.rank_zones(m.scores, "rendement", 3, 500, 500)),
          _sql(oracle.top_zones_sql("rendement", 3, 500, 500), _DISPLAY_DOUBLES)),
    Query("bag_union", "U0 (two renderings with different columns, missing ones NULL)", _bag_union, _sql(_BAG_UNION_SQL)),
    Query("kpi_summary", "A13", lambda m: serving.kpi_summary(serving.rank_zones(m.scores)),
          _sql("SELECT count(*) AS visible_zones, median(ticket_entree_benchmark) AS median_entry_ticket, "
               "median(potentiel_touristique) AS median_tourism_potential, "
               "median(accessibilite) AS median_access_score FROM (" + oracle.top_zones_sql("rendement") + ")",
               ["median_entry_ticket", "median_tourism_potential", "median_access_score"])),
    Query("filter_bounds", "A14", lambda m: serving.filter_bounds(m.scores),
          _sql("SELECT max(COALESCE(transaction_count, 0)) AS max_transactions, "
               "max(COALESCE(tourism_poi_count, 0)) AS max_poi, count(*) AS zone_count, "
               f"least(CAST(50 AS BIGINT), count(*)) AS top_n_max, least(CAST({TOP_N_DEFAULT} AS BIGINT), count(*)) "
               "AS top_n_default FROM scores")),
    Query("serving_view", "S10 O1", lambda m: serving.serving_view(m.scores),
          _sql("SELECT " + ", ".join(serving.SERVING_COLUMNS) + " FROM scores",
               [c for c in serving.SERVING_COLUMNS if c in _SCORE_DOUBLES])),
    Query("chart_points", "P15", lambda m: serving.chart_points(serving.rank_zones(m.scores)),
          _sql("SELECT zone_id, commune AS zone_label, score, potentiel_touristique AS tourism_potential_proxy, "
               "ticket_entree_benchmark AS benchmark_entry_ticket_est, tourism_poi_count FROM ("
               + oracle.top_zones_sql("rendement", extra_columns=("tourism_poi_count",)) + ")",
               ["score", "tourism_potential_proxy", "benchmark_entry_ticket_est"])),
    Query("not_null_report", "Q1 Q2", _not_null, _sql(_not_null_sql())),
    Query("ingest_counts", "K5 U0 P2", _ingest_counts, _sql(_INGEST_SQL)),
    Query("grid_cells", "U1 F23", _grid_cells, _sql(_GRID_SQL, ["max_price_m2_bati"])),
]

from zonescope.plans.extensions import extension_queries  # noqa: E402

QUERIES += extension_queries(Query)

from zonescope.plans.spatial import spatial_queries  # noqa: E402

QUERIES += spatial_queries(Query)

from zonescope.plans.stays import stay_queries  # noqa: E402

QUERIES += stay_queries(Query)

from zonescope.plans.warehouse import warehouse_queries  # noqa: E402

QUERIES += warehouse_queries(Query)

QUERY_BY_NAME = {q.name: q for q in QUERIES}


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(q: Query):
        return lambda spark, sf_dir: round_doubles(q.build(Models(spark, sf_dir)))

    return {q.name: runner(q) for q in QUERIES}


def oracle_queries() -> dict[str, str]:
    return {q.name: q.sql for q in QUERIES if q.sql is not None}
