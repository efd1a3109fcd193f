"""Analyses described in the reference's design documents.

X4 grid density, X5 robust normalisation and segment percent ranks, X6 weight
sensitivity, X7 quality rules, X8 load monitoring, X9 multi-level roll-up,
X10 trends, X11 latest-snapshot dedup, X12 robust z-score anomalies, X14 score
breakdown, X15 month dimension.

Scale notes are given per function; every group-wise statistic that could
meet a very large group (quantiles, medians, percent ranks) goes through the
range-partitioned rank operators of :mod:`zonescope.operators.quantiles`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonescope.constants import PROFILES
from zonescope.functions.columns import month_start, round_half_up
from zonescope.operators.quantiles import exact_median, exact_quantiles, percent_rank
from zonescope.operators.serving import in_territory
from zonescope.session import ensure_checkpoint_dir

# Metric columns of the score table (name used in reports -> column).
SCORE_METRICS = (
    ("attractiveness", "tourism_potential_proxy"),
    ("nature", "nature_score"),
    ("access", "access_score"),
    ("seasonality", "seasonality_intensity"),
    ("stability", "stability_score"),
    ("cost", "benchmark_entry_ticket_est"),
    ("competition", "competition_proxy"),
)

# Bounding box of metropolitan France (degrees), used by the coordinate rule.
FRANCE_BBOX = {"lat_min": 41.0, "lat_max": 51.5, "lon_min": -5.5, "lon_max": 10.0}

# Modified z-score (Iglewicz & Hoaglin): 0.6745 * (x - median) / MAD, outlier above 3.5.
MAD_SCALE = 0.6745
ANOMALY_THRESHOLD = 3.5


def _stack(df: DataFrame, id_cols: list[str], pairs) -> DataFrame:
    """Wide -> long: (id..., metric, value) for each (name, column)."""
    items = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(c).cast("double").alias("value"))
                      for name, c in pairs])
    return df.select(*id_cols, F.inline(items))


# --------------------------------------------------------------------------
# X9 multi-level roll-up
# --------------------------------------------------------------------------

def price_rollup(fact: DataFrame, features: DataFrame) -> DataFrame:
    """Sales statistics rolled up département > zone > year > quarter > month.

    ``level`` is the grouping id (bit set = level rolled up).  The raw sales
    are aggregated once, to (zone, month); that table meets the département
    (one row per zone) and only its rows are expanded to the levels.
    """
    geo = features.select("zone_id", "code_departement")
    monthly = fact.where(F.col("zone_id").isNotNull()).groupBy("zone_id", month_start("date_mutation").alias("month_key")).agg(
        F.count(F.lit(1)).alias("_rows"), F.count("price_m2_bati").alias("_priced"), F.sum("price_m2_bati").alias("_total"),
        F.min("price_m2_bati").alias("_low"), F.max("price_m2_bati").alias("_high"))
    base = monthly.join(geo, "zone_id", "left").select(
        "code_departement", "zone_id", F.year("month_key").alias("year"), F.quarter("month_key").alias("quarter"), "month_key",
        "_rows", "_priced", "_total", "_low", "_high")
    return base.rollup("code_departement", "zone_id", "year", "quarter", "month_key").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("_rows").alias("transactions"),
        F.sum("_priced").alias("priced_transactions"),
        (F.sum("_total") / F.nullif(F.sum("_priced"), F.lit(0))).alias("avg_price_m2_bati"),
        F.min("_low").alias("min_price_m2_bati"),
        F.max("_high").alias("max_price_m2_bati"),
    )


# --------------------------------------------------------------------------
# X10 trends
# --------------------------------------------------------------------------

def price_trend(zone_month: DataFrame) -> DataFrame:
    """Per zone and dated month: rolling 3/6/12-month sales and median level,
    12-month coefficient of variation, gap since the previous month with sales.

    The window is per zone over its months, so a window partition holds one
    zone's months (bounded by the time span), not its sales.
    """
    m = zone_month.where(F.col("month_key").isNotNull()).select(
        "zone_id", "month_key", "transaction_count", "median_price_m2_bati",
        (F.year("month_key") * 12 + F.month("month_key") - 1).alias("_mi"),
    )
    by_month = Window.partitionBy("zone_id").orderBy("_mi")

    def last(n):
        return by_month.rangeBetween(-(n - 1), 0)

    median = F.col("median_price_m2_bati")
    return m.select(
        "zone_id",
        "month_key",
        "transaction_count",
        "median_price_m2_bati",
        F.sum("transaction_count").over(last(3)).alias("sales_3m"),
        F.sum("transaction_count").over(last(6)).alias("sales_6m"),
        F.sum("transaction_count").over(last(12)).alias("sales_12m"),
        F.avg(median).over(last(3)).alias("median_avg_3m"),
        F.avg(median).over(last(12)).alias("median_avg_12m"),
        (F.stddev_samp(median).over(last(12)) / F.nullif(F.avg(median).over(last(12)), F.lit(0.0)))
        .alias("median_cv_12m"),
        F.lag("month_key").over(by_month).alias("previous_month_key"),
        (F.col("_mi") - F.lag("_mi").over(by_month)).alias("months_since_previous_sale"),
        (median - F.lag(median).over(by_month)).alias("median_change"),
    )


# --------------------------------------------------------------------------
# X5 robust normalisation, segment percent ranks
# --------------------------------------------------------------------------

def robust_norms(scores: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Long form (zone, metric): min-max on the [low, high] quantiles, clipped
    to [0, 1]; NULL when the two quantiles are equal.

    The quantiles are exact and computed over all zones without gathering
    them (range-partitioned ranks); the quantile table has one row per metric
    (seven, a fixed bound) and is broadcast.
    """
    long = _stack(scores, ["zone_id"], SCORE_METRICS)
    q = exact_quantiles(long, ["metric"], "value", {"q_low": low, "q_high": high})
    joined = long.join(F.broadcast(q), "metric", "left")
    span = F.col("q_high") - F.col("q_low")
    raw = (F.col("value") - F.col("q_low")) / F.nullif(span, F.lit(0.0))
    return joined.select(
        "zone_id", "metric", "value", "q_low", "q_high",
        F.when(F.col("value").isNotNull() & (span != 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)))
        .alias("robust_norm"),
    )


def segment_percent_rank(scores: DataFrame, profile: str = "rendement", segment: str = "nom_region") -> DataFrame:
    """Percent rank of a profile score within a segment (region by default)."""
    score = f"score_{profile}"
    base = scores.select("zone_id", segment, score)
    return percent_rank(base, [segment], score, "percent_rank")


# --------------------------------------------------------------------------
# X14 score breakdown
# --------------------------------------------------------------------------

def score_breakdown(normed: DataFrame, region: str | None = None, departement: str | None = None) -> DataFrame:
    """Each profile score split into its weighted terms (zone, profile, term).

    ``contribution`` is the term's signed share of the score in points;
    per zone and profile they add up to the score before rounding.
    """
    normed = in_territory(normed, region, departement)
    items = []
    for profile, terms in PROFILES.items():
        for norm, weight, kind in terms:
            value = F.coalesce(F.col(norm), F.lit(0.0))
            if kind == "inverse":
                contribution = F.lit(100.0 * weight) * (F.lit(1.0) - value)
            elif kind == "minus":
                contribution = -(F.lit(100.0 * weight) * value)
            else:
                contribution = F.lit(100.0 * weight) * value
            items.append(F.struct(
                F.lit(profile).alias("profile"), F.lit(norm).alias("term"), F.lit(kind).alias("kind"),
                F.lit(weight).alias("weight"), F.col(norm).alias("norm"), contribution.alias("contribution"),
            ))
    return normed.select("zone_id", F.inline(F.array(*items)))


def compare_zones(normed: DataFrame, zones: DataFrame) -> DataFrame:
    """The score terms of a few zones side by side: each term's contribution and its gap to the best of them.

    ``zones`` (a ``zone_id`` column) is what a user picked; the terms of a zone
    are bounded, so a (profile, term) window holds one row per picked zone.
    """
    picked = normed.join(zones.select("zone_id").distinct(), "zone_id", "left_semi")
    best = F.max("contribution").over(Window.partitionBy("profile", "term"))
    return score_breakdown(picked).withColumn("gap_to_best", best - F.col("contribution"))


# --------------------------------------------------------------------------
# X6 weight sensitivity
# --------------------------------------------------------------------------

def sensitivity_scenarios(profile: str = "rendement", delta: float = 0.2) -> list[tuple[str, tuple]]:
    """Baseline plus each weight moved up and down by ``delta`` (relative)."""
    base = PROFILES[profile]
    out = [("baseline", base)]
    for i, (norm, weight, kind) in enumerate(base):
        for tag, factor in (("up", 1 + delta), ("down", 1 - delta)):
            terms = list(base)
            terms[i] = (norm, weight * factor, kind)
            out.append((f"{norm}_{tag}", tuple(terms)))
    return out


def _score_expr(terms) -> Column:
    total = None
    for norm, weight, kind in terms:
        value = F.coalesce(F.col(norm), F.lit(0.0))
        term = F.lit(weight) * (F.lit(1.0) - value) if kind == "inverse" else F.lit(weight) * value
        if total is None:
            total = -term if kind == "minus" else term
        else:
            total = total - term if kind == "minus" else total + term
    return round_half_up(F.lit(100.0) * total, 2)


def weight_sensitivity(normed: DataFrame, profile: str = "rendement", delta: float = 0.2, k: int = 10) -> DataFrame:
    """Top-k zones under each weight scenario, and whether each is in the baseline top-k.

    Each scenario's top-k is an ``orderBy().limit(k)`` (a per-task top-k and
    one merge of k rows per task), so no scenario ever sorts or gathers all
    zones; the scenario list is a small fixed set built on the driver.
    """
    tops = []
    for name, terms in sensitivity_scenarios(profile, delta):
        scored = normed.select("zone_id", _score_expr(terms).alias("score"))
        top = scored.orderBy(F.col("score").desc_nulls_last(), F.col("zone_id")).limit(k)
        tops.append(top.withColumn("scenario", F.lit(name)))
    stacked = reduce(DataFrame.unionByName, tops)
    ranked = stacked.withColumn(
        "rank", F.row_number().over(Window.partitionBy("scenario").orderBy(F.col("score").desc(), "zone_id"))
    )
    baseline = ranked.where(F.col("scenario") == "baseline").select(
        "zone_id", F.lit(True).alias("in_baseline_top")
    )
    return ranked.join(F.broadcast(baseline), "zone_id", "left").select(
        "scenario", F.col("rank").cast("int").alias("rank"), "zone_id", "score",
        F.coalesce(F.col("in_baseline_top"), F.lit(False)).alias("in_baseline_top"),
    )


# --------------------------------------------------------------------------
# X7 quality rules, X8 load monitoring
# --------------------------------------------------------------------------

def quality_rules(sales: DataFrame, fact: DataFrame, features: DataFrame, seasonal: DataFrame,
                  snapshot_col: str = "snapshot_date") -> DataFrame:
    """Business rules as failing-row counts (uniqueness, ranges, bounds, geography, match, freshness).

    The fact rules share one checkpointed slim projection and one aggregate
    pass; uniqueness is a partial-aggregated count per id; the price bounds are
    exact 1st/99th percentiles (one global group, range-partitioned, one row).
    """
    ensure_checkpoint_dir(fact.sparkSession)
    box = FRANCE_BBOX
    zones = features.select("zone_id", F.lit(True).alias("_known"))
    slim = fact.select("transaction_id", "zone_id", "valeur_fonciere", "surface_reelle_bati", "price_m2_bati") \
        .join(zones, "zone_id", "left").checkpoint()
    bounds = exact_quantiles(slim, [], "price_m2_bati", {"p01": 0.01, "p99": 0.99}).first()
    p01 = F.lit(bounds["p01"] if bounds else None).cast("double")
    p99 = F.lit(bounds["p99"] if bounds else None).cast("double")
    price = F.col("price_m2_bati")
    fact_counts = slim.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("valeur_fonciere") <= 0).alias("positive"),
        F.count_if(F.col("surface_reelle_bati") < 0).alias("non_negative"),
        F.count(price).alias("priced"),
        F.count_if((price < p01) | (price > p99)).alias("within_p01_p99"),
        F.count_if(F.col("zone_id").isNotNull()).alias("keyed"),
        F.count_if(F.col("zone_id").isNotNull() & F.col("_known").isNull()).alias("zone_in_features"),
    )
    m = "fact_real_estate_transactions"
    rule_rows = F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(rule).alias("rule"), F.lit(col).alias("column_name"),
                 F.col(total).alias("row_count"), F.col(rule).alias("failing"))
        for rule, col, total in (("positive", "valeur_fonciere", "rows"), ("non_negative", "surface_reelle_bati", "rows"),
                                 ("within_p01_p99", "price_m2_bati", "priced"), ("zone_in_features", "zone_id", "keyed"))
    ])
    fact_rules = fact_counts.select(F.inline(rule_rows))
    dup = slim.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("_c"))
    unique = dup.agg(F.sum("_c").alias("row_count"),
                     F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias("failing")).select(
        F.lit(m).alias("model"), F.lit("unique").alias("rule"), F.lit("transaction_id").alias("column_name"),
        "row_count", "failing")
    lat, lon = F.col("latitude"), F.col("longitude")
    outside = (lat < box["lat_min"]) | (lat > box["lat_max"]) | (lon < box["lon_min"]) | (lon > box["lon_max"])
    sales_rules = sales.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(lat.isNotNull() & lon.isNotNull() & outside).alias("bbox"),
        F.when(F.datediff(F.max(snapshot_col), F.max("date_mutation")) > 365, F.lit(1)).otherwise(F.lit(0))
        .alias("stale"),
    ).select(F.inline(F.array(
        F.struct(F.lit("stg_dvf_transactions").alias("model"), F.lit("in_france_bbox").alias("rule"),
                 F.lit("latitude,longitude").alias("column_name"), F.col("n").alias("row_count"),
                 F.col("bbox").alias("failing")),
        F.struct(F.lit("stg_dvf_transactions").alias("model"), F.lit("fresh_within_365_days").alias("rule"),
                 F.lit("date_mutation").alias("column_name"), F.col("n").alias("row_count"),
                 F.col("stale").cast("long").alias("failing")),
    )))
    seasonal_rules = seasonal.agg(F.count(F.lit(1)).alias("row_count"),
                                  F.count_if(F.col("seasonal_population_ratio") < 0).alias("failing")).select(
        F.lit("stg_seasonal_population").alias("model"), F.lit("non_negative").alias("rule"),
        F.lit("seasonal_population_ratio").alias("column_name"), "row_count", "failing")
    out = reduce(DataFrame.unionByName, [unique, fact_rules, sales_rules, seasonal_rules])
    return out.select(
        "model", "rule", "column_name", F.col("row_count").cast("long").alias("row_count"),
        F.col("failing").cast("long").alias("failing"), (F.col("failing") == 0).alias("passed"),
    )


def occupancy_rules(occupancy: DataFrame) -> DataFrame:
    """Rules of the zone-month occupancy as failing-row counts: rates in 0..1, no negative amounts, known month, unique key.

    The table is one row per key if it is right, so the counts per key are of
    the table's size and partial.
    """
    per_key = occupancy.groupBy("zone_id", "month_key").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(~F.col("occupancy_rate").between(0.0, 1.0)).alias("rate_in_0_1"),
        F.count_if((F.col("adr") <= 0) | (F.col("revenue_eur") < 0)).alias("positive"),
        F.count_if(F.col("booked_nights") > F.col("open_nights")).alias("booked_within_open"))
    repeated = F.when(F.col("_rows") > 1, F.col("_rows")).otherwise(0)
    sums = per_key.withColumns({"unique": repeated, "not_null": F.when(F.col("month_key").isNull(), F.col("_rows")).otherwise(0)}).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        *[F.coalesce(F.sum(r), F.lit(0)).alias(r) for r in ("rate_in_0_1", "positive", "booked_within_open", "unique", "not_null")])
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column_name"), F.col(r).alias("failing")) for r, c in (
        ("rate_in_0_1", "occupancy_rate"), ("positive", "adr,revenue_eur"), ("booked_within_open", "booked_nights"),
        ("unique", "zone_id,month_key"), ("not_null", "month_key"))])
    out = sums.select("row_count", F.inline(rules))
    return out.select(F.lit("zone_month_occupancy").alias("model"), "rule", "column_name", "row_count", "failing", (F.col("failing") == 0).alias("passed"))


def load_monitoring(raw: dict[str, DataFrame], expected: dict[str, tuple[str, ...]]) -> DataFrame:
    """Per dataset and expected column: rows, empty cells (NULL or ''), empty
    rate, latest snapshot and ingestion time — one aggregate pass per dataset."""
    frames = []
    for name, df in raw.items():
        cols = expected[name]
        empties = [F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(f"_e{i}") for i, c in enumerate(cols)]
        agg = df.agg(F.count(F.lit(1)).alias("row_count"), F.max("_snapshot_date").alias("last_snapshot"),
                     F.max("_ingested_at").alias("last_ingested_at"), *empties)
        items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_e{i}").alias("empty_count"))
                          for i, c in enumerate(cols)])
        frames.append(agg.select(F.lit(name).alias("dataset"), "row_count", "last_snapshot", "last_ingested_at",
                                 F.inline(items)))
    out = reduce(DataFrame.unionByName, frames)
    return out.withColumn("empty_rate", F.col("empty_count") / F.nullif(F.col("row_count"), F.lit(0)).cast("double"))


def geo_match_rate(raw: dict[str, DataFrame], geo_name: str = "geographic_reference") -> DataFrame:
    """Share of each dataset's rows whose commune code exists in the geographic reference.

    Rows are counted per (dataset, code) first, so the join with the distinct
    reference codes sees one row per code and no code is hot.
    """
    codes = raw[geo_name].where(F.col("code_commune") != "").select("code_commune").distinct() \
        .withColumn("_known", F.lit(True))
    parts = [df.select(F.lit(name).alias("dataset"), "code_commune")
             for name, df in raw.items() if name != geo_name and "code_commune" in df.columns]
    stacked = reduce(DataFrame.unionByName, parts)
    per_code = stacked.groupBy("dataset", "code_commune").agg(F.count(F.lit(1)).alias("_n"))
    counted = per_code.join(codes, "code_commune", "left").groupBy("dataset").agg(
        F.sum("_n").alias("row_count"), F.sum(F.when(F.col("_known"), F.col("_n")).otherwise(0)).alias("matched"))
    return counted.select("dataset", "row_count", "matched",
                          (F.col("matched") / F.nullif(F.col("row_count"), F.lit(0)).cast("double")).alias("match_rate"))


# --------------------------------------------------------------------------
# X11 latest-snapshot dedup, X12 anomalies
# --------------------------------------------------------------------------

SALE_KEY = ("id_parcelle", "date_mutation", "code_commune")


def latest_snapshot_rows(raw: DataFrame, keys=SALE_KEY, order=("_snapshot_date", "_ingested_at", "valeur_fonciere")
                         ) -> DataFrame:
    """One raw row per business key: the one from the latest snapshot, then the
    latest ingestion, then the largest ``order`` tail (a deterministic tie-break).
    ``max_by`` is a partial aggregate, so a key with many copies is reduced on
    each task before the shuffle, never gathered."""
    keys = list(keys)
    cols = [c for c in raw.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order])
    kept = raw.groupBy(*keys).agg(F.max_by(F.struct(*cols), rank).alias("_row"))
    return kept.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols])


def price_anomalies(fact: DataFrame, threshold: float = ANOMALY_THRESHOLD) -> DataFrame:
    """Sales whose price per m² has a modified z-score above ``threshold`` in their zone.

    Zone median and MAD are exact and computed without gathering a zone; the
    per-zone table is joined back (broadcast when small, else a shuffle join
    whose skewed partitions AQE splits).
    """
    ensure_checkpoint_dir(fact.sparkSession)
    # The slim priced sales are read by every later step: checkpoint them once.
    priced = fact.where(F.col("zone_id").isNotNull() & F.col("price_m2_bati").isNotNull()).select(
        "transaction_id", "zone_id", "price_m2_bati").checkpoint()
    med = exact_median(priced, ["zone_id"], "price_m2_bati", "zone_median")
    dev = priced.join(med, "zone_id").withColumn(
        "_dev", F.abs(F.col("price_m2_bati") - F.col("zone_median"))).checkpoint()
    mad = exact_median(dev, ["zone_id"], "_dev", "zone_mad")
    scored = dev.join(mad, "zone_id").withColumn(
        "robust_z",
        F.lit(MAD_SCALE) * (F.col("price_m2_bati") - F.col("zone_median")) / F.nullif(F.col("zone_mad"), F.lit(0.0)),
    )
    return scored.where(F.abs(F.col("robust_z")) > threshold).select(
        "transaction_id", "zone_id", "price_m2_bati", "zone_median", "zone_mad", "robust_z")


# --------------------------------------------------------------------------
# X4 grid density, X15 month dimension
# --------------------------------------------------------------------------

def grid_density(sales: DataFrame, poi: DataFrame) -> DataFrame:
    """Per level-8 grid cell: points of interest, sales and mean price per m².

    Both sides are aggregated to one row per cell before the full outer join,
    so the join never pairs individual sales with individual points.
    """
    p = poi.where(F.col("h3_res8").isNotNull()).groupBy("h3_res8").agg(F.count(F.lit(1)).alias("poi_count"))
    s = sales.where(F.col("h3_res8").isNotNull()).groupBy("h3_res8").agg(
        F.count(F.lit(1)).alias("sales_count"), F.avg("price_m2_bati").alias("avg_price_m2_bati"))
    j = p.join(s, "h3_res8", "full")
    return j.select("h3_res8", F.coalesce("poi_count", F.lit(0)).alias("poi_count"),
                    F.coalesce("sales_count", F.lit(0)).alias("sales_count"), "avg_price_m2_bati")


def month_dimension(zone_month: DataFrame) -> DataFrame:
    """Every month between the first and last dated month (time dimension)."""
    bounds = zone_month.agg(F.min("month_key").alias("lo"), F.max("month_key").alias("hi"))
    months = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month_key"))
    return months.select(
        "month_key",
        F.year("month_key").alias("year"),
        F.quarter("month_key").alias("quarter"),
        F.month("month_key").alias("month"),
    )
