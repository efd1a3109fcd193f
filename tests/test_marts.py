"""Feature merge, scores and serving: equivalences, properties, edge rows."""

import pytest
from pyspark.sql import functions as F

from zonescope.constants import FLAG_COLUMNS
from zonescope.operators import features as feat
from zonescope.operators import scoring, serving
from zonescope.plans.queries import Models

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def models(spark):
    return Models(spark, SF_SMALL)


def test_long_form_equals_join_chain(models):
    a = feat.zone_features(models.staged)
    b = feat.zone_features_join_chain(models.staged)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_score_properties(models):
    scores = models.scores
    n = scores.count()
    assert n > 0 and scores.select("zone_id").distinct().count() == n
    norms = scoring.zone_norms(models.zone_month, models.features)
    for _, norm in scoring.NORMALISED:
        bad = norms.where(F.col(norm).isNotNull() & ((F.col(norm) < 0) | (F.col(norm) > 1))).count()
        assert bad == 0, norm
    bounds = {"prudent": (-30, 70), "rendement": (-35, 65), "nature_premium": (-20, 70), "petit_budget": (-10, 90)}
    for profile, (lo, hi) in bounds.items():
        row = scores.agg(F.min(f"score_{profile}"), F.max(f"score_{profile}")).first()
        assert lo <= row[0] and row[1] <= hi, profile


def test_top_n_is_sorted_and_bounded(models):
    ranked = serving.rank_zones(models.scores, "Rendement", top_n=7).collect()
    assert len(ranked) == 7
    scores = [r["score_rendement"] for r in ranked]
    assert scores == sorted(scores, reverse=True)
    assert serving.rank_zones(models.scores, "prudent", top_n=500).count() == min(500, models.scores.count())
    assert serving.rank_zones(models.scores, "prudent", top_n=3).count() == 3
    with pytest.raises(ValueError):
        serving.rank_zones(models.scores, "prudent", top_n=0)
    with pytest.raises(ValueError):
        serving.score_column("unknown")


def _staged_fixture(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    flags = ", ".join(f"{f} int" for f in FLAG_COLUMNS)
    return {
        "tourism_poi": df([("A", "Alpha", "nature"), ("A", "Alpha", "shop"), ("A", None, None), ("C", "Gamma", "museum"),
                           (None, "x", "nature")], "code_commune string, nom_commune string, poi_category string"),
        "tourism_labels": df([("A", "Alpha-l", *([1] + [0] * 6)), ("C", "Gamma-l", *([0] * 7))],
                             f"code_commune string, nom_commune string, {flags}"),
        "mobility_access": df([("C", "g", 10.0, 5.0, None, 30.0), ("C", "g", 20.0, 1.0, None, 40.0)],
                              "code_commune string, nom_commune string, minutes_to_gare double, "
                              "minutes_to_motorway double, minutes_to_airport double, drive_time_to_metropole double"),
        "seasonal_population": df([("A", None, 1.0, None), ("A", None, 2.0, 4.0)],
                                  "code_commune string, nom_commune string, seasonal_population_ratio double, "
                                  "peak_population_multiplier double"),
        "tourism_supply_proxy": df([], "code_commune string, nom_commune string, accommodation_count double, "
                                       "hotel_count double, camping_count double, guest_house_count double, "
                                       "holiday_village_count double"),
        "geographic_reference": df([("G", "Geo only", "07", "Dep", "Reg"), ("A", "Alpha-g", "01", "Ain", "ARA")],
                                   "code_commune string, nom_commune string, code_departement string, "
                                   "nom_departement string, nom_region string"),
    }


def test_merge_edge_rows(spark):
    staged = _staged_fixture(spark)
    rows = {r["zone_id"]: r for r in feat.zone_features(staged).collect()}
    assert set(rows) == {"A", "C", "G"}                 # NULL codes dropped, each zone once
    a, c, g = rows["A"], rows["C"], rows["G"]
    assert (a.tourism_poi_count, a.nature_poi_count, a.heritage_poi_count) == (3, 1, 0)  # shop/NULL: total only
    assert a.zone_label == "Alpha" and a.is_littoral == 1 and a.nom_departement == "Ain"
    assert a.seasonal_population_ratio == 1.5 and a.peak_population_multiplier == 4.0
    assert c.heritage_poi_count == 1 and c.minutes_to_gare == 10.0 and c.minutes_to_motorway == 1.0
    assert c.minutes_to_airport is None and c.code_departement is None
    assert g.tourism_poi_count == 0 and g.is_littoral == 0 and g.minutes_to_gare is None
    assert g.accommodation_count == 0.0 and g.zone_label == "Geo only"
    chain = feat.zone_features_join_chain(staged)
    assert feat.zone_features(staged).exceptAll(chain).count() == 0


def test_access_and_zero_range(spark):
    staged = _staged_fixture(spark)
    features = feat.zone_features(staged)
    zone_month = spark.createDataFrame([], "zone_id string, month_key date, commune_label string, "
                                           "transaction_count bigint, median_price_m2_bati double, "
                                           "median_price_m2_terrain double, avg_price_m2_bati double, "
                                           "stddev_price_m2_bati double")
    metrics = scoring.zone_metrics(scoring.latest_month_prices(zone_month), features)
    access = {r.zone_id: r.access_raw for r in metrics.collect()}
    missing = sum(1 / (1 + 999 / s) for s in (30.0, 20.0, 60.0, 90.0))
    assert access["G"] == pytest.approx(missing)
    normed = {r.zone_id: r for r in scoring.with_norms(metrics).collect()}
    # no prices anywhere: every entry ticket is 0, the range is 0, the cost norm is NULL
    assert all(r.cost_norm is None for r in normed.values())
    scores = {r.zone_id: r for r in scoring.zone_scores(zone_month, features).collect()}
    assert set(scores) == {"A", "C", "G"}


def test_access_all_zero_minutes(spark):
    staged = _staged_fixture(spark)
    staged["mobility_access"] = spark.createDataFrame(
        [("C", "g", 0.0, 0.0, 0.0, 0.0)],
        "code_commune string, nom_commune string, minutes_to_gare double, minutes_to_motorway double, "
        "minutes_to_airport double, drive_time_to_metropole double")
    zm = spark.createDataFrame([], "zone_id string, month_key date, commune_label string, transaction_count bigint, "
                                   "median_price_m2_bati double, median_price_m2_terrain double")
    metrics = {r.zone_id: r for r in scoring.zone_metrics(zm, feat.zone_features(staged)).collect()}
    assert metrics["C"].access_raw == 4.0
