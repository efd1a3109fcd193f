"""What travels in the shuffles of the deduplication and the roll-up."""

import re

from zonescope.operators import rollup
from zonescope.plans import extensions
from zonescope.plans.queries import Models

SMOKE = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_deduplication_carries_only_what_it_reads(spark):
    aggregated = [line for line in plan(extensions.latest_snapshot_dedup(Models(spark, SMOKE))).splitlines() if "max_by" in line]
    assert aggregated and not any(c in line for line in aggregated for c in ("type_local", "surface_terrain", "h3_res9", "longitude"))
    assert any("nom_commune" in line for line in aggregated)


def test_periods_need_no_shuffle_of_their_own(spark):
    sales = spark.createDataFrame(
        [("z1", "g8:2:2", "g9:4:4", f"2024-0{i % 9 + 1}-03", float(i)) for i in range(40)],
        "code_commune string, h3_res8 string, h3_res9 string, date_mutation string, price_m2_bati double").selectExpr("* except (date_mutation)", "date(date_mutation) as date_mutation")
    features = spark.createDataFrame([("z1", "01", "R")], "zone_id string, code_departement string, nom_region string")
    levels = rollup.price_levels(sales, features)
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan(levels))
    assert keys and not any("time_level" in k for k in keys)
    years = {(r.place_level, r.place_id): r.transactions for r in levels.where("time_level = 'year'").collect()}
    assert years == {("commune", "z1"): 40, ("departement", "01"): 40, ("region", "R"): 40, ("cell9", "g9:4:4"): 40, ("cell8", "g8:2:2"): 40}
