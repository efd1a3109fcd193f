"""Roll-ups of states, location history, quarantine and what-if on small tables with hand-made or brute-force results."""

import datetime as dt
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from zonescope.operators import dimensions, quarantine, rollup, scenarios


def d(text):
    return dt.date.fromisoformat(text)


# ---------------------------------------------------------------- X9

SALES = "code_commune string, h3_res9 string, date_mutation date, price_m2_bati double"


def sales_rows(seed=1, n=900):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        zone = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        cell = rnd.choice([None, *[f"g9:{r}:{c}" for r in (100, 101, 102) for c in (7, 8)]])
        when = rnd.choice([None, d("2023-01-31"), d("2023-02-01"), d("2023-04-30"), d("2024-12-31")])
        rows.append((zone, cell, when, rnd.choice([None, 5.0e6 + rnd.random(), 2000.0, 1e-3, 0.0])))
    return rows


def test_levels_equal_statistics_of_raw_rows(spark):
    rows = sales_rows()
    features = spark.createDataFrame([("hot", "01", "N"), ("a", "01", "N"), ("b", "02", "S"), ("x", "03", "S")], "zone_id string, code_departement string, nom_region string")
    places = {"hot": ("01", "N"), "a": ("01", "N"), "b": ("02", "S"), "c": (None, None)}
    values = defaultdict(list)
    for zone, cell, when, price in rows:
        keys = [("admin", "commune", zone), ("admin", "departement", places[zone][0]), ("admin", "region", places[zone][1])] if zone else []
        if cell:
            _, r, c = cell.split(":")
            keys += [("grid", "cell9", cell), ("grid", "cell8", f"g8:{int(r) // 2}:{int(c) // 2}")]
        for key in keys:
            for level, months in (("month", 1), ("quarter", 3), ("year", 12)):
                start = when and when.replace(month=(when.month - 1) // months * months + 1, day=1)
                values[(*key, level, start)].append(price)
    got = {(r.hierarchy, r.place_level, r.place_id, r.time_level, r.period): r for r in rollup.price_levels(spark.createDataFrame(rows, SALES), features).collect()}
    assert set(got) == set(values)
    for key, prices in values.items():
        r, known = got[key], [p for p in prices if p is not None]
        assert (r.transactions, r.priced_transactions) == (len(prices), len(known))
        assert r.avg_price_m2_bati == (pytest.approx(statistics.fmean(known), rel=1e-12) if known else None)
        assert r.stddev_price_m2_bati == (pytest.approx(statistics.stdev(known), rel=1e-9, abs=1e-7) if len(known) > 1 else None)
        assert (r.min_price_m2_bati, r.max_price_m2_bati) == ((min(known), max(known)) if known else (None, None))


def test_merge_does_not_depend_on_the_origin_or_the_split(spark):
    rows = [(i % 4, i % 7, 1000.0 + (i * 37 % 101) / 7) for i in range(500)] + [(9, 1, 3.3), (9, 2, 3.3)]
    table = spark.createDataFrame(rows, "g int, part int, x double")
    whole = {r.g: r for r in rollup.states(table, ["g"], "x").collect()}
    parts = rollup.states(table, ["g", "part"], "x")
    for origin in (0.0, rollup.origin_of(parts), 5e5):
        for r in rollup.merged(parts, ["g"], origin).collect():
            assert (r.rows, r.priced, r.low, r.high) == (whole[r.g].rows, whole[r.g].priced, whole[r.g].low, whole[r.g].high)
            assert r.m2 == pytest.approx(whole[r.g].m2, rel=1e-4 if origin == 5e5 else 1e-9)
    assert rollup.merged(parts, ["g"], 0.0).where("g = 9").first().m2 == 0.0


def test_raw_rows_are_not_expanded(spark):
    frame = spark.createDataFrame(sales_rows(n=50), SALES)
    features = spark.createDataFrame([("a", "01", "N")], "zone_id string, code_departement string, nom_region string")
    plan = rollup.price_levels(frame, features)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "ExistingRDD" not in plan.replace("Scan ExistingRDD[zone_id", "")  # only the stored finest table and the features are read


# ---------------------------------------------------------------- X15

GEO = "code string, name string, region string, snapshot_date date"


def test_history_of_changes_gaps_and_returns(spark):
    s1, s2, s3, s4 = (d(f"2024-0{i}-01") for i in (1, 2, 3, 4))
    rows = [("same", "A", "r", s) for s in (s1, s2, s3, s4)]
    rows += [("renamed", "B", "r", s1), ("renamed", "B", "r", s2), ("renamed", "B2", "r", s3), ("renamed", "B", "r", s4)]
    rows += [("gap", "C", None, s1), ("gap", "C", None, s3), ("gap", "C", None, s4)]
    rows += [("closed", "D", "r", s1), ("closed", "D", "r", s2), ("new", "E", None, s4), ("twin", "F", None, s1), ("twin", "F", "r", s1)]
    rows += [("twin", "F", "r", s) for s in (s2, s3, s4)] + [("twin", "F", "r", s4)] + [(None, "X", "r", s1), ("nodate", "X", "r", None)]
    versions = dimensions.history(spark.createDataFrame(rows, GEO), "code", ["name", "region"])
    got = sorted((r.code, r.version, r.name, r.region, r.valid_from, r.valid_to, r.is_current) for r in versions.collect())
    assert got == sorted([
        ("same", 1, "A", "r", s1, None, True),
        ("renamed", 1, "B", "r", s1, s3, False), ("renamed", 2, "B2", "r", s3, s4, False), ("renamed", 3, "B", "r", s4, None, True),
        ("gap", 1, "C", None, s1, s2, False), ("gap", 2, "C", None, s3, None, True),
        ("closed", 1, "D", "r", s1, s3, False), ("new", 1, "E", None, s4, None, True), ("twin", 1, "F", "r", s1, None, True),
    ])
    assert versions.select("location_key").distinct().count() == len(got)
    facts = spark.createDataFrame([(1, "renamed", s2), (2, "renamed", s3), (3, "gap", d("2024-02-15")), (4, "closed", s4), (5, "none", s1), (6, None, s1), (7, "same", d("2030-01-01")),
                                   (8, "same", d("2023-12-31"))], "id int, code string, day date")
    found = {r.id: r.version for r in dimensions.as_of(facts, versions, "code", "day", ["version"]).collect()}
    assert found == {1: 1, 2: 2, 3: None, 4: None, 5: None, 6: None, 7: 1, 8: None}


def test_history_of_nothing(spark):
    assert dimensions.history(spark.createDataFrame([], GEO), "code", ["name"]).collect() == []


# ---------------------------------------------------------------- X11

STAGED = ("transaction_id string, date_mutation date, code_commune string, type_local string, valeur_fonciere double, surface_reelle_bati double, "
          "nombre_pieces_principales int, extra string")


def staged(spark, rows):
    return spark.createDataFrame([(str(i), *row, "kept") for i, row in enumerate(rows)], STAGED)


def test_accepted_and_rejected_are_the_input(spark):
    day = d("2024-01-01")
    usual = [(day, "z", "Maison", 100_000.0 + 1000 * i, 100.0, 4) for i in range(40)]
    odd = [
        (None, None, "Maison", None, 100.0, 4),  # 40: three reasons
        (day, "z", "Maison", 0.0, 100.0, 4),  # 41
        (day, "z", "Maison", 100_000.0, 1.0, 1),  # 42: surface corrected, so no price and no outlier
        (day, "z", "Maison", 100_000.0, 6.0, 5),  # 43: too small for its rooms
        (day, "z", "Maison", 90_000_000.0, 100.0, 4),  # 44: far above
        (day, "z", "Maison", 100_000.0, -5.0, None),  # 45
        (day, "z", None, 5.0, None, 0),  # 46: no type, no surface
        (day, "z", "Local", 90_000_000.0, 100.0, 4),  # 47: alone in its type
        (day, "z", "Maison", 100_000.0, 9000.0, 4),  # 48
        (day, "z", "Maison", -1.0, 100.0, 4),  # 49: negative value, no logarithm
    ]
    sales = staged(spark, usual + odd)
    accepted, rejected = quarantine.separated(quarantine.judged_sales(sales))
    got = {r.transaction_id: (r.reasons, r.notes) for r in rejected.collect()}
    assert got == {"40": (["no_date", "no_value", "no_commune"], []), "41": (["no_value"], []), "44": (["price_outlier"], []), "49": (["no_value"], [])}
    kept = {r.transaction_id: r for r in accepted.collect()}
    assert set(kept) | set(got) == {str(i) for i in range(50)} and len(kept) + len(got) == 50
    assert kept["42"].notes == ["surface_out_of_range", "surface_below_rooms"] and kept["42"].corrected_surface_m2 is None and kept["42"].corrected_price_m2 is None
    assert kept["43"].notes == ["surface_below_rooms"] and kept["45"].notes == ["surface_out_of_range"] and kept["48"].notes == ["surface_out_of_range"]
    assert kept["0"].notes == [] and kept["0"].corrected_price_m2 == 1000.0 and kept["0"].extra == "kept" and kept["46"].corrected_price_m2 is None


def test_the_input_is_written_once(spark, workdir):
    judged = quarantine.judged(spark.range(100), {"odd": F.col("id") % 2 == 1, "unknown": F.lit(None).cast("boolean")})
    accepted, rejected = quarantine.separated(judged, f"{workdir}/out")
    assert accepted.count() == 50 and rejected.count() == 50
    assert "PartitionFilters: [isnotnull(accepted" in accepted._jdf.queryExecution().executedPlan().toString()


def test_quarantine_of_nothing(spark):
    accepted, rejected = quarantine.separated(quarantine.judged_sales(staged(spark, [])))
    assert accepted.count() == rejected.count() == 0


# ---------------------------------------------------------------- X16

ZONES = "zone_id string, entry_cost_eur double, adr double, occupancy_rate double"


def test_scenarios_equal_brute_force(spark):
    rnd = random.Random(6)
    zones = [(f"z{i:03}", rnd.choice([None, 0.0, 50_000.0, 80_000.0, 120_000.0]), rnd.choice([None, 60.0, 90.0]), rnd.choice([None, 0.0, 0.4, 0.9])) for i in range(200)]
    cases = scenarios.grid((60_000, 100_000), (0.5, 1.5), (1.0,), (0.3,)) + [scenarios.Scenario(10.0, 1.0, 1.0, 0.1)]
    rows = scenarios.scenario_ranking(spark.createDataFrame(zones, ZONES).repartition(5), cases, k=7).collect()
    got = [(r.scenario, r["rank"], r.zone_id, round(r.net_yield, 12), r.on_target) for r in rows]
    want = []
    for number, s in enumerate(cases):
        ranked = []
        for zone, cost, adr, occupied in zones:
            if cost and cost <= s.budget_eur and adr is not None and occupied is not None:
                ranked.append((-(365.0 * min(1.0, occupied * s.occupancy_factor) * adr * s.price_factor * (1 - s.running_rate) / cost), zone))
        want += [(number, i + 1, zone, round(-y, 12), -y >= s.target_yield) for i, (y, zone) in enumerate(sorted(ranked)[:7])]
    assert sorted(got) == want and max(r[0] for r in got) == 3


def test_one_scan_and_a_bounded_grid(spark):
    frame = spark.createDataFrame([("a", 1.0, 1.0, 1.0)], ZONES)
    plan = scenarios.scenario_ranking(frame, scenarios.grid((1, 2), (1,), (1,), (0,)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1 and "Join" not in plan and "WindowGroupLimit" in plan
    for lists in (((), (1,), (1,), (1,)), (range(11), range(10), range(10), (1,))):
        with pytest.raises(ValueError, match="scenarios"):
            scenarios.grid(*lists)
