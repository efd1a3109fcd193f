"""Distributed exact median against a brute-force median."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from zonescope.operators import quantiles
from zonescope.operators.quantiles import exact_median


@pytest.fixture(params=[quantiles.GATHER_ROWS, 4], ids=["gathered", "narrowed"])
def group_limit(request, monkeypatch):
    """Once with all groups gathered, once with those over four rows narrowed."""
    monkeypatch.setattr(quantiles, "GATHER_ROWS", request.param)


def _brute(rows):
    groups = {}
    for k1, k2, v in rows:
        if v is not None:
            groups.setdefault((k1, k2), []).append(v)
    return {k: float(np.median(vs)) for k, vs in groups.items()}


def _spark_result(spark, rows):
    df = spark.createDataFrame(rows, "zone string, month date, price double")
    out = exact_median(df, ["zone", "month"], "price", "median").collect()
    return {(r["zone"], r["month"]): r["median"] for r in out}


def test_hot_group_duplicates_nulls(spark, group_limit):
    rnd = random.Random(7)
    m1, m2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    rows = []
    # one zone-month holds a third of all rows, with many duplicate values
    rows += [("hot", m1, float(rnd.choice([100, 200, 300]) + rnd.random() * (i % 3))) for i in range(6000)]
    rows += [("hot", m1, 250.0)] * 1000
    rows += [(f"z{i % 50}", m2 if i % 2 else m1, rnd.uniform(1, 5000)) for i in range(12000)]
    rows += [("z1", None, 10.0), ("z1", None, 20.0), ("z1", None, None)]   # NULL month is a group
    rows += [("allnull", m1, None)]                                         # absent from result
    rows += [("even", m2, 1.0), ("even", m2, 2.0), ("even", m2, 10.0), ("even", m2, 11.0)]
    rows += [("single", m1, 42.0)]
    got = _spark_result(spark, rows)
    want = _brute(rows)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12), k
    assert got[("even", m2)] == 6.0 and got[("z1", None)] == 15.0 and got[("single", m1)] == 42.0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from([1, 2]),
                          st.one_of(st.none(), st.integers(-50, 50).map(float))), min_size=1, max_size=60))
def test_matches_brute_force(spark, data):
    """Small groups, all narrowed."""
    rows = [(z, dt.date(2024, m, 1), v) for z, m, v in data]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quantiles, "GATHER_ROWS", 0)
        got = _spark_result(spark, rows)
    want = _brute(rows)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12)


def test_quantiles_and_percent_rank_brute_force(spark, group_limit):
    from zonescope.operators.quantiles import exact_quantiles, percent_rank

    rnd = random.Random(11)
    rows = [("hot", float(rnd.randint(0, 400))) for _ in range(5000)]          # a third of the rows, many ties
    rows += [(f"g{i % 7}", rnd.uniform(-10, 10)) for i in range(10000)]
    rows += [(None, 3.0), (None, 1.0), (None, 2.0), ("one", 5.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"p05": 0.05, "p95": 0.95}).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g]["p05"] == pytest.approx(float(np.quantile(vs, 0.05)), rel=1e-12, abs=1e-12)
        assert got[g]["p95"] == pytest.approx(float(np.quantile(vs, 0.95)), rel=1e-12, abs=1e-12)
    ranked = percent_rank(df, ["g"], "v", "pr").collect()
    assert len(ranked) == len(rows)
    for r in ranked:
        vs = groups.get(r["g"], [])
        if r["v"] is None:
            assert r["pr"] is None
        elif len(vs) == 1:
            assert r["pr"] == 0.0
        else:
            assert r["pr"] == pytest.approx(sum(x < r["v"] for x in vs) / (len(vs) - 1))


def test_latest_snapshot_rows_many_copies(spark):
    from zonescope.operators.analytics import latest_snapshot_rows

    rows = [("p1", "2024-01-01", "c1", f"{i} EUR", f"2024-0{1 + i % 3}-01", "t") for i in range(3000)]
    rows += [("p2", "2024-02-01", "c1", "7 EUR", "2024-01-01", "t")]
    df = spark.createDataFrame(rows, "id_parcelle string, date_mutation string, code_commune string, "
                                     "valeur_fonciere string, _snapshot_date string, _ingested_at string")
    out = {r.id_parcelle: r for r in latest_snapshot_rows(df).collect()}
    assert len(out) == 2 and out["p2"].valeur_fonciere == "7 EUR"
    latest = [r for r in rows if r[0] == "p1" and r[4] == "2024-03-01"]
    assert out["p1"]._snapshot_date == "2024-03-01"
    assert out["p1"].valeur_fonciere == max(r[3] for r in latest)


def test_many_distinct_values_under_all_settings(spark):
    """Consumers that read a subset of columns see every row, whatever Spark reuses or re-plans."""
    from zonescope.operators.quantiles import exact_quantiles, percent_rank, value_ranks

    df = spark.range(400_000).selectExpr("cast(id % 500 as int) as g", "cast(id as double) as v")
    for reuse in ("true", "false"):
        for adaptive in ("true", "false"):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            try:
                ranks = value_ranks(df, ["g"], "v")
                assert tuple(ranks.selectExpr("count(*)", "sum(count)").first()) == (400_000, 400_000)
                assert ranks.select("g", "n").distinct().count() == 500
            finally:
                spark.conf.set("spark.sql.exchange.reuse", "true")
                spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert exact_quantiles(df, ["g"], "v", {"q": 0.5}).count() == 500
    assert percent_rank(df, ["g"], "v", "p").where("p is null").count() == 0


def test_narrowing_far_apart_and_close_values(spark, group_limit):
    """Signs, zeros, subnormals, neighbours in the last bit, infinities and many equal values."""
    rnd = random.Random(5)
    groups = {
        "signs": [-3.0, -2.999999, 0.0, -0.0, 5e-324, -5e-324, 2.0, 1e300, -1e300],
        "close": [1.0 + i * 2.0**-52 for i in range(301)],
        "same": [7.25] * 500,
        "wide": [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300) for _ in range(999)],
        "ends": [float("inf"), float("-inf"), 1.0, 2.0, 3.0],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = {r.g: r for r in quantiles.exact_quantiles(df, ["g"], "v", {"a": 0.0, "m": 0.5, "b": 0.9, "z": 1.0}).collect()}
    for g, vs in groups.items():
        ordered = sorted(vs)
        assert got[g].a == ordered[0] and got[g].z == ordered[-1]
        if len(vs) % 2:
            assert got[g].m == ordered[len(vs) // 2]
        if g != "ends":
            assert got[g].b == pytest.approx(float(np.quantile(vs, 0.9)), rel=1e-12)
    assert quantiles.exact_quantiles(df.where("false"), [], "v", {"q": 0.5}).count() == 0
    whole = sorted(v for vs in groups.values() for v in vs)
    assert quantiles.exact_quantiles(df, [], "v", {"q": 0.5}).first().q == pytest.approx((whole[len(whole) // 2 - 1] + whole[len(whole) // 2]) / 2 if len(whole) % 2 == 0 else whole[len(whole) // 2])


def test_zone_months_with_large_groups(spark, group_limit):
    from zonescope.operators.monthly import zone_month_prices

    rnd = random.Random(9)
    rows = [(rnd.choice(["hot", "hot", "a", "b", None]), rnd.choice([None, dt.date(2024, 1, 5), dt.date(2024, 1, 9), dt.date(2024, 2, 1)]), rnd.choice(["x", "y", None]),
             rnd.choice([None, round(rnd.uniform(1, 9000), 2)]), rnd.choice([None, 3.0])) for _ in range(400)]
    fact = spark.createDataFrame(rows, "zone_id string, date_mutation date, nom_commune string, price_m2_bati double, price_m2_terrain double")
    want = {}
    for zone, day, label, price, land in rows:
        if zone:
            want.setdefault((zone, day and day.replace(day=1)), []).append((label, price, land))
    got = {(r.zone_id, r.month_key): r for r in zone_month_prices(fact).collect()}
    assert set(got) == set(want)
    for key, members in want.items():
        prices = [p for _, p, _ in members if p is not None]
        r = got[key]
        assert r.transaction_count == len(members) and r.commune_label == max((x for x, _, _ in members if x), default=None)
        assert r.median_price_m2_bati == (pytest.approx(float(np.median(prices))) if prices else None)
        assert r.median_price_m2_terrain == (3.0 if any(t for _, _, t in members) else None)
        assert r.avg_price_m2_bati == (pytest.approx(float(np.mean(prices))) if prices else None)
