"""Calendar cleaning, occupancy from stay intervals and yields, against night-by-night counting."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from zonescope.operators import stays as st

STAYS = "listing_id string, arrival date, departure date, nights int, night_cents long, status string"
LISTINGS = "listing_id string, zone_id string, property_type string, open_from date, open_to date"
DAY = dt.timedelta(days=1)


def d(text):
    return dt.date.fromisoformat(text)


def stays(spark, rows):
    return spark.createDataFrame([(i, a, a + n * DAY if a and n is not None else None, n, c, s) for i, a, n, c, s in rows], STAYS)


def listings(spark, rows):
    return spark.createDataFrame([(i, z, "maison", a, b) for i, z, a, b in rows], LISTINGS)


def nights_brute(stay_rows, listing_rows):
    """(listing, month) -> open, booked, overbooked, priced stay-nights, cents; every night on its own."""
    state = defaultdict(lambda: [0, 0, 0, 0, 0])
    for i, _, a, b in listing_rows:
        while i and a and b and a < b:
            state[i, a][0] = 1
            a += DAY
    for i, a, n, c, s in stay_rows:
        for k in range(n or 0) if i and a and s in ("booked", "blocked") else ():
            night = state[i, a + k * DAY]
            if s == "blocked":
                night[2] += 1
            else:
                night[1] += 1
                night[3] += c is not None
                night[4] += c or 0
    out = defaultdict(lambda: [0, 0, 0, 0, 0])
    for (i, day), (is_open, booked, blocked, priced, cents) in state.items():
        if is_open or booked:
            for at, n in enumerate((booked > 0 or not blocked, booked > 0, max(booked - 1, 0), priced, cents)):
                out[i, day.replace(day=1)][at] += int(n)
    return {k: tuple(v) for k, v in out.items()}


def measured(spark, stay_rows, listing_rows):
    rows = st.listing_month_nights(stays(spark, stay_rows), listings(spark, listing_rows)).collect()
    got = {(r.listing_id, r.month_key): (r.open_nights, r.booked_nights, r.overbooked_nights, r.priced_nights, r.revenue_cents) for r in rows}
    assert len(got) == len(rows)
    return got


def test_stays_over_month_and_year_ends(spark):
    homes = [("a", "z", d("2023-12-01"), d("2024-04-01"))]
    got = measured(spark, [("a", d("2023-12-30"), 5, 1000, "booked"), ("a", d("2024-01-31"), 31, 2000, "booked")], homes)
    assert got == {
        ("a", d("2023-12-01")): (31, 2, 0, 2, 2000),
        ("a", d("2024-01-01")): (31, 4, 0, 4, 3 * 1000 + 2000),
        ("a", d("2024-02-01")): (29, 29, 0, 29, 58000),
        ("a", d("2024-03-01")): (31, 1, 0, 1, 2000),
    }


def test_turnover_overlap_block_and_bad_rows(spark):
    homes = [("a", "z", d("2024-01-10"), d("2024-01-20")), ("b", "z", None, d("2024-01-20")), ("c", "z", d("2024-01-05"), d("2024-01-05"))]
    rows = [
        ("a", d("2024-01-10"), 2, 500, "booked"), ("a", d("2024-01-12"), 2, 700, "booked"),  # turnover on the 12th: no gap, no overlap
        ("a", d("2024-01-13"), 3, None, "booked"),  # overlaps one night, no price
        ("a", d("2024-01-15"), 4, None, "blocked"),  # blocks four nights, of which one is booked all the same
        ("a", d("2024-01-25"), 1, 900, "booked"),  # outside the open period: booked nights count as for sale
        ("a", d("2024-01-02"), 3, 900, "blocked"), ("a", d("2024-01-11"), 0, 1, "booked"), ("a", None, 3, 1, "booked"),
        ("a", d("2024-01-11"), 2, 1, "cancelled"), (None, d("2024-01-11"), 2, 1, "booked"), ("b", d("2024-01-11"), 2, 100, "booked"),
    ]
    got = measured(spark, rows, homes)
    assert got == {("a", d("2024-01-01")): (8, 7, 1, 5, 2 * 500 + 2 * 700 + 900), ("b", d("2024-01-01")): (2, 2, 0, 2, 200)}
    assert got == nights_brute(rows, homes)


def random_rows(seed, n=400):
    rnd = random.Random(seed)
    names = [f"l{i}" for i in range(12)]
    rows = [(rnd.choice(names) if rnd.random() < 0.66 else "hot", d("2023-11-20") + rnd.randrange(200) * DAY, rnd.choice([1, 2, 7, 40, 90, 0, None]),
             rnd.choice([None, 5000, 7512]), rnd.choice(["booked", "booked", "blocked", "other", None])) for _ in range(n)]
    homes = [(name, rnd.choice(["z1", "z2", None]), d("2023-12-01") + rnd.randrange(60) * DAY, d("2024-05-01") + rnd.randrange(90) * DAY) for name in names[:-1]]
    return rows, [*homes, ("hot", "z1", d("2023-01-01"), d("2024-12-31"))]


@pytest.mark.parametrize("seed", [1, 2])
def test_sweep_equals_night_by_night(spark, seed):
    rows, homes = random_rows(seed)
    want = {k: v for k, v in nights_brute(rows, homes).items()}
    assert measured(spark, rows, homes) == want


def test_zone_month_occupancy(spark):
    rows, homes = random_rows(3)
    zones = {i: z for i, z, _, _ in homes if z}
    sums = defaultdict(lambda: [0] * 6)
    for (i, month), night in nights_brute(rows, homes).items():
        if i in zones:
            sums[zones[i], month][0] += night[0] > 0
            for at, n in enumerate(night, 1):
                sums[zones[i], month][at] += n
    got = {(r.zone_id, r.month_key): r for r in st.zone_month_occupancy(stays(spark, rows), listings(spark, homes)).collect()}
    assert set(got) == {k for k, v in sums.items() if v[1]}
    for key, r in got.items():
        n_listings, n_open, booked, over, priced, cents = sums[key]
        assert (r.listings, r.open_nights, r.booked_nights, r.overbooked_nights) == (n_listings, n_open, booked, over)
        assert 0 <= r.occupancy_rate <= 1 and r.occupancy_rate == pytest.approx(booked / n_open)
        assert r.adr == (pytest.approx(cents / 100 / priced) if priced else None)
        assert r.revpar == (pytest.approx(r.adr * r.occupancy_rate) if priced else None)


def test_a_listings_rows_are_its_days_with_a_change(spark):
    many = spark.range(5000).select(F.lit("hot").alias("listing_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("arrival")).select(
        "listing_id", "arrival", F.date_add("arrival", 7).alias("departure"), F.lit(7).alias("nights"), F.lit(100).cast("long").alias("night_cents"), F.lit("booked").alias("status"))
    changes = st._changes(many, listings(spark, [("hot", "z", d("2024-01-01"), d("2024-03-01"))]))
    assert changes.count() <= 38
    plan = st.listing_month_nights(many, listings(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # changes by (listing, day); then running sums and months share one


def test_empty_inputs(spark):
    assert st.zone_month_occupancy(stays(spark, []), listings(spark, [])).collect() == []


# ---------------------------------------------------------------- calendar


def test_clean_price(spark):
    cases = {"$1,234.50": 1234.5, "1.234,50 EUR": 1234.5, "85,5": 85.5, "$85.30": 85.3, "1,234,567": 1234567.0, "": None, None: None, "n/a": None, "1.2.3": None, "40": 40.0}
    rows = spark.createDataFrame([(k,) for k in cases], "p string").select("p", st.clean_price("p").alias("v")).collect()
    assert {r.p: r.v for r in rows} == cases


def test_calendar_proxies(spark):
    raw = spark.createDataFrame([
        ("1", "2024-01-31", "t", "$100.00", ""), ("1", "2024-01-30", "f", "$1,100.00", "90,5"), ("1", "2024-02-01", "f", "", None), ("1", "bad", "T", "$1", ""),
        ("2", "2024-01-30", None, "$50.00", ""), ("3", "2024-01-30", "t", "$1", ""), ("9", "2024-01-30", "t", "$1", ""),
    ], "listing_id string, date string, available string, price string, adjusted_price string").withColumn("_snapshot_date", F.lit("2024-06-30"))
    calendar = st.stg_calendar(raw)
    assert [r.is_available for r in calendar.collect()] == [1, 0, 0, 1, 0, 1, 1]
    homes = listings(spark, [("1", "z", None, None), ("2", "z", None, None), ("3", None, None, None)])
    got = {r.month_key: r for r in st.calendar_zone_month(calendar, homes).collect()}
    january, february = got[d("2024-01-01")], got[d("2024-02-01")]
    assert january.nights == 3 and january.adr_est == pytest.approx((90.5 + 50) / 2)
    assert january.occupancy_calendar_proxy == pytest.approx(2 / 3) and january.revpar_proxy == pytest.approx((100 + 90.5 + 50) / 3 * 2 / 3)
    assert february.adr_est is None and february.revpar_proxy is None and set(got) == {d("2024-01-01"), d("2024-02-01"), None}


# ---------------------------------------------------------------- yields


def test_last_known_value(spark):
    events = spark.createDataFrame([("a", 1), ("a", 5), ("a", 6), ("b", 9), (None, 3)], "k string, t int")
    values = spark.createDataFrame([("a", 2, 10.0, None), ("a", 5, 20.0, 1), ("a", 6, None, 2), ("a", 7, 99.0, 9), ("c", 1, 1.0, 1)], "k string, t int, v double, w int")
    rows = st.last_known(events, values, "k", "t", {"v": "x", "w": "y"}).collect()
    assert {(r.k, r.t): (r.x, r.x_t, r.y) for r in rows} == {
        ("a", 1): (None, None, None), ("a", 5): (20.0, 5, 1), ("a", 6): (20.0, 5, 2), ("b", 9): (None, None, None), (None, 3): (None, None, None)}


def test_yields(spark):
    occupancy = spark.createDataFrame(
        [("a", d("2023-01-01"), 2, 2000.0), ("a", d("2023-12-01"), 1, 700.0), ("a", d("2024-01-01"), 1, 30.0), ("none", d("2024-01-01"), 1, 900.0), ("late", d("2024-01-01"), 1, 10.0)],
        "zone_id string, month_key date, listings long, revenue_eur double")
    prices = spark.createDataFrame(
        [("a", d("2023-02-01"), 1000.0, 50.0), ("a", d("2023-12-01"), 2000.0, None), ("a", None, 9.0, 9.0), ("late", d("2024-02-01"), 1.0, 1.0)],
        "zone_id string, month_key date, median_price_m2_bati double, median_price_m2_terrain double")
    cost = st.EntryCost(surface_m2=50.0, land_m2=100.0, notary_rate=0.1, acquisition_rate=0.0, works_per_m2=10.0, furniture_eur=500.0, running_rate=0.5, fixed_charges_eur=100.0)
    got = {(r.zone_id, r.month_key): r for r in st.zone_yields(occupancy, prices, cost).collect()}
    first, year_end, next_year = got["a", d("2023-01-01")], got["a", d("2023-12-01")], got["a", d("2024-01-01")]
    assert first.gross_year_eur == 1000.0 and first.entry_cost_eur is None and first.gross_yield is None  # a later price never counts
    assert year_end.gross_year_eur == 1700.0 and year_end.price_month == d("2023-12-01") and year_end.land_price_m2 == 50.0
    entry = 2000.0 * 50 * 1.1 + 10 * 50 + 500
    assert year_end.entry_cost_eur == pytest.approx(entry) and year_end.gross_yield == pytest.approx(1700 / entry)
    assert year_end.payback_years == pytest.approx(entry / (1700 * 0.5 - 100)) and year_end.revenue_to_land == pytest.approx(1700 / 5000)
    assert next_year.gross_year_eur == 730.0  # January of the year before has left the window
    assert got["none", d("2024-01-01")].price_m2 is None and got["late", d("2024-01-01")].net_yield is None
    assert got["late", d("2024-01-01")].payback_years is None


def test_tasks_of_the_running_sums_grow_with_the_stays(spark):
    from pyspark.sql import functions as F

    from zonescope.operators.stays import spread_listings

    stays = spark.range(1000)
    changes = spark.range(50).select(F.col("id").alias("listing_id"))
    assert spread_listings(changes, stays, rows_per_task=10).rdd.getNumPartitions() >= 100
    assert spread_listings(changes, stays.limit(0)).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
