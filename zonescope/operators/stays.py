"""Nights, occupancy and yields of rented listings.

* X1 :func:`stg_calendar`: nightly calendar text to typed rows.
* X2 :func:`calendar_zone_month`: the proxies read off a nightly calendar;
  :func:`zone_month_occupancy`: nights, revenue, ADR, occupancy and RevPAR from
  stay *intervals*.  A stay is never exploded into nights: its arrival and its
  departure are two changes of its listing's state, the changes of a day are
  added up before anything moves, and a running sum over a listing's days gives
  the stretches in which nothing changes.  A listing therefore has at most as
  many rows as days with a change, however many stays it has; only a stretch
  that passes a month's end is cut, at the month.
* X3 :func:`zone_yields`: trailing-year revenue against the last known price
  up to each month, an as-of join done as one union and a running last value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonescope.constants import BENCHMARK_SURFACE_M2
from zonescope.functions.columns import ColumnLike, as_text, empty_to_null, month_start, to_date, to_int

AVAILABLE = "t"
BOOKED, BLOCKED = "booked", "blocked"
#: Stays whose listings one task follows through their days.
STAYS_PER_TASK = 200_000


def clean_price(c: ColumnLike) -> Column:
    """Price text to a number: ``$1,234.50``, ``1.234,50 EUR`` and ``85,5`` -> 1234.5, 1234.5, 85.5.

    A separator before three digits groups thousands, any other is the decimal
    one; empty or unreadable text is NULL.
    """
    kept = F.regexp_replace(F.coalesce(as_text(c), F.lit("")), r"[^0-9,.]", "")
    plain = F.regexp_replace(kept, r"[,.]([0-9]{3})", "$1")
    return F.nullif(F.translate(plain, ",", "."), F.lit("")).try_cast("double")


# --------------------------------------------------------------------------
# X1 staging
# --------------------------------------------------------------------------

def stg_calendar(raw: DataFrame) -> DataFrame:
    """One row per listing and night: ``is_available`` (``t`` -> 1, anything else 0), the adjusted price or else the list price."""
    return raw.select(
        empty_to_null("listing_id").alias("listing_id"),
        to_date("date").alias("stay_date"),
        F.when(F.lower(F.coalesce(as_text("available"), F.lit(""))) == AVAILABLE, F.lit(1)).otherwise(F.lit(0)).alias("is_available"),
        F.coalesce(clean_price("adjusted_price"), clean_price("price")).alias("price_eur"),
        to_date("_snapshot_date").alias("snapshot_date"),
    )


def stg_listings(raw: DataFrame) -> DataFrame:
    """The listing dimension; ``open_to`` is the first day it is no longer let."""
    return raw.select(
        empty_to_null("listing_id").alias("listing_id"), empty_to_null("code_commune").alias("zone_id"),
        F.lower(empty_to_null("property_type")).alias("property_type"), to_date("open_from").alias("open_from"), to_date("open_to").alias("open_to"))


def stg_stays(raw: DataFrame) -> DataFrame:
    """Stays as half-open intervals [arrival, departure); the price per night in whole cents, so that sums are exact."""
    arrival, nights = to_date("arrival"), to_int("nights")
    return raw.select(
        empty_to_null("listing_id").alias("listing_id"), arrival.alias("arrival"),
        F.date_add(arrival, nights).alias("departure"), nights.alias("nights"),
        F.round(clean_price("price_per_night") * 100).cast("long").alias("night_cents"),
        F.lower(empty_to_null("status")).alias("status"),
    )


# --------------------------------------------------------------------------
# X2 proxies from the nightly calendar
# --------------------------------------------------------------------------

def calendar_zone_month(calendar: DataFrame, listings: DataFrame) -> DataFrame:
    """Per zone and month: mean price of taken nights, share of taken nights, and mean price times that share.

    The calendar is reduced to (listing, month) sums before it meets the
    dimension, so the join moves one row per listing and month.  Nights
    without a readable date form a NULL month; listings without a zone or
    not in the dimension are left out.
    """
    taken = F.col("is_available") == 0
    monthly = calendar.groupBy("listing_id", month_start("stay_date").alias("month_key")).agg(
        F.count(F.lit(1)).alias("_nights"), F.sum("is_available").alias("_free"),
        F.sum((F.round(F.col("price_eur") * 100)).cast("long")).alias("_cents"), F.count("price_eur").alias("_priced"),
        F.sum(F.when(taken, F.round(F.col("price_eur") * 100).cast("long"))).alias("_taken_cents"),
        F.count(F.when(taken, F.col("price_eur"))).alias("_taken_priced"))
    zoned = monthly.join(listings.where(F.col("zone_id").isNotNull()).select("listing_id", "zone_id"), "listing_id")
    sums = zoned.groupBy("zone_id", "month_key").agg(*[F.sum(c).alias(c) for c in monthly.columns[2:]])
    share = F.lit(1.0) - F.col("_free") / F.col("_nights")
    mean = F.col("_cents") / 100 / F.nullif(F.col("_priced"), F.lit(0))
    return sums.select("zone_id", "month_key", F.col("_nights").alias("nights"),
                       (F.col("_taken_cents") / 100 / F.nullif(F.col("_taken_priced"), F.lit(0))).alias("adr_est"),
                       share.alias("occupancy_calendar_proxy"), (mean * share).alias("revpar_proxy"))


# --------------------------------------------------------------------------
# X2 occupancy from stay intervals
# --------------------------------------------------------------------------

def _changes(stays: DataFrame, listings: DataFrame) -> DataFrame:
    """(listing, day) -> how the numbers of open periods, stays, blocks, priced stays and cents a night change on that day."""
    def both_ends(start: str, end: str, **state) -> Column:
        return F.inline(F.array(*[
            F.struct(F.col(day).alias("day"), *[(F.lit(sign) * value).cast("long").alias(name) for name, value in state.items()])
            for day, sign in ((start, 1), (end, -1))]))

    def when(condition: Column, value: Column | int) -> Column:
        return F.when(condition, value).otherwise(0)

    booked, blocked = F.col("status") == BOOKED, F.col("status") == BLOCKED
    real = stays.where(F.col("listing_id").isNotNull() & F.col("arrival").isNotNull() & (F.col("arrival") < F.col("departure")) & (booked | blocked))
    priced = booked & F.col("night_cents").isNotNull()
    of_stays = real.select("listing_id", both_ends(
        "arrival", "departure", open=F.lit(0), booked=when(booked, 1), blocked=when(blocked, 1), priced=when(priced, 1), cents=when(priced, F.col("night_cents"))))
    let = listings.where(F.col("listing_id").isNotNull() & (F.col("open_from") < F.col("open_to")))
    zero = F.lit(0)
    of_listings = let.select("listing_id", both_ends("open_from", "open_to", open=F.lit(1), booked=zero, blocked=zero, priced=zero, cents=zero))
    states = ("open", "booked", "blocked", "priced", "cents")
    return of_stays.unionByName(of_listings).groupBy("listing_id", "day").agg(*[F.sum(s).alias(s) for s in states])


def spread_listings(changes: DataFrame, stays: DataFrame, rows_per_task: int = STAYS_PER_TASK) -> DataFrame:
    """``changes`` dealt by listing to as many tasks as the stays need, so that a task's memory does not grow with the table."""
    shuffled = int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return changes.repartition(max(shuffled, -(-stays.count() // rows_per_task)), "listing_id")


def listing_month_nights(stays: DataFrame, listings: DataFrame) -> DataFrame:
    """Per listing and month: nights for sale, booked and double-booked, priced stay-nights and revenue in cents.

    A night is booked if any stay covers it, once however many do (the others
    are ``overbooked_nights``); it is for sale if it is booked, or inside the
    listing's open period and not blocked.  Revenue counts every priced stay.
    Stays without a readable arrival, with no night, or neither booked nor
    blocked are ignored.  The running sums are per listing over its days with a
    change: at most one row a day, whatever the number of stays.
    """
    changes = spread_listings(_changes(stays, listings), stays)
    days = Window.partitionBy("listing_id").orderBy("day")
    running = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = {s: F.sum(s).over(running) for s in ("open", "booked", "blocked", "priced", "cents")}
    stretches = changes.select("listing_id", "day", F.lead("day").over(days).alias("until"), *[c.alias(s) for s, c in state.items()])
    stretches = stretches.where(F.col("until").isNotNull() & ((F.col("open") > 0) | (F.col("booked") > 0)))
    months = F.sequence(F.trunc("day", "month"), F.trunc(F.date_sub("until", 1), "month"), F.expr("interval 1 month"))
    cut = stretches.withColumn("month_key", F.explode(months))
    nights = F.datediff(F.least(F.col("until"), F.add_months("month_key", 1)), F.greatest("day", "month_key")).cast("long")
    cut = cut.withColumn("_nights", nights)

    def total(condition: Column, value: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(0))

    booked, n = F.col("booked") > 0, F.col("_nights")
    return cut.groupBy("listing_id", "month_key").agg(
        total(booked | (F.col("blocked") == 0), n).alias("open_nights"),
        total(booked, n).alias("booked_nights"),
        total(booked, n * (F.col("booked") - 1)).alias("overbooked_nights"),
        F.sum(n * F.col("priced")).alias("priced_nights"),
        F.sum(n * F.col("cents")).alias("revenue_cents"),
    )


def zone_month_occupancy(stays: DataFrame, listings: DataFrame) -> DataFrame:
    """Per zone and month: listings with a night for sale, nights, revenue, ADR, occupancy and RevPAR.

    ADR is revenue per priced stay-night, occupancy booked nights over nights
    for sale, RevPAR their product; a zero denominator gives NULL.  Listings
    without a zone and stays of listings not in the dimension are left out
    (inner join of facts and dimension).
    """
    zones = listings.where(F.col("zone_id").isNotNull()).select("listing_id", "zone_id")
    monthly = listing_month_nights(stays, listings).join(zones, "listing_id")
    sums = monthly.groupBy("zone_id", "month_key").agg(
        F.count_if(F.col("open_nights") > 0).alias("listings"),
        *[F.sum(c).alias(c) for c in ("open_nights", "booked_nights", "overbooked_nights", "priced_nights", "revenue_cents")])
    adr = F.col("revenue_cents") / 100 / F.nullif(F.col("priced_nights"), F.lit(0))
    occupancy = F.col("booked_nights") / F.nullif(F.col("open_nights"), F.lit(0))
    return sums.where("open_nights > 0").select(
        "zone_id", "month_key", "listings", "open_nights", "booked_nights", "overbooked_nights",
        (F.col("revenue_cents") / 100).alias("revenue_eur"), adr.alias("adr"), occupancy.alias("occupancy_rate"), (adr * occupancy).alias("revpar"))


# --------------------------------------------------------------------------
# X3 yields
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class EntryCost:
    """Assumptions of the cost of entry and of running a listing (parameters; no reference values exist)."""

    surface_m2: float = float(BENCHMARK_SURFACE_M2)
    land_m2: float = 400.0
    notary_rate: float = 0.08
    acquisition_rate: float = 0.02
    works_per_m2: float = 250.0
    furniture_eur: float = 6000.0
    running_rate: float = 0.35
    fixed_charges_eur: float = 1200.0


def last_known(events: DataFrame, values: DataFrame, key: str, order: str, columns: dict[str, str]) -> DataFrame:
    """As-of join: ``events`` with, per name in ``columns``, the last non-NULL value (and its ``order``) of ``values`` at or before the event.

    Both tables are stacked and one running window per ``key`` carries the
    last value along: one shuffle, no range join, and a key's rows are its
    events and values.  At equal ``order`` values come before events.
    """
    carried = {out: F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("value"), F.col(order).alias("at"))) for column, out in columns.items()}
    known = values.select(key, order, F.lit(0).alias("_kind"), *[c.alias(f"_{out}") for out, c in carried.items()])
    asked = events.withColumn("_kind", F.lit(1))
    earlier = Window.partitionBy(key).orderBy(order, "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = asked.unionByName(known, allowMissingColumns=True)
    found = both.withColumns({f"_{out}": F.last(f"_{out}", ignorenulls=True).over(earlier) for out in columns.values()}).where("_kind = 1")
    return found.select(*events.columns, *[F.col(f"_{out}.value").alias(out) for out in columns.values()],
                        *[F.col(f"_{out}.at").alias(f"{out}_{order}") for out in columns.values()])


def zone_yields(occupancy: DataFrame, zone_month: DataFrame, cost: EntryCost = EntryCost()) -> DataFrame:
    """Per zone and month: revenue of an average listing over the trailing year against the last known prices.

    ``gross_year_eur`` adds the revenue per listing of the month and the eleven
    months before it; prices are the zone's last median up to the month (never
    a later one).  A zone without an earlier price has NULL costs and yields;
    the payback is NULL when the yearly cash flow is not positive.
    """
    months = occupancy.select("zone_id", "month_key", (F.col("revenue_eur") / F.col("listings")).alias("_month_eur"),
                              (F.year("month_key") * 12 + F.month("month_key")).alias("_index"))
    year = Window.partitionBy("zone_id").orderBy("_index").rangeBetween(-11, 0)
    revenue = months.select("zone_id", "month_key", F.sum("_month_eur").over(year).alias("gross_year_eur"))
    dated = zone_month.where(F.col("month_key").isNotNull())
    known = last_known(revenue, dated, "zone_id", "month_key", {"median_price_m2_bati": "price_m2", "median_price_m2_terrain": "land_price_m2"})
    purchase = F.col("price_m2") * cost.surface_m2
    entry = purchase * (1 + cost.notary_rate + cost.acquisition_rate) + (cost.works_per_m2 * cost.surface_m2 + cost.furniture_eur)
    gross = F.col("gross_year_eur")
    net = gross * (1 - cost.running_rate) - cost.fixed_charges_eur

    def over(value: Column, base: Column) -> Column:
        return F.when(base > 0, value / base)

    return known.select(
        "zone_id", "month_key", "gross_year_eur", net.alias("net_year_eur"),
        F.col("price_m2_month_key").alias("price_month"), "price_m2", "land_price_m2",
        entry.alias("entry_cost_eur"), over(gross, entry).alias("gross_yield"), over(net, entry).alias("net_yield"),
        over(entry, net).alias("payback_years"), over(gross, purchase).alias("revenue_to_price"),
        over(gross, F.col("land_price_m2") * cost.land_m2).alias("revenue_to_land"))
