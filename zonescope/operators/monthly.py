"""Zone x month price statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonescope.functions.columns import month_start
from zonescope.operators.quantiles import exact_median, large_groups, of_groups
from zonescope.session import Scratch

ZONE_MONTH_COLUMNS = (
    "zone_id",
    "month_key",
    "commune_label",
    "transaction_count",
    "median_price_m2_bati",
    "median_price_m2_terrain",
    "avg_price_m2_bati",
    "stddev_price_m2_bati",
)


def zone_month_prices(
    fact: DataFrame,
    exact: bool = True,
    accuracy: int = 10000,
    scratch: Scratch | None = None,
    stored: bool = False,
) -> DataFrame:
    """One row per (zone, month); sales with an unreadable date form a NULL month.

    ``exact=True`` gives the interpolated median (``percentile_cont(0.5)``).
    The fact is read once: five slim columns are written to ``scratch`` (clear
    it when the result has been written) and counted per group.  A fact that is
    ``stored`` (cheap to read again) is not written anew.  Groups that a
    task may gather are done in one aggregate; the prices of larger ones, where
    there are any, go through the narrowed histograms of :func:`exact_median`.
    ``exact=False`` uses the bounded-memory ``percentile_approx`` sketch
    instead (a data value within 1/accuracy rank).
    """
    keys = ["zone_id", "month_key"]
    base = fact.where(F.col("zone_id").isNotNull()).select(
        "zone_id",
        month_start("date_mutation").alias("month_key"),
        "nom_commune",
        "price_m2_bati",
        "price_m2_terrain",
    )

    def aggregated(rows: DataFrame, median) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.max("nom_commune").alias("commune_label"),
            F.count(F.lit(1)).alias("transaction_count"),
            F.avg("price_m2_bati").alias("avg_price_m2_bati"),
            F.stddev_samp("price_m2_bati").alias("stddev_price_m2_bati"),
            *[median(price).alias(f"median_{price}") for price in ("price_m2_bati", "price_m2_terrain")],
        ).select(*ZONE_MONTH_COLUMNS)

    if not exact:
        return aggregated(base, lambda price: F.percentile_approx(price, 0.5, accuracy))
    scratch = scratch or Scratch(fact.sparkSession, "zone-months")
    if not stored:
        base = scratch.written(base)
    large = large_groups(base, keys, scratch)
    if large is None:
        return aggregated(base, lambda price: F.percentile(price, 0.5))
    gathered = aggregated(of_groups(base, keys, large, inside=False), lambda price: F.percentile(price, 0.5))
    return gathered.unionByName(_large_months(of_groups(base, keys, large), keys, scratch))


def _large_months(base: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    stats = base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.avg("price_m2_bati").alias("avg_price_m2_bati"),
        F.stddev_samp("price_m2_bati").alias("stddev_price_m2_bati"),
    )
    # Labels on their own: the greatest of the distinct ones, so that no raw row is sorted for a text maximum.
    labels = base.select(*keys, "nom_commune").distinct().groupBy(*keys).agg(F.max("nom_commune").alias("commune_label"))
    # Both measures go through one selection, told apart by a measure key.
    stacked = base.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("_m"), F.col("price_m2_bati").alias("_price")),
                F.struct(F.lit(1).alias("_m"), F.col("price_m2_terrain").alias("_price")),
            )
        ),
    )
    medians = exact_median(stacked, [*keys, "_m"], "_price", "_median", scratch, stored=True).select(
        *keys,
        F.when(F.col("_m") == 0, F.col("_median")).alias("median_price_m2_bati"),
        F.when(F.col("_m") == 1, F.col("_median")).alias("median_price_m2_terrain"),
    )
    return _merge([stats, labels, medians], keys)


def _merge(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    # Union + group instead of joins: NULL months must meet their own group.
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ZONE_MONTH_COLUMNS if c not in keys])
    return merged.select(*ZONE_MONTH_COLUMNS)
