"""Roll-ups over two hierarchies of place and one of time, from mergeable states.

The raw sales are read and aggregated once, to the finest table (commune, cell,
month).  Every coarser level is merged from the next finer one:

    place, administrative   commune -> département -> région
    place, grid             cell of level 9 -> cell of level 8
    time                    month -> quarter -> year

A state is (rows, priced, total, m2, low, high): counts, the sum, the summed
squared deviations from the mean, and the extremes.  States merge by plain sums
around a fixed origin near the overall mean, so every merge is a partial
aggregate: a commune with a third of all sales is combined per task.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonescope.functions.columns import month_start
from zonescope.session import scratch_path

#: Rows of the finest table per task of the last grouping: its memory does not grow with the table.
ROWS_PER_TASK = 200_000
STATE = ("rows", "priced", "total", "m2", "low", "high")


def states(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The state of ``value`` per group of raw rows."""
    x = F.col(value)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count(x).alias("priced"), F.sum(x).alias("total"),
        (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("low"), F.max(x).alias("high"))


def origin_of(table: DataFrame) -> float:
    """The overall mean of a table of states: the point about which squares are summed (any value is right, a near one loses no digits)."""
    sums = table.agg(F.sum("total"), F.sum("priced")).first()
    return sums[0] / sums[1] if sums[1] else 0.0


def merged(table: DataFrame, keys: list[str], origin: float) -> DataFrame:
    """States of coarser groups: the squares of each state are moved to ``origin``, added up, and moved back to the group's mean."""
    def offset(total: Column, priced: Column) -> Column:
        mean_off = total / F.nullif(priced, F.lit(0)) - F.lit(origin)
        return priced * mean_off * mean_off

    squares = F.col("m2") + offset(F.col("total"), F.col("priced"))
    sums = table.withColumn("_squares", squares).groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("priced").alias("priced"), F.sum("total").alias("total"),
        F.sum("_squares").alias("_squares"), F.min("low").alias("low"), F.max("high").alias("high"))
    # Equal extremes mean no deviation: what is left of the squares is rounding.
    m2 = F.when(F.col("low") == F.col("high"), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.col("_squares") - offset(F.col("total"), F.col("priced"))))
    return sums.select(*keys, "rows", "priced", "total", m2.alias("m2"), "low", "high")


def coarse_cell(cell: Column, fine: int, coarse: int) -> Column:
    """The cell of level ``coarse`` that holds a cell of level ``fine`` (cells are halved per level and axis)."""
    row, column = (F.split(cell, ":").getItem(i).cast("long") for i in (1, 2))
    by = fine - coarse
    return F.concat(F.lit(f"g{coarse}:"), F.shiftright(row, by).cast("string"), F.lit(":"), F.shiftright(column, by).cast("string"))


def finest_sales(sales: DataFrame) -> DataFrame:
    """(zone, cell, month) states of the price per m², written once to the shared checkpoint folder."""
    table = states(sales.select(F.col("code_commune").alias("zone_id"), F.col("h3_res9").alias("cell"),
                                month_start("date_mutation").alias("month_key"), "price_m2_bati"), ["zone_id", "cell", "month_key"], "price_m2_bati")
    path = scratch_path(table.sparkSession, f"finest-{uuid.uuid4().hex}")
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def price_levels(sales: DataFrame, features: DataFrame) -> DataFrame:
    """Sales statistics at every level: (hierarchy, place_level, place_id, time_level, period).

    Sales without a commune (cell) are left out of the administrative (grid)
    hierarchy; communes without a département or région form a NULL place
    there; unreadable dates form a NULL period.
    """
    finest = finest_sales(sales)
    origin = origin_of(finest)
    communes = merged(finest.where("zone_id is not null"), ["zone_id", "month_key"], origin)
    areas = communes.join(features.select("zone_id", "code_departement", "nom_region"), "zone_id", "left")
    departements = merged(areas, ["code_departement", "nom_region", "month_key"], origin)
    regions = merged(departements, ["nom_region", "month_key"], origin)
    cells = merged(finest.where("cell is not null"), ["cell", "month_key"], origin)
    wide = merged(cells.select(coarse_cell(F.col("cell"), 9, 8).alias("cell"), "month_key", *STATE), ["cell", "month_key"], origin)
    places = [("admin", "commune", communes, "zone_id"), ("admin", "departement", departements, "code_departement"), ("admin", "region", regions, "nom_region"),
              ("grid", "cell9", cells, "cell"), ("grid", "cell8", wide, "cell")]
    monthly = reduce(DataFrame.unionByName, [
        table.select(F.lit(h).alias("hierarchy"), F.lit(level).alias("place_level"), F.col(key).alias("place_id"), "month_key", *STATE) for h, level, table, key in places])
    periods = F.array(*[F.struct(F.lit(name).alias("time_level"), F.trunc("month_key", unit).alias("period"))
                        for name, unit in (("month", "month"), ("quarter", "quarter"), ("year", "year"))])
    # A place's months move once, before they become months, quarters and years: the groups below need no shuffle of their own.
    tasks = max(int(finest.sparkSession.conf.get("spark.sql.shuffle.partitions")), finest.count() // ROWS_PER_TASK)
    monthly = monthly.repartition(tasks, "hierarchy", "place_level", "place_id")
    timed = monthly.select("hierarchy", "place_level", "place_id", *STATE, F.inline(periods))
    out = merged(timed, ["hierarchy", "place_level", "place_id", "time_level", "period"], origin)
    return out.select(
        "hierarchy", "place_level", "place_id", "time_level", "period", F.col("rows").alias("transactions"), F.col("priced").alias("priced_transactions"),
        (F.col("total") / F.nullif(F.col("priced"), F.lit(0))).alias("avg_price_m2_bati"),
        F.sqrt(F.col("m2") / F.when(F.col("priced") > 1, F.col("priced") - 1)).alias("stddev_price_m2_bati"),
        F.col("low").alias("min_price_m2_bati"), F.col("high").alias("max_price_m2_bati"))
