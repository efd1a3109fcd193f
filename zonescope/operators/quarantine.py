"""Quarantine (X11): outliers and impossible values are set aside with their reasons, in one pass.

Every row is judged by all rules and written once, partitioned by the verdict:
the accepted and the rejected rows are two reads of one table, so together
they are the input.  What can be corrected (a surface that cannot be) is
emptied in the accepted row and noted, not rejected.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonescope.functions.columns import price_per_m2
from zonescope.operators.quantiles import exact_quantiles
from zonescope.session import scratch_path

#: Tukey's far fences: outliers lie beyond the quartiles by this many interquartile ranges.
FAR_FENCE = 3.0


@dataclass(frozen=True)
class SurfaceLimits:
    """What a dwelling can be (parameters): built surface and surface per main room, in m²."""

    least_m2: float = 5.0
    most_m2: float = 5000.0
    least_per_room_m2: float = 2.0


def judged(df: DataFrame, rejects: dict[str, Column], notes: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with ``reasons`` and ``notes`` (names of the rules that hold, in the given order) and ``accepted`` (no reason).

    A rule that is NULL for a row does not hold.
    """
    def named(rules: dict[str, Column]) -> Column:
        items = [F.when(rule, F.lit(name)) for name, rule in rules.items()]
        return F.array_compact(F.array(*items)) if items else F.array().cast("array<string>")

    return df.withColumns({"reasons": named(rejects), "notes": named(notes or {})}).withColumn("accepted", F.size("reasons") == 0)


def fences(df: DataFrame, keys: list[str], value: str, width: float = FAR_FENCE) -> DataFrame:
    """Per group: ``low_fence`` and ``high_fence`` of the logarithm of positive values, from exact quartiles.

    The quartiles come from the rank selection that never gathers a group.
    """
    logs = df.where(F.col(value) > 0).select(*keys, F.ln(value).alias("_log"))
    q = exact_quantiles(logs, keys, "_log", {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * width
    return q.select(*keys, (F.col("q1") - spread).alias("low_fence"), (F.col("q3") + spread).alias("high_fence"))


def judged_sales(sales: DataFrame, limits: SurfaceLimits = SurfaceLimits()) -> DataFrame:
    """Staged sales with corrected surface and price, ``reasons``, ``notes`` and ``accepted``.

    Rejected: no readable date, no positive value, no commune, or a price per
    m² (after the correction) beyond the far fences of its dwelling type.
    Corrected and noted: a built surface that is negative, tiny, huge, or too
    small for its rooms; surface and price per m² become NULL.
    """
    surface, rooms = F.col("surface_reelle_bati"), F.col("nombre_pieces_principales")
    bad = {
        "surface_out_of_range": (surface < limits.least_m2) | (surface > limits.most_m2),
        "surface_below_rooms": (rooms > 0) & (surface / F.nullif(rooms, F.lit(0)) < limits.least_per_room_m2),
    }
    impossible = F.lit(False)
    for rule in bad.values():
        impossible = impossible | F.coalesce(rule, F.lit(False))
    noted = sales.withColumn("_impossible", impossible)
    noted = noted.withColumns({"corrected_surface_m2": F.when(~F.col("_impossible"), surface)})
    noted = noted.withColumn("corrected_price_m2", price_per_m2("valeur_fonciere", "corrected_surface_m2"))
    bounds = fences(noted, ["type_local"], "corrected_price_m2")
    fenced = noted.join(bounds.withColumnRenamed("type_local", "_type"), F.col("type_local").eqNullSafe(F.col("_type")), "left")
    log_price = F.ln(F.when(F.col("corrected_price_m2") > 0, F.col("corrected_price_m2")))
    rejects = {
        "no_date": F.col("date_mutation").isNull(),
        "no_value": F.coalesce(F.col("valeur_fonciere") <= 0, F.lit(True)),
        "no_commune": F.col("code_commune").isNull(),
        "price_outlier": (log_price < F.col("low_fence")) | (log_price > F.col("high_fence")),
    }
    return judged(fenced, rejects, bad).drop("_impossible", "_type", "low_fence", "high_fence")


def separated(df: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write a judged table once, partitioned by ``accepted``, and return its accepted and its rejected rows."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"quarantine-{uuid.uuid4().hex}")
    df.write.mode("overwrite").partitionBy("accepted").parquet(path)
    both = spark.read.schema(df.schema).parquet(path)
    return both.where(F.col("accepted")).drop("accepted", "reasons"), both.where(~F.col("accepted")).drop("accepted")
