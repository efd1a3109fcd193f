"""Data-quality checks.

Each rule is a column expression counted in ONE aggregate pass over its table
(partial aggregation per task, one row at the end); the report is the union of
those one-row results, so nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (model, column) pairs that must never be NULL.
NOT_NULL_RULES = (
    ("stg_dvf_transactions", "transaction_id"),
    ("stg_tourism_poi", "code_commune"),
    ("stg_tourism_labels", "code_commune"),
    ("stg_mobility_access", "code_commune"),
    ("fact_real_estate_transactions", "transaction_id"),
    ("tourism_zone_features", "zone_id"),
    ("location_tourism_score_latest", "zone_id"),
)


def not_null_report(tables: dict[str, DataFrame], derived: dict[str, tuple[str, dict[str, str]]] | None = None) -> DataFrame:
    """``not_null`` tests on the staging and mart tables (Q1, Q2).

    One aggregate pass per model, whatever its number of rules.  ``derived``
    names models that are mere projections of another and not yet written
    (name -> that model and each column's source): their rules are counted in
    that model's pass, so its rows are not parsed once more.
    """
    derived = derived or {}
    by_model: dict[str, list] = {}
    for model, column in NOT_NULL_RULES:
        if model in tables:
            by_model.setdefault(derived[model][0] if model in derived else model, []).append((model, column))
    frames = []
    for name, rules in by_model.items():
        df = tables[name]
        sources = [c if model == name else derived[model][1][c] for model, c in rules]
        counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                        *[F.count_if(F.col(c).isNull()).alias(f"_f{i}") for i, c in enumerate(sources)])
        items = F.array(*[
            F.struct(F.lit(model).alias("model"), F.lit("not_null").alias("rule"), F.lit(c).alias("column_name"),
                     F.col(f"_f{i}").alias("failing"))
            for i, (model, c) in enumerate(rules)
        ])
        frames.append(counts.select(F.col("_rows").alias("row_count"), F.inline(items)))
    out = reduce(DataFrame.unionByName, frames)
    return out.select("model", "rule", "column_name", "row_count", "failing", (F.col("failing") == 0).alias("passed"))

