"""End-to-end batch run (Q3, K4): ingest -> raw -> staging -> marts -> tests.

Every mart is written as a Parquet table under ``<lake_root>/marts`` and read
back by the next model, so each stage starts from a materialised table (cut
lineage, restartable) and the score stage reads small aggregated inputs.
Staging stays lazy: Catalyst inlines it into the mart that reads it.
"""

from __future__ import annotations

import posixpath
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonescope.operators import features as feat
from zonescope.operators import quality, scoring
from zonescope.operators.monthly import zone_month_prices
from zonescope.operators.staging import sales_fact, stage_all
from zonescope.plans.materialize import TableStore
from zonescope.session import Scratch
from zonescope.sources.files import ingest_dataset, load_raw
from zonescope.sources.specs import DEFAULT_SPECS, DatasetSpec

MART_NAMES = (
    "fact_real_estate_transactions",
    "real_estate_zone_monthly",
    "tourism_zone_features",
    "location_tourism_score_latest",
)


class DataTestError(Exception):
    """A data test of a run failed; its report is the table ``data_tests``."""


@dataclass
class PipelineResult:
    ingestion: list[dict]
    marts: dict[str, DataFrame] = field(default_factory=dict)
    tests: DataFrame | None = None


def build_marts(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    store: TableStore,
    exact_median: bool = True,
    per_zone_latest: bool = False,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Staging (lazy) and the four marts (written, then read back)."""
    staged = stage_all(raw)

    def sales_side():
        fact = store.materialize(sales_fact(staged["dvf_mutations"]), "fact_real_estate_transactions")
        scratch = Scratch(spark, "zone-months")
        monthly = store.materialize(zone_month_prices(fact, exact=exact_median, scratch=scratch), "real_estate_zone_monthly")
        scratch.clear()
        return fact, monthly

    # The sales marts and the feature mart are independent: run them as concurrent jobs.
    with ThreadPoolExecutor(max_workers=2) as pool:
        sales_job = pool.submit(sales_side)
        features_job = pool.submit(lambda: store.materialize(feat.zone_features(staged), "tourism_zone_features"))
        (fact, monthly), features = sales_job.result(), features_job.result()
    scores = store.materialize(
        scoring.zone_scores(monthly, features, per_zone_latest=per_zone_latest), "location_tourism_score_latest"
    )
    marts = {
        "fact_real_estate_transactions": fact,
        "real_estate_zone_monthly": monthly,
        "tourism_zone_features": features,
        "location_tourism_score_latest": scores,
    }
    return staged, marts


def run_tests(staged: dict[str, DataFrame], marts: dict[str, DataFrame]) -> DataFrame:
    tables = {
        "stg_dvf_transactions": staged["dvf_mutations"],
        "stg_tourism_poi": staged["tourism_poi"],
        "stg_tourism_labels": staged["tourism_labels"],
        "stg_mobility_access": staged["mobility_access"],
        **marts,
    }
    return quality.not_null_report(tables)


def run_pipeline(
    spark: SparkSession,
    external_root: str,
    lake_root: str,
    snapshot_date: str | None = None,
    specs: dict[str, DatasetSpec] | None = None,
    latest_snapshot_only: bool = False,
    exact_median: bool = True,
    register_tables: bool = True,
    retries: int = 1,
    on_test_failure: str = "raise",
) -> PipelineResult:
    """Run the whole batch; returns the ingestion summary, marts and test report.

    A failed run is retried ``retries`` times: every write overwrites its own
    snapshot partition or table, so a second attempt never duplicates data.

    A failed data test raises :class:`DataTestError` after the report is written;
    ``on_test_failure="report"`` leaves it to the report.
    """
    for attempt in range(retries + 1):
        try:
            return _run_once(spark, external_root, lake_root, snapshot_date, specs, latest_snapshot_only,
                             exact_median, register_tables, on_test_failure)
        except (FileNotFoundError, DataTestError):
            raise                      # a missing required source will not appear on retry
        except Exception:  # noqa: BLE001
            if attempt == retries:
                raise
    raise AssertionError("unreachable")


def _run_once(spark, external_root, lake_root, snapshot_date, specs, latest_snapshot_only, exact_median,
              register_tables, on_test_failure="raise") -> PipelineResult:
    specs = specs or DEFAULT_SPECS
    bronze_root = posixpath.join(lake_root, "bronze")
    summary = [ingest_dataset(spark, spec, external_root, bronze_root, snapshot_date) for spec in specs.values()]
    raw = load_raw(spark, specs, bronze_root, latest_snapshot_only)
    store = TableStore(spark, posixpath.join(lake_root, "marts"))
    staged, marts = build_marts(spark, raw, store, exact_median=exact_median)
    tests = store.materialize(run_tests(staged, marts), "data_tests")
    failed = [f"{r['model']}.{r['column_name']} ({r['failing']} rows)" for r in tests.where(~F.col("passed")).collect()]
    if failed and on_test_failure == "raise":  # the report has one row per rule
        raise DataTestError("data tests failed: " + ", ".join(failed))
    if register_tables:
        for name, df in marts.items():
            df.createOrReplaceTempView(name)
    return PipelineResult(summary, marts, tests)
