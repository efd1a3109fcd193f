"""Parquet table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Session setting: number of partitions to deal a fact-sized scan to.  Off unless set.
SCAN_PARTITIONS = "zonescope.scan.partitions"


def spread(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Deal a scan to ``zonescope.scan.partitions`` partitions when that is set.

    For small files written as one row group, which are one input split each.
    Off by default: tables of many splits need no such shuffle.
    """
    partitions = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(partitions)) if partitions else df


def read_table(spark: SparkSession, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
