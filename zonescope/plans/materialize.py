"""Materialised marts (K4).

Marts are written as Parquet tables and read back, the way they are meant to
be consumed: the score stage then reads two small aggregated tables instead
of re-deriving them from the raw inputs, and a lost executor never forces the
heavy upstream aggregation to run again (the write cuts the lineage).  Tables
go under the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from zonescope.session import scratch_path


class TableStore:
    """Writes and reads back the tables of one pipeline run."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or scratch_path(spark, f"run-{uuid.uuid4().hex[:12]}")).rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        return self.path(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        self.write(df, name)
        return self.read(name)
