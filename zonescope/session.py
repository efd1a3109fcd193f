"""Spark session helpers.

On a cluster the session is created by the platform and only read here.  The
builder below is for local runs and tests: it sets only what is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: HotSpot compiles no method of more bytecode; a fused stage beyond that would be interpreted, several times slower.
HUGE_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTECODE = "8000"


def keep_methods_compiled(spark: SparkSession) -> None:
    """Let Spark run a stage operator by operator where its one fused method would be too long for the JIT.  A value that is set wins."""
    if spark.conf.get(HUGE_METHOD_LIMIT, None) is None:
        spark.conf.set(HUGE_METHOD_LIMIT, COMPILED_BYTECODE)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "zonescope") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("ZONESCOPE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  When it is unset, a local session gets
    a fresh scratch folder; any other is refused, as executors would not share it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions expose no SparkContext
        context = None
    if not configured and context is not None:
        configured = context.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if context is not None and context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context is None or not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="zonescope-ckpt-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/zonescope/{name}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Intermediate tables of one computation under the shared checkpoint folder, deleted together by :meth:`clear`.

    Clear it only when nothing reads the computation's result lazily any more
    (its rows have been written elsewhere or collected).
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, f"{label}-{uuid.uuid4().hex}")
        self._count = 0

    def written(self, df: DataFrame) -> DataFrame:
        """Write and read back: lineage is cut, and every later reader sees the same rows."""
        self._count += 1
        path = f"{self.root}/{self._count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        delete_path(self.spark, self.root)
