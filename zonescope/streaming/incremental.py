"""Incremental ingestion of the sales drop folder (ST1).

A Structured Streaming file source watches the drop folder for file names (the
contents are not read by it); each file is processed once (the checkpoint
records it).  Every micro-batch, in ``foreachBatch``:

1. reads its files with the batch ingestion's own reader and metadata (headers
   in any order, missing columns, missing-value markers: one row builder for
   both) and writes them to bronze under
   ``snapshot_date=<d>/_run=<r>/_batch=<epoch>``;
2. writes its typed rows to the silver fact under
   ``_run=<r>/month_key=<m>/_batch=<epoch>``.  An epoch only ever writes its own
   partitions, so a replay replaces exactly its own rows and a crash at any
   point loses no earlier ones;
3. finds the months it touched (late sales simply reopen their month; the list
   is bounded by the calendar, not by the data) and recomputes the monthly mart
   for those months from all of the run's silver rows, overwriting only their
   ``month_key`` partitions.  A batch costs what its months hold;
4. compacts the touched months that rest on more than ``MOST_EPOCHS`` epochs
   (:func:`compact`), so a month's files stay bounded however often it is
   reopened.

``_run`` is the id that the stream's checkpoint carries.  A stream started with
a new checkpoint reads every file again and is a run of its own: the mart then
rests on that run's rows alone, so nothing is counted twice.

No watermark is needed: a month is recomputed whenever a sale for it arrives.
``trigger(availableNow=True)`` processes everything present, then stops.
"""

from __future__ import annotations

import datetime as dt
import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonescope.functions.columns import month_start
from zonescope.operators.monthly import zone_month_prices
from zonescope.operators.staging import sales_fact, stg_sales
from zonescope.session import Scratch, ensure_checkpoint_dir, scratch_path
from zonescope.sources.files import SourceFile, read_source_files, with_metadata, with_raw_columns
from zonescope.sources.specs import DEFAULT_SPECS, DatasetSpec


#: Epochs that a month's silver rows may rest on before they are merged.
MOST_EPOCHS = 8
#: Rows of one compacted file.
ROWS_PER_FILE = 5_000_000
#: Codec of bronze and silver, which hold every sale several times over: row ids alone take twice the room under the default.
CODEC = "zstd"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _marker_folder(silver_path: str, run: str) -> str:
    return posixpath.join(silver_path, "_compactions", f"run={run}")


def _mark(spark: SparkSession, silver_path: str, run: str, month: str, upto: int) -> None:
    """Put the marker of a compaction: one empty file, created at once or not at all.  From here on readers take the merged rows."""
    fs, path = _file_system(spark, posixpath.join(_marker_folder(silver_path, run), f"{month}.{upto}"))
    fs.create(path, True).close()


def compactions(spark: SparkSession, silver_path: str, run: str) -> dict[str, int]:
    """Month -> the last epoch that its merged rows hold (at most one entry per calendar month)."""
    fs, folder = _file_system(spark, _marker_folder(silver_path, run))
    found: dict[str, int] = {}
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        month, _, upto = status.getPath().getName().rpartition(".")
        found[month] = max(found.get(month, -1), int(upto))
    return found


def _merged_batch(upto: int) -> int:
    """The ``_batch`` of rows merged up to and with epoch ``upto``: below zero, so it never meets an epoch's."""
    return -1 - upto


def valid_silver(spark: SparkSession, silver_path: str, schema, run: str) -> DataFrame:
    """A run's silver rows: of each month the rows of its last marked compaction and of the epochs after it.

    Rows of a compaction without a marker (a crash before it) and of epochs
    that a compaction holds already are passed over, so every row counts once
    at any moment.
    """
    silver = spark.read.schema(schema).parquet(silver_path).where(F.col("_run") == run)
    marked = compactions(spark, silver_path, run)
    valid: Column = F.col("_batch") >= 0
    if marked:
        months = F.create_map(*[F.lit(x) for item in marked.items() for x in item])
        upto = F.try_element_at(months, F.coalesce(F.col("month_key").cast("string"), F.lit(NO_MONTH)))
        valid = F.when(upto.isNull(), valid).otherwise((F.col("_batch") > upto) | (F.col("_batch") == -1 - upto))
    return silver.where(valid)


def compact(spark: SparkSession, silver_path: str, schema, run: str, months: list, most_epochs: int = MOST_EPOCHS) -> list[str]:
    """Merge the rows of each given month that rests on more than ``most_epochs`` epochs; returns those months.

    1. the valid rows are written under a ``_batch`` of their own, spread by
       size: a large month gets several files, a small one a single file;
    2. a marker makes them the month's rows (:func:`valid_silver`);
    3. what they replace is deleted.

    A crash before 2 leaves rows that no reader takes and the next call
    overwrites; a crash before 3 leaves files that no reader takes and the next
    call deletes.  An epoch that is replayed after it was merged writes rows
    that are passed over: they are in the merged rows.
    """
    rows = valid_silver(spark, silver_path, schema, run)
    wanted = [m for m in months if m is not None]
    touched = F.col("month_key").isin(wanted) if wanted else F.lit(False)
    if len(wanted) < len(months):
        touched = touched | F.col("month_key").isNull()
    # One row per month: how many epochs (or merged ones) its rows rest on, and the last.
    rests = rows.where(touched).groupBy("month_key").agg(F.count_distinct("_batch").alias("n"), F.max("_batch").alias("last")).collect()
    marked = compactions(spark, silver_path, run)
    done = []
    for r in rests:
        if r["n"] <= most_epochs:
            continue
        name = str(r["month_key"]) if r["month_key"] is not None else NO_MONTH
        own = rows.where(F.col("month_key").eqNullSafe(F.lit(r["month_key"]).cast("date")))
        merged = own.withColumn("_batch", F.lit(_merged_batch(r["last"])).cast(schema["_batch"].dataType))
        (merged.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", ROWS_PER_FILE)
         .option("compression", CODEC).partitionBy("_run", "month_key", "_batch").parquet(silver_path))
        _mark(spark, silver_path, run, name, r["last"])
        marked[name] = r["last"]
        done.append(name)
    for name, upto in marked.items():
        _delete_merged(spark, silver_path, run, name, upto)
    return done


def _delete_merged(spark: SparkSession, silver_path: str, run: str, month: str, upto: int) -> None:
    """Delete a month's partitions that its compaction up to ``upto`` replaces, and older markers."""
    fs, folder = _file_system(spark, posixpath.join(silver_path, f"_run={run}", f"month_key={month}"))
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        batch = int(status.getPath().getName().partition("=")[2])
        if batch <= upto and batch != _merged_batch(upto):
            fs.delete(status.getPath(), True)
    fs, folder = _file_system(spark, _marker_folder(silver_path, run))
    for status in fs.listStatus(folder):
        name, _, epoch = status.getPath().getName().rpartition(".")
        if name == month and int(epoch) < upto:
            fs.delete(status.getPath(), False)


def process_batch(
    spark: SparkSession,
    files: DataFrame,
    epoch: int,
    spec: DatasetSpec,
    external_root: str,
    bronze_path: str,
    mart_path: str,
    snapshot_date: str,
    silver_path: str | None = None,
    run: str = "0",
    most_epochs: int = MOST_EPOCHS,
) -> None:
    """Ingest the files (``path``, ``length``) of one micro-batch of the run ``run``."""
    silver_path = silver_path or posixpath.join(posixpath.dirname(posixpath.dirname(bronze_path)), "silver",
                                                "fact_real_estate_transactions")
    # One row of file metadata each, as many as a trigger admits.
    sources = sorted((SourceFile(r["path"], int(r["length"])) for r in files.collect() if r["length"]),
                     key=lambda f: f.path)
    if not sources:
        return
    ingested_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
    rows = with_metadata(read_source_files(spark, spec, sources, spec.multiline), spec, external_root, snapshot_date,
                         ingested_at)
    own = posixpath.join(bronze_path, f"snapshot_date={snapshot_date}", f"_run={run}", f"_batch={epoch}")
    rows.write.mode("overwrite").option("compression", CODEC).parquet(own)
    written = with_raw_columns(spark.read.schema(rows.schema).parquet(own), spec)
    fact = (sales_fact(stg_sales(written)).withColumn("month_key", month_start("date_mutation"))
            .withColumn("_run", F.lit(run)).withColumn("_batch", F.lit(epoch)))
    (fact.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
     .partitionBy("_run", "month_key", "_batch").parquet(silver_path))
    silver = valid_silver(spark, silver_path, fact.schema, run)
    # The touched months: at most one value per calendar month, so a short list.
    months = [r[0] for r in fact.select("month_key").distinct().collect()]
    dated = [m for m in months if m is not None]
    touched = F.col("month_key").isin(dated) if dated else F.lit(False)
    if len(dated) < len(months):
        touched = touched | F.col("month_key").isNull()   # the unreadable-date group
    affected = silver.where(touched & F.col("zone_id").isNotNull()).drop("month_key", "_run", "_batch")
    scratch = Scratch(spark, "zone-months")
    (zone_month_prices(affected, scratch=scratch, stored=True).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month_key").parquet(mart_path))
    scratch.clear()
    compact(spark, silver_path, fact.schema, run, months, most_epochs)


def start_sales_stream(
    spark: SparkSession,
    external_root: str,
    lake_root: str,
    snapshot_date: str,
    spec: DatasetSpec | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start (availableNow) the incremental sales ingestion; returns the query."""
    spec = spec or DEFAULT_SPECS["dvf_mutations"]
    folder = posixpath.join(external_root, posixpath.dirname(spec.path_glob))
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", posixpath.basename(spec.path_glob))
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(folder).select("path", "length")
    bronze_path = posixpath.join(lake_root, "bronze", spec.name)
    mart_path = posixpath.join(lake_root, "marts", "real_estate_zone_monthly")
    checkpoint = checkpoint or scratch_path(spark, f"streams/{spec.name}")

    ensure_checkpoint_dir(spark)

    def handle(batch: DataFrame, epoch: int) -> None:
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")   # kept by the checkpoint over restarts
        process_batch(spark, batch, epoch, spec, external_root, bronze_path, mart_path, snapshot_date, run=run)

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_monthly_mart(spark: SparkSession, lake_root: str) -> DataFrame:
    """The monthly mart maintained by the stream, in its usual column order."""
    df = spark.read.parquet(posixpath.join(lake_root, "marts", "real_estate_zone_monthly"))
    return df.select(
        "zone_id", "month_key", "commune_label", "transaction_count", "median_price_m2_bati",
        "median_price_m2_terrain", "avg_price_m2_bati", "stddev_price_m2_bati",
    )
