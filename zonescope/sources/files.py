"""Drop-folder ingestion: files -> bronze -> raw.

* Files are listed by Spark itself (``binaryFile`` source, content column
  never read), so listing works on any cluster file system; hidden files
  (``.``/``_``) are skipped by Spark and zero-byte files are dropped here.
* CSV files are grouped by header: reading several files with different column
  orders in one ``csv()`` call would map columns by position, so each group
  of identical headers is read with its own all-text schema and the groups
  are stacked by name (missing columns -> NULL).  One job over all files
  finds the headers and the files whose quoted cells hold line breaks; only
  those are read unsplit.
* Rows with more or fewer cells than their header are kept (missing cells ->
  NULL) and counted; the summary reports them.
* Bronze is all text plus four metadata columns (and grid cells for datasets
  with coordinates), written as Parquet partitioned by ``snapshot_date``;
  re-ingesting a snapshot replaces that snapshot only.
"""

from __future__ import annotations

import csv
import datetime as dt
import fnmatch
import posixpath
import re
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonescope.constants import METADATA_COLUMNS
from zonescope.functions.columns import grid_cell, missing_to_null, normalize_column_names, to_double
from zonescope.sources.specs import GRID_COLUMNS, GRID_DATASETS, DatasetSpec

SUPPORTED_FORMATS = ("csv", "parquet")


class TornRowsError(ValueError):
    """Rows of a delivery have another number of cells than their header."""


@dataclass(frozen=True)
class SourceFile:
    path: str
    size: int


def _dir_and_pattern(root: str, path_glob: str) -> tuple[str, str]:
    full = posixpath.join(root.rstrip("/"), path_glob)
    return posixpath.dirname(full), posixpath.basename(full)


def discover_files(spark: SparkSession, root: str, path_glob: str) -> list[SourceFile]:
    """Non-empty, non-hidden files of one folder matching the glob's last part."""
    folder, pattern = _dir_and_pattern(root, path_glob)
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "false")
            .load(folder)
            .select("path", "length")
            .where(F.col("length") > 0)
        )
        rows = listing.collect()  # file metadata only (one row per file)
    except Exception as exc:  # noqa: BLE001 - a missing folder means "no files"
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return []
        raise
    files = [SourceFile(r["path"], int(r["length"])) for r in rows]
    files = [f for f in files if not posixpath.basename(f.path).startswith(".")
             and fnmatch.fnmatch(posixpath.basename(f.path), pattern)]
    return sorted(files, key=lambda f: f.path)


def _csv_reader(spark: SparkSession, spec: DatasetSpec, multiline: bool):
    return (
        spark.read.option("header", True)
        .option("sep", spec.delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
    )


def _header(spark: SparkSession, spec: DatasetSpec, path: str) -> tuple[str, ...]:
    # Reading the header only: without schema inference Spark takes the first
    # record of the file and nothing else.
    return tuple(_csv_reader(spark, spec, True).csv(path).columns)


def _plain_path(path: str) -> str:
    """A path without scheme and leading slashes, to match the same file under two spellings."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", path).lstrip("/")


@dataclass(frozen=True)
class CsvShape:
    """What must be known of a CSV file before it is read: its column names, and whether a quoted cell holds a line break."""

    header: tuple[str, ...]
    spans_lines: bool


def csv_shapes(spark: SparkSession, spec: DatasetSpec, paths: list[str]) -> dict[str, CsvShape]:
    """The shape of every file, found in one job over their lines.

    The header is the first line that is not blank.  A line with an odd number
    of quotes opens a cell that the next line goes on with.  Both are partial
    aggregates: one row per file reaches the driver.  Only a header that is
    itself odd (line breaks, empty or repeated names) is read again on its own.
    """
    value = F.col("value")
    lines = spark.read.text(paths).where(F.trim(value) != "").select(
        F.col("_metadata.file_path").alias("path"), value,
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("at"),
        (F.length(F.regexp_replace(value, '[^"]', "")) % 2 == 1).alias("odd"))
    found = lines.groupBy("path").agg(F.min_by("value", "at").alias("first"), F.max("odd").alias("odd")).collect()
    by_path = {_plain_path(unquote(r["path"])): r for r in found}
    shapes = {}
    for path in paths:
        row = by_path.get(_plain_path(path))
        names = tuple(next(csv.reader([row["first"]], delimiter=spec.delimiter))) if row and row["first"].count('"') % 2 == 0 else ()
        if not all(names) or len(set(names)) < len(names) or not names:
            names = _header(spark, spec, path)
        shapes[path] = CsvShape(names, bool(row and row["odd"]))
    return shapes


def read_source_files(
    spark: SparkSession, spec: DatasetSpec, files: list[SourceFile], multiline: bool | None = None
) -> DataFrame:
    """Read a dataset's files as text columns with normalised names.

    ``multiline`` says whether quoted cells may hold line breaks (None: found
    out per file).  Beside the columns: ``_file_path``, and ``_torn`` for rows whose number of cells is not the header's.
    """
    if spec.format not in SUPPORTED_FORMATS:
        raise ValueError(f"unsupported format {spec.format!r} for dataset {spec.name!r}")
    paths = [f.path for f in files]
    frames = []
    if spec.format == "parquet":
        df = spark.read.option("mergeSchema", True).parquet(*paths)
        df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns], "_metadata.file_path", F.lit(False))
        frames.append(df.toDF(*normalize_column_names(df.columns[:-2]), "_file_path", "_torn"))
    else:
        groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
        for path, shape in csv_shapes(spark, spec, paths).items():
            groups.setdefault((shape.header, shape.spans_lines if multiline is None else multiline), []).append(path)
        for (header, spanning), group in groups.items():
            schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(header))] + [T.StructField("_broken", T.StringType(), True)])
            reader = _csv_reader(spark, spec, spanning).option("columnNameOfCorruptRecord", "_broken")
            df = reader.schema(schema).option("enforceSchema", True).csv(group)
            df = df.select(*[missing_to_null(c).alias(c) for c in df.columns[:-1]], "_metadata.file_path", F.col("_broken").isNotNull())
            frames.append(df.toDF(*normalize_column_names(header), "_file_path", "_torn"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def relative_source(path: Column, root: str) -> Column:
    """A file's path below ``root``: scheme and host are dropped and the escapes of a URI undone on both sides."""
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    base = re.sub(scheme, "", root).rstrip("/") + "/"
    plain = F.url_decode(F.replace(F.regexp_replace(path, scheme, ""), F.lit("+"), F.lit("%2B")))
    return F.when(F.startswith(plain, F.lit(base)), F.substring(plain, len(base) + 1, 1 << 30)).otherwise(plain)


def with_metadata(df: DataFrame, spec: DatasetSpec, root: str, snapshot_date: str, ingested_at: str) -> DataFrame:
    """Append ``_dataset_name``, ``_source_file``, ``_snapshot_date``, ``_ingested_at``
    and grid cells when both coordinates are present (U1)."""
    relative = relative_source(F.col("_file_path"), root)
    out = df.select(
        *[c for c in df.columns if c not in ("_file_path", "_torn")],
        F.lit(spec.name).alias("_dataset_name"),
        relative.alias("_source_file"),
        F.lit(snapshot_date).alias("_snapshot_date"),
        F.lit(ingested_at).alias("_ingested_at"),
    )
    if {"latitude", "longitude"} <= set(out.columns):
        lat, lon = to_double("latitude"), to_double("longitude")
        out = out.withColumn("h3_res8", grid_cell(lat, lon, 8)).withColumn("h3_res9", grid_cell(lat, lon, 9))
    return out


def empty_raw(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """An absent optional dataset: no rows, expected + metadata columns."""
    return spark.createDataFrame([], spec.raw_schema())


def ingest_dataset(
    spark: SparkSession,
    spec: DatasetSpec,
    external_root: str,
    bronze_root: str,
    snapshot_date: str | None = None,
    multiline: bool | None = None,
    fail_on_torn: bool = False,
) -> dict:
    """Files of one dataset -> bronze Parquet under ``snapshot_date=`` (K1, K2, K5).

    Returns a summary: dataset, file count, rows written, torn rows (another
    number of cells than the header).  With ``fail_on_torn`` torn rows are an
    error, raised when the snapshot has been written: it can be looked at, and
    the next ingestion of the snapshot replaces it.
    """
    snapshot_date = snapshot_date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")
    multiline = spec.multiline if multiline is None else multiline
    files = discover_files(spark, external_root, spec.path_glob)
    if not files:
        if spec.required:
            raise FileNotFoundError(
                f"required dataset {spec.name!r} has no file matching {spec.path_glob!r} under {external_root}"
            )
        return {"dataset": spec.name, "files": 0, "rows": 0, "torn": 0}
    ingested_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
    observed = Observation(f"ingest_{spec.name}")
    rows = read_source_files(spark, spec, files, multiline).observe(
        observed, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_torn")).alias("torn"))
    df = with_metadata(rows, spec, external_root, snapshot_date, ingested_at).withColumn("snapshot_date", F.lit(snapshot_date))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(posixpath.join(bronze_root, spec.name))
    )
    counts = observed.get
    if fail_on_torn and counts["torn"]:
        raise TornRowsError(f"dataset {spec.name!r}, snapshot {snapshot_date}: {counts['torn']} of {counts['rows']} rows have another number of cells than their header")
    return {"dataset": spec.name, "files": len(files), "rows": int(counts["rows"]), "torn": int(counts["torn"])}


def read_bronze(
    spark: SparkSession, spec: DatasetSpec, bronze_root: str, latest_snapshot_only: bool = False
) -> DataFrame:
    """All snapshots of a dataset, stacked by name (S8, U0); expected columns
    that no file had are added as NULL text; absent optional dataset -> empty (S6, S7)."""
    path = posixpath.join(bronze_root, spec.name)
    try:
        df = spark.read.option("mergeSchema", True).parquet(path)
    except Exception as exc:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(exc) and "Unable to infer schema" not in str(exc) \
                and "UNABLE_TO_INFER_SCHEMA" not in str(exc):
            raise
        if spec.required:
            raise FileNotFoundError(f"no bronze data for required dataset {spec.name!r}") from exc
        df = empty_raw(spark, spec)
    if latest_snapshot_only and "snapshot_date" in df.columns:
        # A literal lets Spark prune the scan to the latest snapshot's partition.
        latest = df.agg(F.max("snapshot_date")).first()[0]
        df = df.where(F.col("snapshot_date") == F.lit(latest))
    return with_raw_columns(df.drop("snapshot_date"), spec)


def with_raw_columns(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Expected, grid and metadata columns that no file had, added as NULL text."""
    wanted = [*spec.expected_columns, *(GRID_COLUMNS if spec.name in GRID_DATASETS else ()), *METADATA_COLUMNS]
    for column in wanted:
        if column not in df.columns:
            df = df.withColumn(column, F.lit(None).cast("string"))
    return df


def load_raw(
    spark: SparkSession, specs: dict[str, DatasetSpec], bronze_root: str, latest_snapshot_only: bool = False
) -> dict[str, DataFrame]:
    """Raw layer: one DataFrame per dataset, also registered as ``raw_<table>``."""
    raw = {}
    for name, spec in specs.items():
        raw[name] = read_bronze(spark, spec, bronze_root, latest_snapshot_only)
        raw[name].createOrReplaceTempView(f"raw_{spec.table}")
    return raw


def write_raw(df: DataFrame, path: str, mode: str = "replace") -> None:
    """Persist a raw table; ``replace`` overwrites, ``append`` adds rows (K3)."""
    if mode not in ("replace", "append"):
        raise ValueError("mode must be 'replace' or 'append'")
    df.write.mode("overwrite" if mode == "replace" else "append").parquet(path)


def write_raw_jdbc(df: DataFrame, url: str, table: str, mode: str = "replace", properties: dict | None = None,
                   batchsize: int = 5000) -> None:
    """Raw table in a relational database through Spark's JDBC sink, in
    multi-row batches of ``batchsize`` (K3).  Not exercised by the tests: no
    database is started in this environment."""
    if mode not in ("replace", "append"):
        raise ValueError("mode must be 'replace' or 'append'")
    props = {"batchsize": str(batchsize), **(properties or {})}
    df.write.jdbc(url, table, mode="overwrite" if mode == "replace" else "append", properties=props)


def ingest_counts(raw: DataFrame) -> DataFrame:
    """Rows per dataset and source file (K5)."""
    return raw.groupBy("_dataset_name", "_source_file").agg(F.count(F.lit(1)).alias("row_count"))
