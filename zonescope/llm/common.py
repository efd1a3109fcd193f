"""Helpers shared by the operators of this subpackage.

Words are maximal runs of bytes outside space, tab, newline, vertical tab,
form feed and carriage return (``[^\\x20\\x09-\\x0D]+``): exactly what
``bytes.split()`` without arguments returns, and ``bytes.lower()`` lower-cases
A-Z only.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonescope.session import scratch_path

#: Bytes that end a word (fixed values): space, tab, newline, vertical tab, form feed, carriage return.
WORD_BREAKS = " \t\n\x0b\x0c\r"
#: Entries that a worker's memo of words or chunks may hold before it is emptied.
MEMO_ENTRIES = 300_000
#: Largest vocabulary or model that is sent to the executors, in bytes.
MAX_BROADCAST_BYTES = 128 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per Spark context (they need not share a folder with the driver)."""
    context = spark.sparkContext
    if getattr(context, "_zonescope_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="zonescope-code-"), f"zonescope-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(target)
    context._zonescope_shipped = True


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage is cut, every later reader sees the same rows."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`stored` that nothing reads any more."""
    path = getattr(df, "_stored_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def broadcast_bytes(spark: SparkSession, path: str):
    """Broadcast a small driver-side file (a public vocabulary); its size is checked."""
    if os.path.getsize(path) > MAX_BROADCAST_BYTES:
        raise ValueError(f"{path} is over {MAX_BROADCAST_BYTES} bytes")
    with open(path, "rb") as handle:
        return spark.sparkContext.broadcast(handle.read())


def arrow_map(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], most_bytes: int = 16 << 20) -> DataFrame:
    """``mapInArrow`` with a function built once per task by ``make``, which gets slices of about ``most_bytes``."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        try:
            for batch in batches:
                for part in slices(batch, most_bytes):
                    out = step(part)
                    if out is not None and out.num_rows:
                        yield out
        finally:
            forget_memos()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about ``most_bytes``; a single longer row stays whole."""
    pieces = max(1, -(-batch.nbytes // most_bytes))
    step = max(1, -(-batch.num_rows // pieces))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null is the empty text."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names (extra or clashing columns never reach it)."""
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))


def crc_bucket(column: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


_TABLE: dict = {}


def worker_table(key: tuple, build: Callable):
    """``build()``, kept in this worker until a table of another key is asked for: tables and memos of earlier operators don't add up.

    Reached as a function of this module, never through a function that is
    pickled: such a copy would have a ``_TABLE`` of its own in every task.
    """
    if key not in _TABLE:
        _TABLE.clear()
        gc.collect()
        _TABLE[key] = build()
    return _TABLE[key]


def forget_memos() -> None:
    """Called when a task ends: the tables stay, what they remembered goes, so that a waiting worker holds little.

    Spark takes waiting workers in turn, and a stage with two Python steps leaves twice as many as there are cores.
    """
    for kept in _TABLE.values():
        if hasattr(kept, "forget"):
            kept.forget()
    pa.default_memory_pool().release_unused()


class Memo(dict):
    """A dictionary that computes missing values and is emptied when it holds ``limit`` entries."""

    def __init__(self, compute: Callable, limit: int = MEMO_ENTRIES):
        super().__init__()
        self.compute = compute
        self.limit = limit

    def forget(self) -> None:
        self.clear()

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value
