"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z
lower-cased; it is kept as a 128-bit digest.  :class:`LineRuns` holds every
digest seen so far once, in runs: tables bucketed by the digest and sorted in
each bucket.  A new batch is merge-anti-joined with the runs (both sides have
the same buckets, so the runs are neither moved nor aggregated); what is left
is the batch's own run, and digests that the runs hold already go to a small
log of repeats.  When a level has ``fan_in`` runs they are merged into one run
of the next level, so a batch meets about ``fan_in * log(batches)`` runs.

Which lines go is settled by merging the repeats with the runs; the decisions
are dealt back to their documents, whose texts move once.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonescope.llm.common import arrow_map, byte_texts, discard, id_and_text, stored
from zonescope.session import scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 6
FAN_IN = 3

#: What a run holds of a digest: the documents that had it in its batch and the largest id among them.
RUN_COLUMNS = ("key", "n_docs", "holder")


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The digest of a line's key; None for keys of fewer than ``min_chars`` code points."""
    key = line.strip().lower()  # of bytes: exactly [\x20\x09-\x0D] and A-Z
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def line_digests(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key): the distinct digests of each row's lines; rows without id or text have none."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, keys = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch), strict=True):
                if doc is not None:
                    own = {line_key(line, min_chars) for line in text.split(b"\n")} - {None}
                    ids += [doc] * len(own)
                    keys += own
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "key"])

        return step

    return arrow_map(docs, "doc_id long, key binary", make)


class LineRuns:
    """Digests of all batches added so far, in levelled sorted runs on shared storage."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark = spark
        self.fan_in = fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.repeats: list[DataFrame] = []

    @property
    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _sorted(self, df: DataFrame) -> str:
        """Write rows as a table bucketed and sorted by the digest: one file a bucket."""
        name = f"zonescope_lines_{uuid.uuid4().hex}"
        dealt = df.select(*RUN_COLUMNS).repartition(self.buckets, "key")
        dealt.write.bucketBy(self.buckets, "key").sortBy("key").option("path", scratch_path(self.spark, f"llm/{name}")).saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        """Forget a table and delete its files."""
        self.spark.sql(f"drop table if exists {name}")
        gone = self.spark.range(0)
        gone._stored_path = scratch_path(self.spark, f"llm/{name}")
        discard(gone)

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (doc_id, key) rows, distinct, of documents that no earlier batch held."""
        own = self._sorted(lines.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("holder")))
        if not self.runs:
            self._push(own, 0)
            return
        batch = self.spark.table(own)
        fresh = reduce(lambda left, run: left.join(self.spark.table(run).hint("merge"), "key", "left_anti"), self.runs, batch)
        name = self._sorted(fresh)
        repeats = batch.join(self.spark.table(name).hint("merge"), "key", "left_anti")
        self.repeats.append(stored(repeats, "line-repeats"))
        self._drop(own)
        self._push(name, 0)

    def _push(self, name: str, level: int) -> None:
        """Put a run on a level; a full level becomes one run of the next (its runs share no digest)."""
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) < self.fan_in:
            return
        full, self.levels[level] = self.levels[level], []
        merged = self._sorted(reduce(DataFrame.unionByName, map(self.spark.table, full)))
        for old in full:
            self._drop(old)
        self._push(merged, level + 1)

    def settle(self, min_docs: int) -> DataFrame:
        """(key, holder): digests that at least ``min_docs`` documents of all batches hold, and the largest of their ids."""
        schema = "key binary, n_docs long, holder long"
        log = reduce(DataFrame.unionByName, self.repeats) if self.repeats else self.spark.createDataFrame([], schema)
        again = self._sorted(log.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder")))
        later = self.spark.table(again).select("key", F.col("n_docs").alias("_more"), F.col("holder").alias("_later"))
        found = []
        for run in self.runs:
            both = self.spark.table(run).join(later.hint("merge"), "key", "left")
            total = F.col("n_docs") + F.coalesce("_more", F.lit(0))
            found.append(both.where(total >= min_docs).select("key", F.greatest("holder", "_later").alias("holder")))
        out = stored(reduce(DataFrame.unionByName, found), "line-settled")
        self._drop(again)
        return out

    def close(self) -> None:
        """Delete all runs and repeats."""
        for name in self.runs:
            self._drop(name)
        for table in self.repeats:
            discard(table)
        self.levels, self.repeats = [], []


def drop_repeated_lines(
    df: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fan_in: int = FAN_IN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Texts without lines that stand in at least ``min_docs`` documents, except in the document with the largest id.

    Returns one row per row of ``df``: doc_id, text (the other lines, joined by
    ``\\n``), n_lines (before dropping) and n_dropped.  Lines are compared by
    their keys (white space at the ends cut, A-Z lower-cased); keys of fewer
    than ``min_chars`` code points always stay.  A document that holds a key
    several times counts once and loses (or keeps) all those lines.

    Null and empty texts are one empty line.  Rows that share an id count as
    one document and each keep or lose their lines alike; rows without an id
    are neither counted nor cut.  Other columns, whatever their names, never
    reach the operator.  A line that a third of all documents hold is counted
    per task first; its decisions are joined as a skewed join that adaptive
    execution splits.
    """
    docs = id_and_text(df, id_col, text_col)
    digests = line_digests(docs, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    lines = stored(digests, "line-digests")
    store = LineRuns(df.sparkSession, fan_in)
    for number in range(batches):
        store.add(lines.where(F.col("batch") == number).select("doc_id", "key").distinct())
    settled = store.settle(min_docs)
    gone = lines.join(settled, "key").where(F.col("doc_id") != F.col("holder"))
    gone = stored(gone.groupBy("doc_id").agg(F.collect_set("key").alias("gone")), "line-decisions")
    store.close()
    discard(lines)
    discard(settled)
    return _cut(docs.join(gone, "doc_id", "left"), min_chars)


def _cut(docs: DataFrame, min_chars: int) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept_texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(byte_texts(batch), batch.column("gone").to_pylist(), strict=True):
                lines = text.split(b"\n")
                kept = lines
                if gone:
                    drop = set(gone)
                    kept = [line for line in lines if line_key(line, min_chars) not in drop]
                kept_texts.append(b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            columns = [batch.column("doc_id"), pa.array(kept_texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_lines", "n_dropped"])

        return step

    return arrow_map(docs, "doc_id long, text string, n_lines long, n_dropped long", make)
