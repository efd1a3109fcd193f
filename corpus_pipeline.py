"""A corpus pipeline: language, quality, near copies, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.  Each stage's
result is written as Parquet in the shared checkpoint folder and read again.
An empty input gives an empty result; null texts are rejected by the language
stage; repeated rows are handled row by row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonescope.llm import lang_id, minmax_hash, packing, quality_rules, superkmer
from zonescope.llm.common import stored

#: SQL can't express the trained, hashed and packed stages; tests hold them against brute force.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents in no language (no text or no letter).  The model learns from the stage's own labelled rows."""
    model = lang_id.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return lang_id.predict(docs, model).where(F.col("lang_pred") != "und").select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that fail the base rules or a proven threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    key = F.xxhash64("text").alias("_key")
    measured = quality_rules.features(docs.select("doc_id", "text", "lang")).withColumn("_key", key).drop("text")
    measured = stored(measured, "pipeline-quality")
    cutoffs = stored(quality_rules.fit_cutoffs(measured, labels), "pipeline-cutoffs")
    # Judged on the stored counts: a filter over the counting expressions would be planned with each copied many times.
    kept = quality_rules.judge(measured, cutoffs).where("kept").select(F.col("doc_id").alias("_doc"), "_key").distinct()
    keyed = docs.select("*", key)
    same = keyed["doc_id"].eqNullSafe(kept["_doc"]) & (keyed["_key"] == kept["_key"])
    return keyed.join(kept, same, "left_semi").select(*docs.columns)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies (five-word shingles, similarity 0.8)."""
    dropped = minmax_hash.near_duplicates(docs, width=5).where("not kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that a document with a smaller id holds as well; ``n_chars`` follows the text."""
    cut = superkmer.remove_repeats(docs, rejoin=False)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: a row per piece, as in query op6_packing."""
    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added=added)
    slim = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(slim).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language ID", language_stage),
    ("quality rules", quality_stage),
    ("near duplicates", near_copies_stage),
    ("substring dedup", repeated_passages_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
