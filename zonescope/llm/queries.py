"""Registered queries of this subpackage: one per operator, with production parameters, over whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonescope.llm import (
    bpe,
    chat_format,
    lang_id,
    license_scan,
    line_runs,
    maxent,
    minmax_hash,
    packing,
    pivot_index,
    quality_rules,
    recompression,
    reversed_search,
    superkmer,
)
from zonescope.llm.common import crc_bucket, id_and_text, stored
from zonescope.llm.oracle import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = id_and_text(_read(spark, sf_dir, "documents"))
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode(encoded, path)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_vectors(_read(spark, sf_dir, "embeddings"))


def op3_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_hash.near_duplicates(_read(spark, sf_dir, "documents"), width=2)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = stored(quality_rules.features(docs).drop("text"), "quality-features")
    cutoffs = stored(quality_rules.fit_cutoffs(measured, _read(spark, sf_dir, "labels")), "quality-cutoffs")
    judged = quality_rules.judge(measured, cutoffs)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = superkmer.remove_repeats(id_and_text(_read(spark, sf_dir, "documents")))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pieces(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added=added)
    slim = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(slim).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(_read(spark, sf_dir, "documents"), crc_bucket(F.col("doc_id"), 7) == 2)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_read(spark, sf_dir, "documents"))


def op9_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(crc_bucket(F.col("doc_id"), 5) == 0, F.lit(False)))
    model = lang_id.fit(docs.where("not held_out"), public_tokenizers.path("piece_bpe_32k.model"))
    return lang_id.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"select * from values (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') as t(conv_id, turn, role, text)")
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(extra)))


def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_runs.drop_repeated_lines(_read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def planted_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's planted runs: a document whose id's crc32 ends in 0 repeats a stretch from word ``a`` to its end (fixed rule)."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def op13_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.periodic_runs(_read(spark, sf_dir, "documents"), rewrite=planted_repeats)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_pivot_index": op2_pivot_index,
    "op3_minmax_dedup": op3_minmax_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_superkmer_dedup": op5_superkmer_dedup,
    "op6_packing": op6_packing,
    "op7_maxent": op7_maxent,
    "op8_license_scan": op8_license_scan,
    "op9_lang_id": op9_lang_id,
    "op10_chat_format": op10_chat_format,
    "op11_reversed_search": op11_reversed_search,
    "op12_line_runs": op12_line_runs,
    "op13_recompression": op13_recompression,
}


def spark_queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_queries() -> dict[str, str]:
    return dict(ORACLES)
