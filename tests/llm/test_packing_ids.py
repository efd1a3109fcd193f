"""Ids of packed pieces against the vocabulary's own library, added tokens included; columns that clash; many groups."""

import random

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from zonescope.llm import packing
from zonescope.llm.queries import spark_queries

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def texts():
    rnd = random.Random(4)
    words = ["the", "Straße", " ", "  ", "\n", "<|endoftext|>", "<|endoftext", "|>", "été", "x" * 40, "日本", "it's", "12345"]
    out = ["<|endoftext|> b", "a<|endoftext|>", "<|endoftext|><|endoftext|>", "a <|endoftext|>  b", "", None, " " * 9, "word " * 3000, "<|endoftext|>" * 1500]
    return [(i, t) for i, t in enumerate(out + ["".join(rnd.choices(words, k=rnd.choice([1, 8, 60]))) for _ in range(120)])] + [(7, "repeated row"), (7, "repeated row"), (None, "no id")]


def expected(rows):
    library = tokenizers.Tokenizer.from_file(JSON)
    return [(doc, library.encode(text or "", add_special_tokens=False).ids + [2]) for doc, text in rows]


def test_ids_equal_the_library(spark):
    rows = texts()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, ids int, start string")
    got = packing.pieces(df, RANKS, public_tokenizers.PATTERN, added=packing.added_tokens(JSON)).collect()
    joined = {}
    for r in sorted((r for r in got if r.doc_id not in (None, 7)), key=lambda r: (r.doc_id, r.piece)):
        assert r.length <= 1024 and r.start == len(joined.setdefault(r.doc_id, []))
        joined[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    want = expected(rows)
    assert joined == {doc: ids for doc, ids in want if doc not in (None, 7)}
    assert sum(r.length for r in got) == sum(len(ids) for _, ids in want)


def test_packing_query(spark, workdir):
    rows = texts()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{workdir}/documents.parquet")
    got = spark_queries()["op6_packing"](spark, workdir).collect()
    ids = {doc: i for doc, i in expected(rows) if doc not in (None, 7)}
    sequences = {}
    for r in got:
        if r.doc_id in ids:
            part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
            import zlib

            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 1024
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 1024) + 2


@pytest.mark.parametrize("group_bins", [160_000, 40])
def test_many_groups_against_the_bound(spark, group_bins):
    items = spark.range(6000).select("id", (F.pmod(F.xxhash64("id"), F.lit(500)) + 1).alias("length"))
    rows = packing.pack(items, group_items=100, fan_in=4, group_bins=group_bins).collect()
    assert len(rows) == 6000
    ends = {}
    for r in rows:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in ends.values():
        placed.sort()
        assert placed[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(placed, placed[1:], strict=False)) and sum(n for _, n in placed) <= 1024
    bound = -(-sum(r.length for r in rows) // 1024)
    assert len(ends) <= bound * (1.02 if group_bins > 1000 else 1.05)


def test_clashing_columns(spark):
    items = spark.createDataFrame([(1, 700, "a", 5, 9, 1), (2, 300, "b", 6, 9, 2), (3, 1024, None, 7, 9, 3)], "doc_id int, length int, bin string, fill int, offset int, child int")
    got = {r.doc_id: r for r in packing.pack(items).collect()}
    assert [(got[i].bin, got[i].fill, got[i].child) for i in (1, 2, 3)] == [("a", 5, 1), ("b", 6, 2), (None, 7, 3)]
    assert got[1].sequence_id == got[2].sequence_id != got[3].sequence_id and {got[1].offset, got[2].offset} == {0, 700}
    with pytest.raises(ValueError, match="_bin"):
        packing.pack(items.withColumn("_bin", F.lit(1)))
