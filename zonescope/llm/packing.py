"""Best-fit packing by hierarchical residuals.

Items (pieces of tokenised documents) are dealt by hash to groups of bounded
size; each group is packed best-fit decreasing on its own.  Nearly full bins
are final.  All underfull bins go up as items: they are dealt to ``fan_in`` times
fewer groups and packed by best fit again, until one group is left or further
merging would put more than ``group_bins`` bins into a task.  Nothing is
dropped: every item ends in exactly one bin.

Results: a null text is the empty text and still holds the closing id;
repeated rows are packed as separate items; very long texts are cut into
pieces; items of one size are interchangeable (ties go by row order); an empty
table gives an empty result.  Every level is a written table, so bin numbers never change when an
executor is lost.
"""

from __future__ import annotations

import base64
import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonescope.llm.bpe import _LOOSE_SPACE
from zonescope.llm.common import Memo, arrow_map, broadcast_bytes, discard, id_and_text, ship, stored, texts, worker_table

CAPACITY = 1024
#: A bin filled to this share is final at once.
NEARLY_FULL = 0.98
GROUP_ITEMS = 50_000
FAN_IN = 8
#: Underfull bins that one task packs again.
GROUP_BINS = 160_000
#: Names that :func:`pack` uses itself.
RESERVED = ("_size", "_group", "_bin", "_offset", "_fill")


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing: bin and offset of each item, and the fill of each bin.

    A bitmap of residuals in use gives the tightest bin that fits by find-first-set.
    """
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins, offsets, fills = 0, [0] * len(sizes), [0] * len(sizes), []
    for i in order:
        size = sizes[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, fills


class _Tokens:
    """Texts to packed ids by the rank form of a byte-level vocabulary; cut at added tokens, then at clean spaces, cut parts remembered."""

    def __init__(self, data: bytes, pattern: str, added: dict[str, int]):
        self.added = {text: np.array([i], "<u4").tobytes() for text, i in added.items()}
        longest_first = sorted(map(re.escape, added), key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(longest_first)})") if added else None
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.plain = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.spaced = Memo(lambda chunk: self._cut(" " + chunk))

    def forget(self) -> None:
        self.spaced.clear()

    def _cut(self, text: str) -> bytes:
        return np.array(self.plain(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.marks is None or not self.marks.search(text):
            return self._plain(text)
        return b"".join(self.added[part] if i % 2 else self._plain(part) for i, part in enumerate(self.marks.split(text)))

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if _LOOSE_SPACE.search(text):
            return self._cut(text)
        head, *rest = text.split(" ")
        return self._cut(head) + b"".join(map(self.spaced.__getitem__, rest))


def added_tokens(vocabulary_path: str) -> dict[str, int]:
    """The added tokens of a vocabulary in JSON form: text -> id.  The library reads them inside texts, special or not."""
    with open(vocabulary_path, encoding="utf-8") as handle:
        return {token["content"]: token["id"] for token in json.load(handle)["added_tokens"]}


def pieces(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    added: dict[str, int] | None = None,
) -> DataFrame:
    """Tokenise, close each document with ``end_id`` and cut those longer than ``capacity``.

    One row per piece: doc_id, piece, start, length, ids (packed little-endian
    unsigned 32-bit).  All pieces of a cut document are ``capacity`` long but
    the first, which takes the rest.  ``ranks_path`` is the rank form of the
    vocabulary and ``added`` its added tokens (:func:`added_tokens`), at which
    texts are cut first: ids are those that the vocabulary's own library gives
    without closing tokens of its own.  Other columns never reach the operator.
    """
    added = added or {}
    vocabulary = broadcast_bytes(df.sparkSession, ranks_path)
    closing = np.array([end_id], "<u4").tobytes()

    def make():
        key = (hash(vocabulary.value), pattern, tuple(added.items()))
        tokens = worker_table(("packing", *key), lambda: _Tokens(vocabulary.value, pattern, added))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            docs, numbers, starts, lengths, ids = [], [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                data = tokens.encode(text) + closing
                n = len(data) >> 2
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for number, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    docs.append(doc)
                    numbers.append(number)
                    starts.append(a)
                    lengths.append(b - a)
                    ids.append(data[4 * a : 4 * b])
            return pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

        return step

    return arrow_map(id_and_text(df, id_col, text_col), "doc_id long, piece int, start long, length long, ids binary", make)


def _packer(level: int, capacity: int):
    def pack_group(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bins, offsets, fills = best_fit(frame["_size"].tolist(), capacity)
        base = level << 56 | int(key[0]) << 32
        fills = np.asarray(fills, "int64")
        bins = np.asarray(bins, "int64")
        return frame.assign(_bin=base + bins, _offset=np.asarray(offsets, "int64"), _fill=fills[bins] if len(bins) else fills)

    return pack_group


def _packer_up(level: int, capacity: int):
    inner = _packer(level, capacity)

    def pack_group(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return inner(key, frame.sort_values("child"))[["child", "_group", "_bin", "_offset", "_fill"]]

    return pack_group


def _open_bins(placed: DataFrame, enough: int) -> DataFrame:
    """(child, _size): the underfull bins."""
    return placed.where(F.col("_fill") < enough).groupBy(F.col("_bin").alias("child")).agg(F.max("_fill").alias("_size"))


def pack(items: DataFrame, length_col: str = "length", capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, fan_in: int = FAN_IN, group_bins: int = GROUP_BINS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every item; items of one sequence lie gapless from 0.

    An item longer than ``capacity`` is an error; one of length 0 or null takes
    no room.  Columns of these two names in the input are replaced, the names
    in ``RESERVED`` are an error, all other columns are carried along.
    """
    clashes = [c for c in items.columns if c in RESERVED]
    if clashes:
        raise ValueError(f"columns {clashes} have names used by pack()")
    spark = items.sparkSession
    ship(spark)
    items = stored(items.drop("sequence_id", "offset").withColumn("_size", F.coalesce(F.col(length_col).cast("long"), F.lit(0))), "pack-items")
    count, longest = items.agg(F.count(F.when(F.col("_size") < capacity, 1)), F.max("_size")).first()
    if longest is not None and longest > capacity:
        raise ValueError(f"an item of {longest} is longer than {capacity}")
    groups = max(1, -(-count // group_items))
    keys = [c for c in items.columns if c != "ids"]
    dealt = items.withColumn("_group", F.pmod(F.xxhash64(*keys, F.monotonically_increasing_id()), F.lit(groups)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    whole = dealt.where(F.col("_size") == capacity).withColumns(
        {"_bin": F.lit(127 << 56) + F.monotonically_increasing_id(), "_offset": F.lit(0).cast("long"), "_fill": F.lit(capacity).cast("long")})
    packed = dealt.where(F.col("_size") < capacity).groupBy("_group").applyInPandas(_packer(0, capacity), fields + ", _bin long, _offset long, _fill long")
    placed = stored(whole.unionByName(packed), "pack-0")
    discard(items)
    enough = int(capacity * NEARLY_FULL)
    open_bins = _open_bins(placed, enough)
    result, level = placed.drop("_group", "_fill", "_size"), 0
    while groups > 1:
        level += 1
        fewer = max(-(-groups // fan_in), -(-open_bins.count() // group_bins))
        last, groups = fewer >= groups, min(fewer, groups)
        rising = open_bins.withColumn("_group", F.pmod(F.xxhash64("child", F.lit(level)), F.lit(groups)))
        step = rising.groupBy("_group").applyInPandas(_packer_up(level, capacity), "child long, _group long, _bin long, _offset long, _fill long")
        step = stored(step, f"pack-{level}")
        result = (
            result.join(step.select(F.col("child").alias("_bin"), F.col("_bin").alias("_parent"), F.col("_offset").alias("_shift")), "_bin", "left")
            .withColumn("_offset", F.col("_offset") + F.coalesce("_shift", F.lit(0)))
            .withColumn("_bin", F.coalesce("_parent", "_bin"))
            .drop("_parent", "_shift")
        )
        open_bins = _open_bins(step, enough)
        if last:  # merging further would overfill a task
            break
    return result.withColumnsRenamed({"_bin": "sequence_id", "_offset": "offset"})
