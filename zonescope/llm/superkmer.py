"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document.  Its minimiser is
the least hash among its runs of ``MINIMISER`` words; consecutive windows that
share a minimiser travel as one packed string (a super-k-mer) to the
minimiser's bucket, those of one batch and bucket compressed together.  In a bucket the windows of the packed strings are sorted,
and equal neighbours give the smallest document that holds a window.  Every
word covered by a window that also starts in a document with a smaller id is
removed; windows are judged on the input.

Minimisers that would fill a planned bucket by themselves are found first by a
bounded count (every task hands on only minimisers that make up a share of
``HOT_SHARE / 2`` of what it has read, so at most ``4 / HOT_SHARE`` are hot), and
buckets over ``BUCKET_ROWS`` are noticed while they are read.  Both are judged
by an exact way that spreads them: distinct packed strings, a partial minimum
per window, and joins back.

Results: a null text has no words; texts shorter than a window lose nothing; a
null id neither loses words nor is a witness; rows sharing an id are judged
each by its own text and are no witnesses for each other; repeated rows stay;
an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonescope.llm.common import arrow_map, byte_texts, ship, stored
from zonescope.llm.minmax_hash import shingle_hashes, word_hashes

WINDOW = 13
MINIMISER = 3
#: A run of windows is cut after so many, so that a packed string is short.
RUN = 128
HOT_SHARE = 1 / 2000
#: A bucket is planned to hold an eighth of this, and spread if it holds more.
BUCKET_ROWS = 1_000_000
MIN_BUCKETS = 128


def runs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimisers, first windows and ends of the super-k-mers of a document with at least one window."""
    grams = shingle_hashes(word_hashes(words), MINIMISER)
    span, windows = WINDOW - MINIMISER + 1, len(words) - WINDOW + 1
    least, width = grams, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = span - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.append(starts[1:], windows)
    if (ends - starts).max() > RUN:
        cut = [(s, min(s + RUN, e)) for a, e in zip(starts.tolist(), ends.tolist(), strict=True) for s in range(a, e, RUN)]
        starts, ends = np.array([s for s, _ in cut]), np.array([e for _, e in cut])
    return least[starts].view(np.int64), starts, ends


def text_key(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - 2**63


def hot_minimisers(docs: DataFrame) -> tuple[list[int], int]:
    """Minimisers with more super-k-mers than a planned bucket and a share of ``HOT_SHARE / 2`` of all (a bounded list), and the number of all."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = [runs(w)[0] for w in (t.split() for t in byte_texts(batch)) if len(w) >= WINDOW]
        if not found:
            return None
        keys, counts = np.unique(np.concatenate(found), return_counts=True)
        total = counts.sum()
        often = counts >= max(8, total * HOT_SHARE / 2)
        keys, counts = np.append(keys[often], 0), np.append(counts[often], total)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts), pa.array([False] * (len(keys) - 1) + [True])], names=["mini", "n", "total"])

    counted = arrow_map(docs, "mini long, n long, total boolean", lambda: step).groupBy("mini", "total").agg(F.sum("n").alias("n"))
    counted = stored(counted, "hot-counts")
    total = counted.where("total").agg(F.sum("n")).first()[0] or 0
    hot = counted.where(~F.col("total") & (F.col("n") >= F.lit(max(BUCKET_ROWS // 8, total * HOT_SHARE / 2)))).select("mini")
    return [row[0] for row in hot.limit(int(4 / HOT_SHARE)).toLocalIterator()], total


class Parcel:
    """Super-k-mers on their way to one bucket: numbers as arrays, packed strings line by line, compressed together."""

    @staticmethod
    def pack(docs: np.ndarray, keys: np.ndarray, owner: np.ndarray, starts: np.ndarray, minis: np.ndarray, rows: list[bytes]) -> bytes:
        used, owner = np.unique(owner, return_inverse=True)
        steps = np.diff(owner, prepend=0)
        head = np.array([len(used), len(rows)], "<u4")
        numbers = (head, docs[used].astype("<i8"), keys[used].astype("<i8"), steps.astype("<i4"), starts.astype("<i4"), minis.astype("<u4"))
        return b"".join([*(x.tobytes() for x in numbers), b"\n".join(rows)])

    @staticmethod
    def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Document, text key, start, minimiser and packed string of every super-k-mer."""
        n_docs, n = np.frombuffer(data, "<u4", 2).tolist()
        docs, keys = np.frombuffer(data, "<i8", 2 * n_docs, 8).reshape(2, n_docs)
        steps, starts, minis = np.frombuffer(data, "<u4", 3 * n, 8 + 16 * n_docs).reshape(3, n)
        owner = np.cumsum(steps.view("<i4"))
        return docs[owner], keys[owner], starts.view("<i4"), minis, data[8 + 16 * n_docs + 12 * n :].split(b"\n")


def _super_kmers(docs: DataFrame, hot: list[int], buckets: int) -> DataFrame:
    """(bucket, parcel): a batch's super-k-mers by the bucket of their minimiser.

    Those of hot minimisers go to further buckets by their packed string.
    """
    hot_minis = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(hot, np.int64)))

    def make():
        compress, crowded = zstandard.ZstdCompressor(level=3).compress, hot_minis.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            ids, keys, owner, starts_, minis_, rows = [], [], [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch), strict=True):
                words = text.split()
                if len(words) < WINDOW:
                    continue
                minis, starts, ends = runs(words)
                line = b" ".join(words)
                at = np.zeros(len(words) + 1, np.int64)
                np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
                rows += [line[a : b - 1] for a, b in zip(at[starts].tolist(), at[ends + WINDOW - 1].tolist(), strict=True)]
                owner.append(np.full(len(starts), len(ids)))
                ids.append(doc)
                keys.append(text_key(text))
                starts_.append(starts)
                minis_.append(minis)
            if not ids:
                return None
            minis, owner, starts, ids, keys = np.concatenate(minis_), np.concatenate(owner), np.concatenate(starts_), np.array(ids), np.array(keys)
            bucket = (minis.view(np.uint64) >> np.uint64(33)).astype(np.int64) % buckets
            for i in np.flatnonzero(np.isin(minis, crowded)).tolist() if len(crowded) else ():
                bucket[i] = buckets + xxhash.xxh3_64_intdigest(rows[i]) % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0])).tolist() + [len(order)]
            numbers, parcels = [], []
            for a, b in zip(cuts, cuts[1:], strict=False):
                some = order[a:b]
                numbers.append(int(bucket[some[0]]))
                parcels.append(compress(Parcel.pack(ids, keys, owner[some], starts[some], minis[some].view(np.uint64) & np.uint64(2**32 - 1), [rows[i] for i in some.tolist()])))
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(parcels, pa.binary())], names=["bucket", "parcel"])

        return step

    return arrow_map(docs, "bucket int, parcel binary", make)


def windows_of(packed: bytes) -> list[bytes]:
    """The windows of a packed string."""
    words = packed.split()
    if len(words) == WINDOW:
        return [packed]
    return [b" ".join(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1)]


class _Spans:
    """Rows of a bucket task: spans to remove, and rows passed on to the way for large buckets."""

    def __init__(self):
        self.rows: list[tuple] = []

    def remove(self, row: tuple, late: list[int]) -> None:
        """``late``: the windows of a super-k-mer, counted from its first, that a smaller document holds as well."""
        doc, key, start, _ = row
        first = last = None
        for i in late:
            if first is not None and i > last + WINDOW:
                self.rows.append((doc, key, start + first, start + last + WINDOW, None))
                first = i
            elif first is None:
                first = i
            last = i
        if first is not None:
            self.rows.append((doc, key, start + first, start + last + WINDOW, None))

    def pass_on(self, rows: list[tuple]) -> None:
        self.rows += [(d, k, s, 0, p) for d, k, s, p in rows]

    def judge(self, rows: list[tuple]) -> None:
        """One bucket, whole."""
        if len(rows) < 2:
            return
        lowest: dict[bytes, int] = {}
        for doc, _, _, packed in rows:
            if lowest.get(packed, doc) >= doc:
                lowest[packed] = doc
        if len(lowest) == 1:
            (packed, least), = lowest.items()
            late = list(range(len(packed.split()) - WINDOW + 1))
            for row in rows:
                if row[0] > least:
                    self.remove(row, late)
            return
        if rows[0][0] == max(rows)[0] == min(rows)[0]:
            return
        cut = {packed: windows_of(packed) for packed in lowest}
        entries = sorted((w, doc) for packed, doc in lowest.items() for w in cut[packed])
        holder = {w: next(same)[1] for w, same in groupby(entries, lambda e: e[0])}
        for row in rows:
            self.remove(row, [i for i, w in enumerate(cut[row[3]]) if holder[w] < row[0]])

    def take(self, least: int) -> Iterator[pa.RecordBatch]:
        """What has been found so far, once there are ``least`` rows."""
        if len(self.rows) >= least:
            rows, self.rows = self.rows, []
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            for i in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 20_000], strict=True), kinds, strict=True)], names=["doc_id", "text_key", "start", "end", "packed"])


def _judge_buckets(buckets: int):
    """Buckets arrive one after another; one that grows over BUCKET_ROWS, or holds hot minimisers, is passed on row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        spans, current, parts, size, over = _Spans(), None, [], 0, False
        for batch in batches:
            for bucket, parcel in zip(batch.column("bucket").to_pylist(), batch.column("parcel"), strict=True):
                if bucket != current:
                    _judge_bucket(spans, parts)
                    current, parts, size, over = bucket, [], 0, bucket >= buckets
                parts.append(Parcel.unpack(unpack(parcel.as_py())))
                size += len(parts[-1][0])
                over = over or size > BUCKET_ROWS
                if over:
                    for docs, keys, starts, _, rows in parts:
                        spans.pass_on(list(zip(docs.tolist(), keys.tolist(), starts.tolist(), rows, strict=True)))
                    parts = []
                yield from spans.take(20_000)
        _judge_bucket(spans, parts)
        yield from spans.take(1)

    return run


def _judge_bucket(spans: _Spans, parts: list[tuple]) -> None:
    """Sort a bucket by minimiser and judge the minimisers that two or more super-k-mers share."""
    if not parts:
        return
    docs, keys, starts, minis = (np.concatenate([p[i] for p in parts]) for i in range(4))
    rows = [r for p in parts for r in p[4]]
    order = np.argsort(minis, kind="stable")
    cuts = np.append(np.flatnonzero(np.concatenate([[True], np.diff(minis[order].astype(np.int64)) != 0])), len(order))
    several = np.flatnonzero(np.diff(cuts) > 1)
    for a, b in zip(cuts[several].tolist(), cuts[several + 1].tolist(), strict=True):
        some = order[a:b].tolist()
        spans.judge([(int(docs[i]), int(keys[i]), int(starts[i]), rows[i]) for i in some])


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _spread(rows: DataFrame) -> DataFrame:
    """Spans of the super-k-mers of large buckets, without gathering a bucket."""
    distinct = rows.groupBy("packed").agg(F.min("doc_id").alias("low"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, places, windows, lows = [], [], [], []
        for packed, low in zip(batch.column("packed").to_pylist(), batch.column("low").to_pylist(), strict=True):
            found, key = windows_of(packed), _digest(packed)
            keys += [key] * len(found)
            places += range(len(found))
            windows += map(_digest, found)
            lows += [low] * len(found)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(places, pa.int32()), pa.array(windows, pa.binary()), pa.array(lows, pa.int64())], names=["packed_key", "place", "window", "low"])

    windows = stored(arrow_map(distinct, "packed_key binary, place int, window binary, low long", lambda: cut), "hot-windows")
    holders = stored(windows.groupBy("window").agg(F.min("low").alias("holder"), F.count("*").alias("n")), "hot-holders")
    found = windows.join(holders, "window").groupBy("packed_key").agg(F.sort_array(F.collect_list(F.struct("place", "holder"))).alias("holders"))
    found = stored(found, "hot-found")

    def key_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = pa.array(list(map(_digest, batch.column("packed").to_pylist())), pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(n) for n in ("doc_id", "text_key", "start")] + [keys], names=["doc_id", "text_key", "start", "packed_key"])

    keyed = arrow_map(rows.select("doc_id", "text_key", "start", "packed"), "doc_id long, text_key long, start int, packed_key binary", lambda: key_of)
    late = F.filter("holders", lambda h: h["holder"] < F.col("doc_id"))
    spans = keyed.join(found, "packed_key").select("doc_id", "text_key", "start", F.transform(late, lambda h: h["place"]).alias("late")).where(F.size("late") > 0)
    merged = F.expr(f"""aggregate(late, cast(array() as array<struct<start:int,end:int>>), (a, p) ->
        case when size(a) > 0 and element_at(a, -1).end >= start + p
        then concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', start + p + {WINDOW})))
        else concat(a, array(named_struct('start', start + p, 'end', start + p + {WINDOW}))) end)""")
    return spans.select("doc_id", "text_key", F.explode(merged).alias("s")).select("doc_id", "text_key", "s.start", "s.end")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans): word ranges [start, end) to remove, for the texts that lose any."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.where("doc_id is not null")
    hot, total = hot_minimisers(docs)
    buckets = max(MIN_BUCKETS, -(-total // (BUCKET_ROWS // 8)))
    kmers = _super_kmers(docs, hot, buckets)
    judged = stored(kmers.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_judge_buckets(buckets), "doc_id long, text_key long, start int, end int, packed binary"), "repeat-spans")
    spans = judged.where("packed is null").drop("packed")
    crowded = judged.where("packed is not null")
    if not crowded.isEmpty():
        spans = spans.unionByName(_spread(crowded))
    return spans.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rejoin: bool = True) -> DataFrame:
    """Every input row with its text cut: adds ``n_words``, ``n_removed`` and replaces the text by its kept words.

    Kept words are joined by one space; with ``rejoin=False`` a text that loses
    nothing is left as it is and cut ones keep the white space before each kept word.
    """
    ship(df.sparkSession)
    slim = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    spans = stored(repeated_spans(slim), "repeat-doc-spans")
    others = [c for c in df.columns if c not in ("_z", "_key", "n_words", "n_removed")]
    fields = [df.schema[c] for c in others]

    def make_pack():
        pack = zstandard.ZstdCompressor(level=1).compress

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            data = byte_texts(batch, text_col)
            rest = [n for n in batch.schema.names if n != text_col]
            return pa.RecordBatch.from_arrays([batch.column(n) for n in rest] + [pa.array(list(map(pack, data)), pa.binary()), pa.array(list(map(text_key, data)), pa.int64())], names=[*rest, "_z", "_key"])

        return step

    packed_schema = T.StructType([f for f in fields if f.name != text_col] + [T.StructField("_z", T.BinaryType()), T.StructField("_key", T.LongType())])
    packed = arrow_map(df.select(*others), packed_schema, make_pack)
    marks = spans.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text_key"), F.to_binary(F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"]))), F.lit("utf-8")).alias("_spans"))
    joined = packed.join(marks, (packed[id_col].cast("long") == marks["_doc"]) & (packed["_key"] == marks["_text_key"]), "left").drop("_doc", "_text_key", "_key")

    def make_cut():
        unpack = zstandard.ZstdDecompressor().decompress

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out, n_words, n_removed = [], [], []
            for z, spans_ in zip(batch.column("_z").to_pylist(), batch.column("_spans").to_pylist(), strict=True):
                text = unpack(z)
                words = text.split()
                keep = np.ones(len(words), bool)
                for span in (spans_ or b"").split(b","):
                    if span:
                        a, b = span.split(b"-")
                        keep[int(a) : int(b)] = False
                gone = int(len(keep) - keep.sum())
                n_words.append(len(words))
                n_removed.append(gone)
                out.append(b" ".join([w for w, k in zip(words, keep, strict=True) if k] if gone else words) if rejoin else cut_text(text, keep) if gone else text)
            rest = [n for n in batch.schema.names if n not in ("_z", "_spans")]
            arrays = {n: batch.column(n) for n in rest} | {text_col: pa.array(out, pa.binary()).cast(pa.string()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
            names = [*others, "n_words", "n_removed"]
            return pa.RecordBatch.from_arrays([arrays[n] for n in names], names=names)

        return step

    text_fields = [T.StructField(f.name, T.StringType()) if f.name == text_col else f for f in fields]
    return arrow_map(joined, T.StructType(text_fields + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]), make_cut)


def cut_text(text: bytes, keep: np.ndarray) -> bytes:
    """The text without its dropped words; each kept word keeps the white space before it."""
    import re

    parts = re.findall(rb"([ \t\n\x0b\x0c\r]*)([^ \t\n\x0b\x0c\r]+)", text)
    return b"".join(space + word for (space, word), k in zip(parts, keep, strict=True) if k).strip(b" \t\n\x0b\x0c\r")
