"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct ``width``-word shingles (the whole
sequence when it has fewer words; nothing without words).  Under each of
``PERMUTATIONS`` hash functions both the least and the greatest value are
kept, so half the hash evaluations give a signature of twice the length whose
entries agree with probability equal to the Jaccard similarity.  Signatures
are cut into bands of ``BAND`` values; documents sharing a band are candidates.

Linear work per band: exact copies of a set collapse first, then each member
of a band is compared with the band's smallest member.  Only bands whose
members still lie in different components are looked at again: the documents
they tie together form a group, worked off in pairs of blocks of bounded size,
and only links leave a task.  Every link is confirmed on the full shingle sets
of both texts, and no pair between different components that shares a band is
skipped.

Results: null or empty texts link with nothing; a null id links with nothing
and has a null component; rows sharing an id are one node but keep a row each;
an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonescope.llm.blocks import block_pairs
from zonescope.llm.common import Memo, arrow_map, byte_texts, discard, id_and_text, ship, stored, worker_table
from zonescope.llm.components import components

PERMUTATIONS = 80
BAND = 5
#: Similarity as a fraction: numerator, denominator.
SIMILARITY = (80, 100)
#: Pairs whose signatures agree in a smaller share are not compared in full (over five standard errors under 0.8).
LEAST_AGREEMENT = 0.6
BLOCK = 512
#: Bits of the bitmap that keeps texts out of a shuffle.
MARKS = 1 << 26
_ROWS = 2048

_seeds = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, size=(2, PERMUTATIONS), dtype=np.uint64)
FACTORS, OFFSETS = _seeds[0] * np.uint64(2) + np.uint64(1), _seeds[1]
MIX = np.uint64(0x9E3779B97F4A7C15)

def word_hashes(words: list[bytes]) -> np.ndarray:
    known = worker_table(("word hashes",), lambda: Memo(xxhash.xxh3_64_intdigest))
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` words, or of the whole sequence if it is shorter."""
    n = min(width, len(hashes))
    if not n:
        return hashes
    count = len(hashes) - n + 1
    out = np.full(count, np.uint64(n))
    for j in range(n):
        out = (out ^ hashes[j : j + count]) * MIX
        out ^= out >> np.uint64(31)
    return out


def shingle_set(text: bytes, width: int) -> set:
    words = text.lower().split()
    if len(words) <= width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width)), strict=False))


def signature(unique: np.ndarray) -> np.ndarray:
    """Least and greatest value per permutation, as 32-bit numbers."""
    low, high = np.full(PERMUTATIONS, 2**32 - 1, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for i in range(0, len(unique), _ROWS):
        values = ((unique[i : i + _ROWS, None] * FACTORS + OFFSETS) >> np.uint64(32)).astype(np.uint32)
        low, high = np.minimum(low, values.min(axis=0)), np.maximum(high, values.max(axis=0))
    return np.concatenate([low, high])


def bands(sig: np.ndarray) -> list[int]:
    """A 64-bit hash of the number and values of every band of a signature."""
    values = sig.astype(np.uint64).reshape(-1, BAND)
    out = np.arange(1, len(values) + 1, dtype=np.uint64)
    for j in range(BAND):
        out = (out ^ values[:, j]) * MIX
        out ^= out >> np.uint64(29)
    return out.view(np.int64).tolist()


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_key (16 bytes, null for an empty set), bands, per row of (doc_id, text)."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, cut = [], [], []
        for text in byte_texts(batch):
            unique = np.unique(shingle_hashes(word_hashes(text.lower().split()), width))
            sizes.append(len(unique))
            keys.append(hashlib.blake2b(unique.tobytes(), digest_size=16).digest() if len(unique) else None)
            cut.append(bands(signature(unique)) if len(unique) else None)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(cut, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_key", "bands"])

    return arrow_map(docs, "doc_id long, n_shingles long, set_key binary, bands array<bigint>", lambda: step)


def _marks(ids: DataFrame) -> bytes:
    """A bitmap of ``MARKS`` bits with the bits of the ids' hashes set: its size doesn't depend on how many there are."""
    number = ids.select((F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)) + 1).alias("bit"))  # buckets count from 1
    rows = number.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = bytearray(MARKS >> 3)
    for row in rows.toLocalIterator():
        at = (row["bucket"] - 1) * len(row["bits"])
        out[at : at + len(row["bits"])] = row["bits"]
    return bytes(out)


def _packed(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of the documents in ``ids`` (distinct doc_id), compressed before they are shuffled.

    A bitmap of the ids keeps most other texts out of the shuffle of the join, which alone decides.
    """
    marks = docs.sparkSession.sparkContext.broadcast(_marks(ids))

    def make():
        pack = zstandard.ZstdCompressor(level=1).compress
        held = np.frombuffer(marks.value, np.uint8)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            bit = batch.column("bit").to_numpy()
            batch = batch.filter(pa.array((held[bit >> 3] >> (bit & 7) & 1).astype(bool)))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(map(pack, byte_texts(batch))), pa.binary())], names=["doc_id", "z"])

        return step

    marked = docs.withColumn("bit", F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)))
    return arrow_map(marked, "doc_id long, z binary", make).join(ids, "doc_id", "left_semi")


def confirmed(pairs: DataFrame, packed: DataFrame, width: int, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    joined = pairs.join(packed.select(F.col("doc_id").alias("a"), F.col("z").alias("za")), "a").join(packed.select(F.col("doc_id").alias("b"), F.col("z").alias("zb")), "b")
    above, below = similarity

    def make():
        unpack = zstandard.ZstdDecompressor().decompress
        sets = Memo(lambda z: shingle_set(unpack(z), width), 64)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            for za, zb in zip(batch.column("za").to_pylist(), batch.column("zb").to_pylist(), strict=True):
                x, y = sets[za], sets[zb]
                common = len(x & y) if below * min(len(x), len(y)) >= above * max(len(x), len(y)) else 0
                keep.append(below * common >= above * (len(x) + len(y) - common) and common > 0)
            return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

        return step

    return arrow_map(joined.select("a", "b", "za", "zb"), "a long, b long", make)


def _full_sets(packed: DataFrame, width: int) -> DataFrame:
    """doc_id and its whole set as sorted 64-bit shingle hashes."""

    def make():
        unpack = zstandard.ZstdDecompressor().decompress

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [np.unique(shingle_hashes(word_hashes(unpack(z).lower().split()), width)).astype("<u8").tobytes() for z in batch.column("z").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])

        return step

    return arrow_map(packed, "doc_id long, shingles binary", make)


def _linked(similarity: tuple[int, int]):
    above, below = similarity
    least = LEAST_AGREEMENT * above / below / (SIMILARITY[0] / SIMILARITY[1])

    def unit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """Links of one unit between different components: by size, then by signature, then on the full sets; one document against many at a time."""
        own = frame[frame["_own"] == key[1]]
        other = own if key[1] == key[2] else frame[frame["_own"] == key[2]]
        found = []
        if len(own) and len(other):
            sets = {id(part): [np.frombuffer(s, "<u8") for s in part["shingles"]] for part in (own, other)}
            marks = {k: np.stack(list(map(signature, v))) for k, v in sets.items()}
            theirs, sig = sets[id(other)], marks[id(other)]
            ids, comps = other["doc_id"].to_numpy(), other["component"].to_numpy()
            sizes = np.array(list(map(len, theirs)))
            for doc, comp, mine, mark in zip(own["doc_id"].tolist(), own["component"].tolist(), sets[id(own)], marks[id(own)], strict=True):
                n = len(mine)
                may = (comps != comp) & (below * np.minimum(sizes, n) >= above * np.maximum(sizes, n))
                if key[1] == key[2]:
                    may &= ids > doc
                at = np.flatnonzero(may)
                at = at[(sig[at] == mark).mean(axis=1) >= least] if len(at) else at
                for i in at.tolist():
                    common = n + len(theirs[i]) - len(np.union1d(mine, theirs[i]))
                    if below * common >= above * (n + len(theirs[i]) - common):
                        found.append((min(doc, int(ids[i])), max(doc, int(ids[i]))))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return unit


def shared_bands(banded: DataFrame) -> DataFrame:
    """band, doc_id, a (the band's smallest doc_id) of the bands with several documents: rows are dealt by band once."""
    members = Window.partitionBy("band")
    led = banded.select("band", "doc_id", F.min("doc_id").over(members).alias("a"), F.max("doc_id").over(members).alias("last"))
    return led.where("a != last").drop("last")


def near_duplicates(df: DataFrame, width: int = 5, similarity: tuple[int, int] = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links) and kept (doc_id = component_id)."""
    ship(df.sparkSession)
    docs = id_and_text(df, id_col, text_col)
    cut = stored(signatures(docs, width), "near-signatures")
    signed = stored(cut.drop("bands"), "near-sizes")
    usable = signed.where("doc_id is not null and set_key is not null")
    first = stored(usable.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "near-classes")
    copies = usable.select("doc_id", "set_key").join(first, "set_key").where("doc_id != rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    reps = cut.join(first.select("set_key", F.col("rep").alias("doc_id")), ["set_key", "doc_id"], "left_semi")
    shared = stored(shared_bands(reps.select("doc_id", F.explode("bands").alias("band"))), "near-shared")
    discard(cut)
    sizes = usable.select("doc_id", "n_shingles").distinct()
    near = shared.where("doc_id != a").select("a", F.col("doc_id").alias("b")).distinct()
    above, below = similarity
    pairs = near.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    pairs = stored(pairs.where(below * F.least("na", "nb") >= above * F.greatest("na", "nb")).select("a", "b"), "near-pairs")
    named = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    packed = stored(_packed(docs, named), "near-texts")
    links = stored(confirmed(pairs, packed, width, similarity).unionByName(copies).distinct(), "near-links")
    for done in (pairs, packed, first):
        discard(done)
    comps = stored(components(links), "near-components")
    # Bands whose members beside the smallest (its comparisons are done) still lie in two components.
    others = shared.where("doc_id != a").select("band", "doc_id").join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    open_ = others.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("doc_id").alias("a")).where("x != y").select("band", "a")
    open_ = stored(open_, "near-open")
    if not open_.isEmpty():
        # Documents that such bands tie together are one group, each document in it once.
        ties = stored(others.join(open_, "band").select("a", F.col("doc_id").alias("b"), "component"), "near-ties")
        groups = components(ties).withColumnsRenamed({"node": "doc_id", "component": "group"})
        placed = stored(ties.select(F.col("b").alias("doc_id"), "component").distinct().join(groups, "doc_id"), "near-placed")
        wanted = placed.select("doc_id").distinct()
        rest = stored(placed.join(_full_sets(_packed(docs, wanted), width), "doc_id"), "near-rest")
        units = block_pairs(rest, "group", "doc_id", BLOCK)
        extra = stored(units.groupBy("group", "_i", "_j").applyInPandas(_linked(similarity), "a long, b long").distinct(), "near-extra")
        for done in (ties, placed, rest):
            discard(done)
        if not extra.isEmpty():
            before, comps = comps, stored(components(links.unionByName(extra)), "near-components")
            discard(before)
        discard(extra)
    for done in (shared, open_, links):
        discard(done)
    out = signed.select("doc_id", "n_shingles").join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
