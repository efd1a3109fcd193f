"""Embedding near-dedup by a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest pivots out of a few reference
points.  Inverted lists hold the vectors by pivot; two vectors are candidates
when they share at least ``SHARED`` pivots, and candidates are verified by
their cosine in double precision.  Pivots are picked from a bounded sample
(``SAMPLE_PER_PIVOT`` distinct vectors per pivot, lowest hashes first),
skipping points close to one picked before, so a large group of copies does
not use them up; every vector is indexed.  Their number grows with the square
root of the vectors, up to ``MAX_PIVOTS``.

Equal vectors collapse to one class first.  A list is worked off in pairs of
blocks of bounded size; only verified links leave a task, each found in one
list only (that of the lowest shared pivot).

Results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; only vectors of one length are compared; rows
that repeat an id and vector count once but keep a row each; a null id links
with nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonescope.llm.blocks import block_pairs
from zonescope.llm.common import arrow_map, ship, stored
from zonescope.llm.components import components

COSINE = 0.9
NEAREST = 8
SHARED = 2
MIN_PIVOTS, MAX_PIVOTS = 48, 4096
SAMPLE_PER_PIVOT = 8
#: A sampled vector this close (cosine) to a picked pivot is not picked.
APART = 0.6
BLOCK = 1024
MAX_LENGTHS = 64


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dim, vec): usable vectors as packed doubles."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, dims, packed = [], [], []
        for key, values in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist(), strict=True):
            if key is None or not values or None in values:
                continue
            v = np.array(values, "<f8")
            if np.isfinite(v).all() and v.any():
                ids.append(key)
                dims.append(len(v))
                packed.append((v + 0.0).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())], names=["vec_id", "dim", "vec"])

    slim = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("v"))
    return arrow_map(slim, "vec_id long, dim int, vec binary", lambda: step)


def _matrix(packed, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<f8").reshape(-1, dim)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def choose_pivots(classes: DataFrame, dim: int, count: int) -> np.ndarray:
    wanted = min(MAX_PIVOTS, max(MIN_PIVOTS, math.isqrt(count)))
    sample = classes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(wanted * SAMPLE_PER_PIVOT).collect()
    points = _unit(_matrix([r[0] for r in sample], dim))
    closest, picked = np.full(len(points), -1.0), []
    for i in range(len(points)):
        if closest[i] < APART and len(picked) < wanted:
            picked.append(i)
            closest = np.maximum(closest, points @ points[i])
    return points[picked]


def _described(classes: DataFrame, pivots, dim: int, nearest: int) -> DataFrame:
    """Add ``near``: the vector's nearest pivots, nearest first."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = pivots.value
        close = _unit(_matrix(batch.column("vec").to_pylist(), dim)) @ points.T
        near = np.argsort(-close, axis=1, kind="stable")[:, :nearest].astype(np.int32)
        return pa.RecordBatch.from_arrays([batch.column(n) for n in ("rep", "n", "vec")] + [pa.array(near.tolist(), pa.list_(pa.int32()))], names=["rep", "n", "vec", "near"])

    return arrow_map(classes.select("rep", "n", "vec"), "rep long, n long, vec binary, near array<int>", lambda: step)


def _verify(dim: int, cosine: float, shared: int):
    def unit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """Links of one pair of blocks of one pivot's list."""
        pivot, i, j = key
        own = frame[frame["_own"] == i]
        other = own if i == j else frame[frame["_own"] == j]
        if not len(own) or not len(other):
            return pd.DataFrame({"a": np.zeros(0, "int64"), "b": np.zeros(0, "int64")})
        listed = np.unique(np.concatenate([np.concatenate(own["near"].to_numpy()), np.concatenate(other["near"].to_numpy())]))

        def marks(part: pd.DataFrame) -> np.ndarray:
            near = np.stack(part["near"].to_numpy())
            out = np.zeros((len(part), len(listed)), np.float32)
            np.put_along_axis(out, np.searchsorted(listed, near), 1, axis=1)
            return out

        x, y = marks(own), marks(other)
        before = int(np.searchsorted(listed, pivot))
        may = (x @ y.T >= min(shared, len(listed))) & (x[:, :before] @ y[:, :before].T == 0)
        u, v = _matrix(own["vec"], dim), _matrix(other["vec"], dim)
        u, v = u / np.abs(u).max(axis=1, keepdims=True), v / np.abs(v).max(axis=1, keepdims=True)
        found = may & (u @ v.T / (np.linalg.norm(u, axis=1)[:, None] * np.linalg.norm(v, axis=1)) >= cosine)
        a, b = np.nonzero(found)
        a, b = own["rep"].to_numpy()[a], other["rep"].to_numpy()[b]
        if i == j:
            a, b = a[a < b], b[a < b]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return unit


def class_links(classes: DataFrame, dim: int, cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """(a, b), a < b: linked classes of distinct vectors of one length."""
    spark = classes.sparkSession
    count = classes.count()
    pivots = choose_pivots(classes, dim, count)
    described = stored(_described(classes, spark.sparkContext.broadcast(pivots), dim, nearest), "pivot-described")
    lists = described.select(F.explode("near").alias("pivot"), "rep", "near", "vec")
    units = block_pairs(lists, "pivot", "rep", BLOCK)
    return units.groupBy("pivot", "_i", "_j").applyInPandas(_verify(dim, cosine, min(shared, len(pivots))), "a long, b long")


def near_vectors(df: DataFrame, cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    ship(df.sparkSession)
    vectors = stored(_vectors(df, id_col, vector_col).distinct(), "pivot-vectors")
    classes = stored(vectors.groupBy("dim", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "pivot-classes")
    dims = [r[0] for r in classes.select("dim").distinct().limit(MAX_LENGTHS + 1).collect()]
    if len(dims) > MAX_LENGTHS:
        raise ValueError(f"vectors of over {MAX_LENGTHS} lengths")
    links = None
    for dim in sorted(dims):
        found = class_links(classes.where(F.col("dim") == dim), dim, cosine, nearest, shared)
        links = found if links is None else links.unionByName(found)
    ids = df.select(df[id_col].cast("long").alias("vec_id"))
    if links is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = stored(links, "pivot-links")
    members = vectors.join(classes, ["dim", "vec"]).select("vec_id", "rep", "n")
    members = stored(members, "pivot-members")
    sizes = classes.select("rep", "n")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    outside = both.join(sizes.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("n").alias("outside"))
    per_class = stored(outside.withColumnRenamed("a", "rep"), "pivot-degrees")
    degree = members.join(per_class, "rep", "left").groupBy("vec_id").agg(F.sum(F.col("n") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"))
    copies = members.where("vec_id != rep").select(F.col("rep").alias("a"), F.col("vec_id").alias("b"))
    comps = components(links.unionByName(copies))
    out = ids.join(degree, "vec_id", "left").join(comps.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
