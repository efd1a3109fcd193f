"""Exact rank statistics per group, safe against very large groups.

``percentile``/``median``/``percent_rank`` gather a whole group in one task
(a value->count map, or a window partition).  A group holding a third of the
rows would then sit in one task.  Here the same exact results come from
partial aggregates:

**Quantiles** (:func:`exact_quantiles`) of groups of at most ``GATHER_ROWS``
rows come from Spark's own ``percentile``, whose map of one group is bounded by
that.  Larger groups, found by one count, narrow a counted histogram:

1. Values fall into buckets by their logarithm (a few percent wide, in value
   order); per (group, bucket) the count and the least and greatest value are
   kept.  Running counts over a group's buckets (a bounded number) say which
   bucket holds a wanted rank.
2. If the rank is the first or last of its bucket, or the bucket holds one
   distinct value, the answer is the bucket's least or greatest value.
3. The other buckets are cut into ``PARTS`` equal parts between their least and
   greatest value, counted again from the values that lie in them, and so on.
   A bucket's ends fall into different parts, so each round is strictly
   narrower; values are only ever counted, never sorted or gathered.

**Ranks** (:func:`value_ranks`, for percent ranks of every row):

1. count rows per (group, value); partial aggregation collapses duplicates on
   the map side, so even a single hot value costs one row per map task;
2. range-partition the (group, value, count) rows by (group, value): Spark
   samples the keys and cuts a large group into several value ranges, each in
   its own task; every row is tagged with its range index and written to the
   shared checkpoint folder, so that the index is stored data for steps 3-5;
3. inside each (range, group) piece, a window gives the running count;
4. per piece, its total; per group, the pieces' offsets (counts of earlier
   ranges) and the group size ``n``.  This table has at most
   #groups + #ranges rows;
5. join the offsets back: every distinct value knows how many rows of its
   group are strictly below it.

No step holds more than one range of one group; ``percent_rank`` is
``below / (n - 1)``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonescope.session import Scratch, scratch_path

#: Rows of a group that one task may gather; larger groups are narrowed.
GATHER_ROWS = 200_000
#: A list of at most so many groups is broadcast.
SMALL_GROUPS = 50_000
#: Buckets a doubling of the value in the first round, and parts of a bucket in each later one.
BUCKETS_PER_DOUBLING = 16
PARTS = 1024


def _null_stand_in(data_type: T.DataType):
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, T.DateType):
        return F.lit(dt.date(1970, 1, 1))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(dt.datetime(1970, 1, 1)).cast(data_type)
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(data_type)


class _Encoded:
    """Group keys encoded as non-NULL (stand-in, is-null) pairs."""

    def __init__(self, df: DataFrame, keys: list[str]):
        self.keys = keys
        self.types = {f.name: f.dataType for f in df.schema.fields}
        self.cols = []
        self.names: list[str] = []
        for i, k in enumerate(keys):
            self.cols.append(F.coalesce(F.col(k), _null_stand_in(self.types[k])).alias(f"_k{i}"))
            self.cols.append(F.col(k).isNull().alias(f"_n{i}"))
            self.names += [f"_k{i}", f"_n{i}"]
        if not keys:  # one global group
            self.cols.append(F.lit(0).alias("_k"))
            self.names.append("_k")

    def restore(self) -> list:
        return [
            F.when(F.col(f"_n{i}"), F.lit(None).cast(self.types[k])).otherwise(F.col(f"_k{i}")).alias(k)
            for i, k in enumerate(self.keys)
        ]


def _written(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and read back: the range number becomes data, the same for every reader."""
    path = scratch_path(df.sparkSession, f"ranks-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ranked(df: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, _Encoded]:
    enc = _Encoded(df, keys)
    counted = (
        df.select(*enc.cols, F.col(value).cast("double").alias("_v"))
        .where(F.col("_v").isNotNull())
        .groupBy(*enc.names, "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    ranged = _written(counted.repartitionByRange(*enc.names, "_v").withColumn("_p", F.spark_partition_id()))
    piece = ["_p", *enc.names]
    running = Window.partitionBy(*piece).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_cum", F.sum("_c").over(running))
    pieces = local.groupBy(*piece).agg(F.sum("_c").alias("_t"))
    earlier = Window.partitionBy(*enc.names).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *piece,
        F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_off"),
        F.sum("_t").over(Window.partitionBy(*enc.names)).alias("_n"),
    )
    joined = local.join(offsets, piece).select(
        *enc.names, "_v", "_c", (F.col("_off") + F.col("_cum") - F.col("_c")).alias("_below"), "_n"
    )
    return joined, enc


def value_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per (group, distinct non-NULL value): ``value``, ``count`` (rows
    with that value), ``below`` (rows of the group strictly below it), ``n``."""
    joined, enc = _ranked(df, keys, value)
    return joined.select(*enc.restore(), F.col("_v").alias(value), F.col("_c").alias("count"),
                         F.col("_below").alias("below"), F.col("_n").alias("n"))


def _first_bucket(v: Column) -> Column:
    """A bucket number that never falls as ``v`` grows (logarithms are semi-monotonic); infinities and NaN lie at the ends."""
    size = F.floor(F.log2(F.abs(v)) * BUCKETS_PER_DOUBLING) + 2000 * BUCKETS_PER_DOUBLING
    end = 4000 * BUCKETS_PER_DOUBLING
    infinity = F.lit(float("inf"))
    return (F.when(F.isnan(v), end + 1).when(v == infinity, end).when(v == -infinity, -end)
            .when(v > 0, size).when(v < 0, -size).otherwise(0)).cast("int")


def _settled(hist: DataFrame, group: list[str], part: str, ranks: Column, base: Column | int) -> DataFrame:
    """Every wanted rank with its bucket, and its value where the bucket already tells it.

    ``hist`` has one row per (group, part): ``_c``, ``_lo``, ``_hi``.  ``base`` is the number of the group's values before the first part.
    """
    order = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = hist.withColumn("_below", F.sum("_c").over(order) - F.col("_c") + base)
    placed = placed.withColumn("_n", F.sum("_c").over(Window.partitionBy(*group))) if "_n" not in hist.columns else placed
    upto = F.col("_below") + F.col("_c")
    found = placed.withColumn("_rank", F.explode(F.filter(ranks, lambda r: (r >= F.col("_below")) & (r < upto))))
    value = F.when((F.col("_lo") == F.col("_hi")) | (F.col("_rank") == F.col("_below")), F.col("_lo")).when(
        F.col("_rank") == upto - 1, F.col("_hi"))
    return found.withColumn("_value", value)


def large_groups(df: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame | None:
    """The groups with more than ``GATHER_ROWS`` rows (a written table of their keys, to be joined with :func:`of_groups`); None if there are none."""
    enc = _Encoded(df, keys)
    large = df.groupBy(*enc.cols).count().where(F.col("count") > GATHER_ROWS).drop("count")
    table = scratch.written(large)
    size = table.count()
    return None if not size else F.broadcast(table) if size <= SMALL_GROUPS else table


def of_groups(df: DataFrame, keys: list[str], groups: DataFrame, inside: bool = True) -> DataFrame:
    """The rows of ``df`` whose group is (not) in the list; NULL keys are a group."""
    enc = _Encoded(df, keys)
    coded = df.select("*", *enc.cols)
    return coded.join(groups, enc.names, "left_semi" if inside else "left_anti").select(*df.columns)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], scratch: Scratch | None = None,
                    stored: bool = False) -> DataFrame:
    """Per group: one column per name in ``probs`` holding ``percentile_cont(p)``.

    Position ``(n-1)·p`` is interpolated linearly between the values at its
    floor and ceiling ranks.  NULL values are ignored; a group with no value
    is absent.  Large groups are narrowed as the module says, the others
    gathered; both are exact.  The values are written once for that unless
    ``df`` is ``stored`` (cheap to read again).  Intermediate tables go to
    ``scratch``, which the caller clears, or are deleted here; the result is a
    written table either way.
    """
    own = scratch or Scratch(df.sparkSession, "quantiles")
    values = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if not stored:
        values = own.written(values)
    large = large_groups(values, keys, own)
    small = values if large is None else of_groups(values, keys, large, inside=False)
    out = small.groupBy(*keys).agg(*[F.percentile("_v", p).alias(name) for name, p in probs.items()])
    if not keys:
        out = out.where(F.col(next(iter(probs))).isNotNull())
    if large is not None:
        out = out.unionByName(_narrowed(of_groups(values, keys, large), keys, probs, own))
    result = (scratch or Scratch(df.sparkSession, "quantile-results")).written(out)
    if not scratch:
        own.clear()
    return result


def _narrowed(values: DataFrame, keys: list[str], probs: dict[str, float], own: Scratch) -> DataFrame:
    """Quantiles of ``_v`` per group by narrowing a histogram."""
    enc = _Encoded(values, keys)
    values = own.written(values.select(*enc.cols, "_v"))
    counts = [F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    names = enc.names
    state = ["_n", "_rank", "_value", "_below", "_lo", "_hi"]
    positions = [((F.col("_n") - 1).cast("double") * F.lit(float(p))) for p in probs.values()]
    wanted = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in positions])))
    hist = values.groupBy(*names, _first_bucket(F.col("_v")).alias("_part")).agg(*counts)
    rounds = [own.written(_settled(hist, names, "_part", wanted, 0).select(*names, *state))]
    while True:
        open_ranks = rounds[-1].where("_value is null")
        if open_ranks.isEmpty():
            break
        bucket = ["_from", "_to", "_base"]
        buckets = open_ranks.groupBy(*names, F.col("_lo").alias("_from"), F.col("_hi").alias("_to"), F.col("_below").alias("_base")).agg(
            F.max("_n").alias("_n"), F.collect_set("_rank").alias("_ranks"))
        inside = values.join(buckets, names).where(F.col("_v").between(F.col("_from"), F.col("_to")))
        share = (F.col("_v") - F.col("_from")) / (F.col("_to") - F.col("_from")) * PARTS
        part = F.least(F.floor(share), F.lit(PARTS - 1)).cast("int").alias("_part")
        hist = inside.groupBy(*names, *bucket, part).agg(*counts, F.max("_n").alias("_n"), F.first("_ranks").alias("_ranks"))
        rounds.append(own.written(_settled(hist, [*names, *bucket], "_part", F.col("_ranks"), F.col("_base")).select(*names, *state)))
    settled = rounds[0]
    for later in rounds[1:]:
        settled = settled.unionByName(later)
    settled = settled.where("_value is not null")
    picks, outs = [], []
    for name, position in zip(probs, positions, strict=True):
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.max(F.when(F.col("_rank") == rank, F.col("_value"))).alias(f"_{side}_{name}"))
        fraction = position - F.floor(position)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        outs.append(F.when(fraction == 0, low).otherwise(low + (high - low) * fraction).alias(name))
    return settled.groupBy(*names, "_n").agg(*picks).select(*enc.restore(), *outs)


def exact_median(df: DataFrame, keys: list[str], value: str, out: str = "median", scratch: Scratch | None = None, stored: bool = False) -> DataFrame:
    """Per group of ``keys`` (NULL keys allowed): ``out`` = exact median of ``value``."""
    return exact_quantiles(df, keys, value, {out: 0.5}, scratch, stored)


def percent_rank(df: DataFrame, keys: list[str], value: str, out: str = "percent_rank") -> DataFrame:
    """``df`` with ``out`` = (rank - 1) / (n - 1) of ``value`` within its group
    (0 for a group of one; NULL for a NULL value), without gathering a group."""
    ranks = value_ranks(df, keys, value).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        F.col(value).alias("_r_v"),
        F.when(F.col("n") > 1, F.col("below") / (F.col("n") - 1)).otherwise(F.lit(0.0)).alias(out),
    )
    cond = F.col(value).cast("double") == F.col("_r_v")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    joined = df.join(ranks, cond, "left")
    return joined.drop(*[f"_r_{k}" for k in keys], "_r_v")
