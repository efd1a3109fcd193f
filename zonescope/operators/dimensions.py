"""Slowly changing dimensions (X15): the history of a dimension out of its snapshots.

Every delivery of a reference dataset is a full snapshot.  A key's rows are
compared from snapshot to snapshot; equal neighbours are one version, valid
from the first snapshot that holds it to the next that does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Deliveries of one dataset; their dates are joined to every row, so their number is checked.
MOST_SNAPSHOTS = 100_000
#: Facts without a key are dealt to so many stand-ins.
NULL_SALTS = 4096


def one_row_a_snapshot(rows: DataFrame, key: str, attributes: list[str], snapshot: str) -> DataFrame:
    """One row per (key, snapshot): of several, that with the largest attributes (``max`` is a partial aggregate; copies never meet in one task)."""
    kept = rows.where(F.col(key).isNotNull() & F.col(snapshot).isNotNull())
    return kept.groupBy(key, snapshot).agg(F.max(F.struct(*attributes)).alias("_row")).select(key, snapshot, "_row.*")


def history(rows: DataFrame, key: str, attributes: list[str], snapshot: str = "snapshot_date") -> DataFrame:
    """Versions of a dimension: key, attributes, ``valid_from``, ``valid_to`` (NULL: still valid), ``is_current``, ``version`` and a surrogate key.

    A version ends with the first later snapshot in which the key is absent or
    differs in an attribute (NULL equals NULL); a key that comes back starts a
    new version.  Rows without a key or snapshot are left out; several rows of
    a key in one snapshot count as one.  Windows are per key over its
    snapshots, so they hold a key's deliveries at most.
    """
    single = one_row_a_snapshot(rows, key, attributes, snapshot)
    dates = rows.where(F.col(snapshot).isNotNull()).select(F.col(snapshot).alias("_at")).distinct()
    known = sorted(r[0] for r in dates.limit(MOST_SNAPSHOTS + 1).collect())
    if len(known) > MOST_SNAPSHOTS:
        raise ValueError(f"more than {MOST_SNAPSHOTS} snapshots")
    following = rows.sparkSession.createDataFrame(list(zip(known, [*known, None][1:], strict=True)), "_at date, _next date")
    dated = single.join(F.broadcast(following), F.col(snapshot) == F.col("_at"))
    by_key = Window.partitionBy(key).orderBy(snapshot)
    same = F.struct(*attributes).eqNullSafe(F.lag(F.struct(*attributes)).over(by_key)) & F.lag("_next").over(by_key).eqNullSafe(F.col(snapshot))
    marked = dated.withColumn("_new", F.when(same, 0).otherwise(1))
    numbered = marked.withColumn("version", F.sum("_new").over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"))
    versions = numbered.groupBy(key, "version", *attributes).agg(F.min(snapshot).alias("valid_from"), F.max_by("_next", snapshot).alias("valid_to"))
    return versions.select(
        F.md5(F.concat_ws("||", F.col(key).cast("string"), F.col("valid_from").cast("string"))).alias("location_key"),
        key, *attributes, "version", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def as_of(facts: DataFrame, versions: DataFrame, key: str, date: str, columns: list[str]) -> DataFrame:
    """``facts`` with the ``columns`` of the version valid on their date (NULL where none is).

    The versions of a key are few: an equi-join on the key, the validity
    decides, and a fact meets at most one version as versions of a key do not
    overlap.  Facts of one key may be very many; that side is split by adaptive
    execution.  Facts without a key are spread over stand-ins that match nothing.
    """
    slim = versions.select(F.col(key).cast("string").alias("_key"), "valid_from", "valid_to", *[F.col(c).alias(f"_{c}") for c in columns])
    nothing = F.concat(F.lit("\x00"), F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SALTS)).cast("string"))
    facts = facts.withColumn("_fact_key", F.coalesce(F.col(key).cast("string"), nothing))
    valid = (F.col("_fact_key") == F.col("_key")) & (F.col(date) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(date) < F.col("valid_to")))
    joined = facts.join(slim, valid, "left")
    return joined.select(*[c for c in facts.columns if c != "_fact_key"], *[F.col(f"_{c}").alias(c) for c in columns])
