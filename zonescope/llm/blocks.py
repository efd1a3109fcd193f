"""Pairing the members of large groups without putting a group into one task.

A group is cut into blocks of about ``block`` rows by hash; every pair of
blocks of one group becomes a work unit of at most two blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonescope.llm.common import stored


def block_pairs(members: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """``members`` with ``_i``, ``_j`` (the unit, ``_i <= _j``) and ``_own`` (the row's block): one row per unit it belongs to."""
    sizes = stored(members.groupBy(key).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks")).where("_blocks > 1"), "block-sizes")
    dealt = members.join(sizes, key, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    dealt = dealt.withColumn("_own", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return dealt.withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}).drop("_other", "_blocks")
