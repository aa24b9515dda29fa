"""What an inner join loses.

An inner join drops rows whose key has no partner without a word, and repeats
rows whose key has several. ``join_audit`` counts both before a metric relies
on a join: each side is reduced to a row per key (combined map-side), one full
outer join meets the keys, and one aggregate adds up. The rows themselves are
not joined, so an audit costs less than the join it looks at.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _met(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], rows: str | None, amount: str | None) -> DataFrame:
    """A row per key of either side: ``(keys..., n, s, copies)``. NULL keys
    meet nothing, as in the join."""
    n = F.sum(rows) if rows else F.count(F.lit(1))
    s = F.sum(amount) if amount else F.lit(0)
    mine = left.groupBy(*[F.col(a).alias(f"k{i}") for i, (a, _) in enumerate(on)]).agg(n.alias("n"), s.alias("s"))
    theirs = right.groupBy(*[F.col(b).alias(f"r{i}") for i, (_, b) in enumerate(on)]).agg(F.count(F.lit(1)).alias("copies"))
    same = reduce(Column.__and__, (F.col(f"k{i}") == F.col(f"r{i}") for i in range(len(on))))
    return mine.join(theirs, same, "full_outer")


def join_audit(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], rows: str | None = None,
               amount: str | None = None) -> DataFrame:
    """One row for the inner join of ``left`` and ``right`` on the pairs of
    columns ``on``: ``(left_rows, lost_rows, lost_amount, extra_rows,
    unused_keys)``. ``rows``: a column of ``left`` that counts rows, if it is
    reduced already; ``amount``: the column whose loss is summed."""
    lost, both = F.col("copies").isNull(), F.col("copies").isNotNull() & F.col("n").isNotNull()
    count = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("bigint")
    return _met(left, right, on, rows, amount).agg(
        count("n").alias("left_rows"), count(F.when(lost, F.col("n"))).alias("lost_rows"),
        F.coalesce(F.sum(F.when(lost, F.col("s"))), F.lit(0)).alias("lost_amount"),
        count(F.when(both, F.col("n") * (F.col("copies") - 1))).alias("extra_rows"),
        F.count_if(F.col("n").isNull()).alias("unused_keys"))


def lost_by_key(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], rows: str | None = None,
                amount: str | None = None) -> DataFrame:
    """The keys of ``left`` without a partner: ``(keys..., lost_rows,
    lost_amount)``."""
    met = _met(left, right, on, rows, amount).where(F.col("copies").isNull())
    return met.select(*[F.col(f"k{i}").alias(a) for i, (a, _) in enumerate(on)],
                      F.col("n").cast("bigint").alias("lost_rows"), F.col("s").alias("lost_amount"))
