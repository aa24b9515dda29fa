"""Top values of a column with very many distinct ones.

Counting all values to keep a few shuffles every distinct value. Here a first
scan counts hash buckets only (``width`` rows for each task, added up), and a
bucket's total is an upper bound of each of its values. The values of the
fullest buckets are then counted exactly; the k-th of them is a lower bound of
the result, so a bucket with a smaller total can hold none of the top k. What
is left is counted exactly as well: nothing on skewed data, everything on data
without heavy values, and the result is exact either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricforge.session import write_once

#: Buckets of the first scan, and how many of the fullest are looked into
#: first, as a multiple of k.
WIDTH = 1 << 16
LEAD = 4


def top_values(df: DataFrame, col: str, k: int, name: str = "n", width: int = WIDTH) -> DataFrame:
    """The ``k`` most frequent values of ``col`` (NULL is none), ties by the
    smallest value: ``(col, name)``, in order."""
    rows = df.where(F.col(col).isNotNull()).select(col, F.pmod(F.xxhash64(col), F.lit(width)).alias("__b"))
    totals = write_once(rows.groupBy("__b").agg(F.count(F.lit(1)).alias("__t")))

    def counted(buckets: DataFrame) -> DataFrame:
        # At most ``width`` buckets: broadcast.
        few = rows.join(F.broadcast(buckets.select("__b")), "__b", "left_semi")
        return write_once(few.groupBy(col).agg(F.count(F.lit(1)).alias(name)))

    lead = write_once(totals.orderBy(F.desc("__t"), "__b").limit(LEAD * k))
    found = counted(lead)
    low = found.orderBy(F.desc(name)).limit(k).agg(F.min(name).alias("low"), F.count(F.lit(1)).alias("c")).first()
    # Fewer than k values so far bound nothing. A total equal to the bound may
    # be one value that wins a tie.
    bound = low["low"] if low["c"] == k else 0
    rest = totals.join(F.broadcast(lead.select("__b")), "__b", "left_anti").where(F.col("__t") >= bound)
    if not rest.isEmpty():
        found = found.unionByName(counted(rest))
    return found.orderBy(F.desc(name), F.asc(col)).limit(k)
