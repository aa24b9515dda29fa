"""Join helpers.

Sizes are left to the planner: a scan or a written intermediate has an exact
size, so a side under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast,
and AQE does the same from measured shuffle sizes and splits skewed
partitions. ``F.broadcast`` is used directly only for a side that is bounded
by construction (a top-k result, a label list, histogram bins).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` treating NULL keys as equal (a NULL group is a
    group, like GROUP BY and like pandas ``merge``)."""
    keys = list(keys)
    if not keys:
        raise ValueError("join keys required")
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, (left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys))
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])
