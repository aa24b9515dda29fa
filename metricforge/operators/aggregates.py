"""Grouping, share, profile and ranking operators.

All aggregates use Spark's partial (map-side) aggregation, so a hot key is
reduced inside each task before the shuffle. Shares divide grouped rows by a
total that is itself an aggregate joined back (one row, or one row per
partition key), instead of an unpartitioned window that would pull every
row into a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metricforge.functions.numeric import dec_round, pct, ratio
from metricforge.operators.joins import join_null_safe
from metricforge.session import write_once


def value_counts(df: DataFrame, col: str, name: str = "n", dropna: bool = True) -> DataFrame:
    """Frequency table (pandas drops null keys)."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def with_share(grouped: DataFrame, value: str, out: str, partition: Sequence[str] = (),
               scale: int = 2, percent: bool = True) -> DataFrame:
    """``value / SUM(value) OVER (PARTITION BY partition)`` on grouped
    rows, computed as an aggregate joined back (NULL is a partition)."""
    tot = "__total"
    if partition:
        totals = grouped.groupBy(*partition).agg(F.sum(value).alias(tot))
        joined = join_null_safe(grouped, totals, partition, "left")
        total = F.col(tot)
    else:
        # Grand total as a scalar subquery (computed once, no join).
        joined = grouped
        total = grouped.agg(F.sum(value)).scalar()
    share = pct(value, total, scale) if percent else dec_round(ratio(value, total), scale)
    return joined.withColumn(out, share).drop(tot)


def topk(df: DataFrame, k: int, order: Sequence[Column], tie_break: Sequence[str] = ()) -> DataFrame:
    """O4/O5 with a deterministic tie-break (H19). Planned as
    ``TakeOrderedAndProject``: each task keeps its own top k, no full sort."""
    keys = list(order) + [F.col(t).asc_nulls_last() for t in tie_break]
    return df.orderBy(*keys).limit(k)


def mode_by_group(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Most frequent value per group, ties -> smallest value.

    Two aggregates (count per (keys, value), then the best pair per key), so
    a group with many rows is reduced map-side like any count."""
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")))
    best = F.min(F.struct((-F.col("__n")).alias("neg_n"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.getField("v").alias(out))


def null_profile(df: DataFrame, cols: Sequence[str], scale: int = 2) -> DataFrame:
    """A20/A21 in one pass: (column, n_missing, pct_missing)."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(x).isNull()).alias(f"m_{i}") for i, x in enumerate(cols)]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{x}', m_{i}" for i, x in enumerate(cols))
    long = one.selectExpr("__rows", f"stack({len(cols)}, {stack}) as (column_name, n_missing)")
    return long.select("column_name", "n_missing", pct("n_missing", "__rows", scale).alias("pct_missing"))


def duplicate_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows, distinct rows and duplicated rows over ``cols``
    (``duplicated(subset).sum()`` = rows - distinct key combinations)."""
    per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(
        F.sum("__n").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.col("__n") - 1).cast("bigint").alias("n_duplicates"),
        F.count_if(F.col("__n") > 1).alias("n_dup_groups"),
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows that belong to any duplicate group (``keep=False``).

    Group sizes come from an aggregate (map-side reduced, skew-safe) and are
    joined back; AQE's skew join splits a key that holds a large share of
    rows, instead of one window task sorting the whole hot group. NULL keys
    are equal, as in pandas."""
    sizes = write_once(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size"))
                       .where(F.col("group_size") > 1))
    return join_null_safe(df, sizes, keys)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long (column_name, value, n_distinct) over string-cast values.
    Each column's distinct set is an aggregate; its size is a scalar
    subquery over that set (no join on the constant column name)."""
    out = None
    for x in cols:
        vals = df.select(F.col(x).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
        part = vals.select(F.lit(x).alias("column_name"), "value",
                           vals.agg(F.count(F.lit(1))).scalar().alias("n_distinct"))
        out = part if out is None else out.unionByName(part)
    return out


def wide_totals(df: DataFrame, cols: Sequence[str], how: str = "sum", scale: int = 2) -> DataFrame:
    """One aggregate over many columns, then unpivot to
    (measure, value, rank)."""
    if how == "sum":
        # pandas ``df[cols].sum()``: an all-NULL column sums to 0.
        aggs = [dec_round(F.coalesce(F.sum(F.col(x).cast("decimal(28,9)")), F.lit(0)), scale).alias(x) for x in cols]
        vtype = "double"
    elif how == "positive":
        aggs = [F.count_if(F.col(x) > 0).alias(x) for x in cols]
        vtype = "bigint"
    else:
        raise ValueError(how)
    one = df.agg(*aggs)
    long = one.unpivot([], list(cols), "measure", "value").withColumn("value", F.col("value").cast(vtype))
    # At most len(cols) rows: a window over them is bounded.
    return long.withColumn("rank", F.rank().over(W.orderBy(F.desc_nulls_last("value"))).cast("bigint"))


def describe(df: DataFrame, cols: Sequence[str], scale: int = 4) -> DataFrame:
    """Exact eight-number summary per column in long form. Moments come
    from one aggregate pass; quartiles from the distributed exact quantiles.
    (``DataFrame.summary`` uses approximate percentiles - not used.)"""
    from metricforge.operators.percentiles import with_quantiles
    aggs = []
    for i, x in enumerate(cols):
        v = F.col(x).cast("double")
        aggs += [F.count(v).alias(f"count_{i}"), F.avg(v).alias(f"mean_{i}"),
                 F.stddev_samp(v).alias(f"std_{i}"), F.min(v).alias(f"min_{i}"), F.max(v).alias(f"max_{i}")]
    one = df.agg(*aggs)
    specs = [(x, p, f"{nm}_{i}") for i, x in enumerate(cols) for p, nm in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]
    one = with_quantiles(one, df, [], specs)
    stats = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    rows = [F.struct(F.lit(x).alias("column_name"), F.col(f"count_{i}").alias("count"),
                     *[dec_round(F.col(f"{s}_{i}"), scale).alias(s) for s in stats])
            for i, x in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))
