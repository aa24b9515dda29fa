"""Interquartile fences, outlier shares, box statistics, histograms
(F14, W7, A31, A34, A35, H1, H2, H8).

Per-group quartiles come from the distributed exact ``quantiles`` (a hot
group is split by value range); the per-group fence table is joined back to
the rows, so a hot group is never sorted or merged in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricforge.functions.numeric import dec_round, ratio
from metricforge.operators.percentiles import quantiles, with_quantiles
from metricforge.session import write_once


def iqr_fences(df: DataFrame, keys: Sequence[str], value: str, k: float) -> DataFrame:
    out = quantiles(df, value, [0.25, 0.75], keys, "cont", ["q1", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return (out.withColumn("lower_fence", F.col("q1") - F.lit(k) * iqr)
               .withColumn("upper_fence", F.col("q3") + F.lit(k) * iqr))


def flag_outliers(df: DataFrame, keys: Sequence[str], value: str, k: float,
                  out: str = "is_outlier") -> DataFrame:
    """Rows plus a strict fence flag (H2: a value on the fence is kept)."""
    # Written, so that its size is known and the rows are not shuffled on a
    # few group keys.
    f = write_once(iqr_fences(df, keys, value, k).select(*keys, "lower_fence", "upper_fence"))
    joined = df.join(f, list(keys), "left")
    flag = (F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence"))
    return joined.withColumn(out, F.coalesce(flag, F.lit(False))).drop("lower_fence", "upper_fence")


def outlier_share(df: DataFrame, keys: Sequence[str], value: str, k: float = 3.0,
                  fill_zero: bool = False, scale: int = 4) -> DataFrame:
    """Per group outlier count and share of the group's non-null
    values (``groupby[value].count()``). A group without outliers has NULL
    count and share (H8) unless ``fill_zero``."""
    flagged = flag_outliers(df, keys, value, k)
    g = flagged.groupBy(*keys).agg(
        F.count(F.col(value)).alias("n_rows"),
        F.count_if(F.col("is_outlier")).alias("__out"))
    n_out = F.col("__out") if fill_zero else F.when(F.col("__out") > 0, F.col("__out"))
    return (g.withColumn("n_outliers", n_out.cast("bigint"))
             .withColumn("outlier_share", dec_round(ratio("n_outliers", "n_rows"), scale))
             .drop("__out"))


def box_stats(df: DataFrame, keys: Sequence[str], value: str, k: float = 1.5, scale: int = 4) -> DataFrame:
    """Quartiles, fences, whiskers (extreme values inside the fences),
    outlier count; one aggregate for quartiles, one for whiskers."""
    n = df.groupBy(*keys).agg(F.count(F.col(value)).alias("n"))
    f = with_quantiles(n, df, keys, [(value, 0.25, "q1"), (value, 0.5, "median"), (value, 0.75, "q3")])
    iqr = F.col("q3") - F.col("q1")
    f = (f.withColumn("lower_fence", F.col("q1") - F.lit(k) * iqr)
          .withColumn("upper_fence", F.col("q3") + F.lit(k) * iqr))
    f = write_once(f)
    j = df.join(f.select(*keys, "lower_fence", "upper_fence"), list(keys), "left")
    inside = (F.col(value) >= F.col("lower_fence")) & (F.col(value) <= F.col("upper_fence"))
    w = j.groupBy(*keys).agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(F.col(value).isNotNull() & ~inside).alias("n_outliers"))
    out = f.join(w, list(keys))
    num = ["q1", "median", "q3", "lower_fence", "upper_fence", "whisker_low", "whisker_high"]
    return out.select(*keys, "n", *[dec_round(F.col(x), scale).alias(x) for x in num], "n_outliers")


def histogram(df: DataFrame, value: str, bins: int = 50, scale: int = 4) -> DataFrame:
    """Equal-width bins between min and max, last edge inclusive,
    empty bins reported with 0. The (min, max) row and the ``bins`` bin
    labels are bounded, so both are broadcast."""
    v = F.col(value).cast("double")
    mm = df.agg(F.min(v).alias("__lo"), F.max(v).alias("__hi"))
    lo, hi = mm.select("__lo").scalar(), mm.select("__hi").scalar()
    width = hi - lo
    raw = F.floor((v - lo) / width * F.lit(float(bins)))
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    counts = df.where(v.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # ``bins`` label rows, bounded by the argument.
    labels = mm.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "__lo", "__hi")
    step = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    edges = labels.select(
        "bin",
        dec_round(F.col("__lo") + F.col("bin") * step, scale).alias("bin_low"),
        dec_round(F.col("__lo") + (F.col("bin") + 1) * step, scale).alias("bin_high"))
    return (edges.join(F.broadcast(counts), "bin", "left")
            .select("bin", "bin_low", "bin_high", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))
