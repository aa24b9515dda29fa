"""Correlation, categorical codes, contingency association
(A25, A36, P17, H12, H13, H14)."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metricforge.functions.numeric import dec_round
from metricforge.session import write_once


def safe_corr(a: str, b: str) -> Column:
    """Pearson with pairwise deletion; NULL (not an error) for a constant
    column (H13): ``covar_samp / (stddev_a * stddev_b)`` over rows where
    both are present."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    xa = F.when(both, F.col(a).cast("double"))
    xb = F.when(both, F.col(b).cast("double"))
    return F.try_divide(F.covar_samp(xa, xb), F.stddev_samp(xa) * F.stddev_samp(xb))


def corr_long(df: DataFrame, cols: Sequence[str], scale: int = 6) -> DataFrame:
    """All pairs (including the diagonal) in one aggregate, long form
    (col_a, col_b, corr)."""
    pairs = list(itertools.combinations_with_replacement(cols, 2))
    one = df.agg(*[safe_corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                             dec_round(F.col(f"c{i}"), scale).alias("corr")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"),
                                 dec_round(F.col(f"c{i}"), scale).alias("corr")))
    return one.select(F.inline(F.array(*rows)))


def category_codes(df: DataFrame, col: str | Mapping[str, str], out: str | None = None) -> DataFrame:
    """``astype('category').cat.codes`` of a text column as ``out``, or of
    several (a mapping of column to code): alphabetical code from 0, NULL -> -1
    (H12). The distinct
    values of all columns are one aggregate, dealt into ranges; a value's code
    is the number of its column's values in the ranges before its own (one row
    per range and column) plus its rank there, so no task orders all of them."""
    cols = {col: out} if isinstance(col, str) else col
    long = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("__i"), F.col(c).cast("string").alias("__v"))
                                        for i, c in enumerate(cols)])))
    values = long.where(F.col("__v").isNotNull()).distinct()
    values = write_once(values.repartitionByRange("__i", "__v").withColumn("__range", F.spark_partition_id()))
    sizes = values.groupBy("__i", "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__i", "__range", (F.sum("__n").over(W.partitionBy("__i").orderBy("__range"))
                                             - F.col("__n")).alias("__before"))
    rank = F.row_number().over(W.partitionBy("__i", "__range").orderBy("__v"))
    codes = write_once(values.join(before, ["__i", "__range"])
                       .select("__i", "__v", (F.col("__before") + rank - 1).cast("int").alias("__code")))
    for i, (col, out) in enumerate(cols.items()):
        own = codes.where(F.col("__i") == i).select(F.col("__v").alias(f"__v{i}"), F.col("__code").alias(out))
        df = (df.join(own, F.col(col).cast("string") == F.col(f"__v{i}"), "left").drop(f"__v{i}")
              .withColumn(out, F.coalesce(F.col(out), F.lit(-1))))
    return df


def chi_square(cells: DataFrame, a: str, b: str) -> DataFrame:
    """(chi2, n, ka, kb) of ``cells(a, b, o)``: observed counts of the cells
    that occur. Chi-square is the sum of (o - e)^2 / e over them, plus the
    expected counts of the others (n less the sum of e), so no grid is built,
    nothing large is subtracted and no product of counts can overflow."""
    ra = cells.groupBy(a).agg(F.sum("o").cast("double").alias("ra"))
    rb = cells.groupBy(b).agg(F.sum("o").cast("double").alias("rb"))
    n = cells.agg(F.sum("o").cast("double")).scalar()
    seen = cells.join(ra, a).join(rb, b).withColumn("e", F.col("ra") / n * F.col("rb"))
    gap = F.col("o").cast("double") - F.col("e")
    # e is 0 nowhere: every margin of a seen cell is positive.
    return seen.agg((F.sum(gap * gap / F.col("e")) + F.greatest(n - F.sum("e"), F.lit(0.0))).alias("chi2")).select(
        "chi2", n.alias("n"), ra.agg(F.count("*")).scalar().alias("ka"), rb.agg(F.count("*")).scalar().alias("kb"))


def cramers_v(df: DataFrame, a: str, b: str, scale: int = 6) -> DataFrame:
    """A36 (re-aimed association matrix entry): chi-square of the
    contingency table and Cramer's V."""
    cells = write_once(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b)
                       .agg(F.count(F.lit(1)).alias("o")))
    v = F.sqrt(F.try_divide(F.col("chi2") / F.col("n"), F.least("ka", "kb") - 1))
    return chi_square(cells, a, b).select(
        dec_round("chi2", scale).alias("chi2"),
        ((F.col("ka") - 1) * (F.col("kb") - 1)).cast("bigint").alias("dof"),
        F.col("n").cast("bigint").alias("n"),
        dec_round(v, scale).alias("cramers_v"))
