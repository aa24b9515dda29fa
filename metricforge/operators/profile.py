"""A table profile that grows with its table.

For every file of a table one row of states is stored: counts, missing values,
moments, extremes, and two sketches (distinct values, ranks) per column. States
add up, so the profile of the table is an aggregate over a row for each file,
and after an append only the new files are read. Counts, moments and extremes
are exact; what a sketch says is named ``..._about``: distinct values within
about 2 % (relative), the median within 1 % of the ranks, in 99 of 100 cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH = 400


def file_states(df: DataFrame, cols: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """``(file, column_name, states...)`` of the files ``df`` scans; those in
    ``known(file)`` are left out. Sums are decimals, so their order does not
    matter."""
    file = F.input_file_name()
    rows = df.select(file.alias("file"), *[F.col(c).cast("double").alias(c) for c in cols])
    if known is not None:
        rows = rows.join(F.broadcast(known.select("file").distinct()), "file", "left_anti")   # a row for each file
    long = rows.select("file", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in cols])))
    exact = F.col("v").cast("decimal(38,9)")
    return long.groupBy("file", "column_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("v").alias("n"), F.sum(exact).alias("s"),
        F.avg("v").alias("mean"), F.var_pop("v").alias("var"), F.min("v").alias("low"), F.max("v").alias("high"),
        F.hll_sketch_agg(F.when(F.col("v").isNotNull(), F.xxhash64("v"))).alias("distinct"), F.kll_sketch_agg_double("v", F.lit(SKETCH)).alias("ranks"))


def merged_profile(states: DataFrame) -> DataFrame:
    """``(column_name, n_rows, n, missing, mean, sd, low, high,
    distinct_about, median_about)`` from the states of all files. Variances
    are joined by the files' means, which loses nothing to cancellation."""
    per = states.where("n > 0")
    total = per.groupBy("column_name").agg((F.sum("s").cast("double") / F.sum("n")).alias("m"))
    per = per.join(F.broadcast(total), "column_name")       # a row for each column
    spread = F.col("n") * (F.col("var") + F.pow(F.col("mean") - F.col("m"), 2))
    some = per.groupBy("column_name").agg(
        F.sum("n").alias("k"), F.max("m").alias("mean"), F.sum(spread).alias("ss"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_about"),
        F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("ranks"), F.lit(0.5)).alias("median_about"))
    rows = states.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"))
    return rows.join(some, "column_name", "left").select(
        "column_name", "n_rows", "n", (F.col("n_rows") - F.col("n")).alias("missing"), "mean",
        F.sqrt(F.when(F.col("n") > 1, F.col("ss") / (F.col("n") - 1))).alias("sd"), "low", "high", "distinct_about",
        "median_about")
