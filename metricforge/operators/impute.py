"""Null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricforge.session import write_once


def fill_group_mean(df: DataFrame, col: str, keys: Sequence[str], out: str | None = None) -> DataFrame:
    """``fillna(groupby(keys)[col].transform('mean'))``.

    The group mean is an aggregate joined back rather than a window over
    the group, so a group holding a large share of rows is reduced map-side.
    The means are written first: their exact size lets the planner broadcast
    them, and the rows are not shuffled on a few keys. A row with a NULL key finds no group and keeps its own value (H11); an
    all-null group stays null."""
    out = out or col
    means = write_once(df.groupBy(*keys).agg(F.avg(col).alias("__mean")))
    j = df.join(means, list(keys), "left")
    return j.withColumn(out, F.coalesce(F.col(col), F.col("__mean"))).drop("__mean")


def drop_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """``dropna(subset=...)``."""
    return df.na.drop(subset=list(subset))


def fill_const(df: DataFrame, values: dict) -> DataFrame:
    """``fillna({...})``."""
    return df.na.fill(values)
