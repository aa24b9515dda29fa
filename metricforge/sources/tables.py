"""Parquet table scans (S3).

Tables are read lazily; Catalyst prunes the columns a query uses and pushes
its range filters into the parquet reader (``PushedFilters``/``ReadSchema``
in ``explain``), so loading a whole table here costs nothing by itself.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Register every table as a temporary view, so SQL users can run
    ``spark.sql(...)`` over the same scans (pushdown and pruning apply)."""
    for name in TABLES:
        load(spark, sf_dir, name).createOrReplaceTempView(name)
    return list(TABLES)


def loader(spark: SparkSession, sf_dir: str):
    """``t = loader(spark, d); t("orders")``."""
    return partial(load, spark, sf_dir)
