"""Table layouts that spare reads.

``bucketed``: rows dealt into buckets by a key and sorted in them, so joins
and groupings on the key need no shuffle. ``sorted_copy``: files cover ranges
of a key and have small row groups with their extremes and Bloom filters, so a
lookup by key (or by a column with a filter) opens one row group of many.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from metricforge.session import shared_path


def bucketed(df: DataFrame, key: str, buckets: int | None = None, name: str | None = None) -> DataFrame:
    """``df`` as a table of ``buckets`` files (default: the session's shuffle
    partitions), written below the shared folder. Two tables with as many
    buckets join on their keys without an exchange. The rows are dealt as a
    shuffle would deal them, so each bucket is one file."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"mf_bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", shared_path(spark, "bucketed")).saveAsTable(name))
    return spark.table(name)


def sorted_copy(df: DataFrame, key: str, path: str | None = None, files: int | None = None, group_bytes: int = 8 << 20,
                bloom: Sequence[str] = ()) -> str:
    """Write ``df`` in files that cover ranges of ``key``, sorted, with row
    groups of about ``group_bytes`` and Bloom filters on ``bloom``. Returns
    the folder. A reader only has to filter: the scan does the rest."""
    path = path or shared_path(df.sparkSession, "sorted")
    dealt = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    writer = dealt.sortWithinPartitions(key).write.option("parquet.block.size", group_bytes)
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    return path


def lookup(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """Rows of a copy whose ``column`` is ``value``."""
    df = spark.read.parquet(path)
    return df.where(df[column] == value)
