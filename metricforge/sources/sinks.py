"""Result sinks (S8). The reference only displays results; a metric here
returns a DataFrame, and ``write_table`` optionally stores it as a parquet
table (overwrite, optionally partitioned) for downstream readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Quoted CSV with a header, one file per partition, as ``read_csv`` and
    pandas read it: every field quoted, quotes doubled, blanks kept."""
    (df.write.option("header", "true").option("sep", sep).option("quoteAll", "true").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
