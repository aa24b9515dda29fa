"""What each step of a cleaning loses.

Counts are observed in the job that writes the cleaned table, so no step is
computed a second time to be counted. An observed count can rise when Spark
repeats tasks of a lost executor, so the first and the last figure are held
against the source's and the result's own row counts (file footers); if they
differ, the steps are counted by themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from metricforge.functions.numeric import pct
from metricforge.session import write_once


class Steps:
    """``steps(df, name)`` marks the rows after a step; the first mark is the
    source."""

    def __init__(self):
        self.marks: list[tuple[str, Observation, DataFrame]] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        seen = Observation(f"{name} {uuid.uuid4().hex}")
        out = df.observe(seen, F.count(F.lit(1)).alias("n"))
        self.marks.append((name, seen, df))
        return out

    def run(self, result: DataFrame, source_rows: int) -> DataFrame:
        """Write ``result`` (what follows the last mark), which counts."""
        written = write_once(result)
        self.counts = [int(seen.get["n"]) for _, seen, _ in self.marks]
        if self.counts[0] != source_rows or self.counts[-1] != written.count():
            self.counts = [df.count() for _, _, df in self.marks]
        return written

    def report(self) -> DataFrame:
        """``(step, step_name, rows_in, rows_out, lost_pct)``."""
        spark = self.marks[0][2].sparkSession
        rows = [(i, self.marks[i][0], self.counts[i - 1], self.counts[i]) for i in range(1, len(self.marks))]
        df = spark.createDataFrame(rows, "step int, step_name string, rows_in long, rows_out long")
        return df.withColumn("lost_pct", pct(F.col("rows_in") - F.col("rows_out"), "rows_in"))
