"""CSV files inside zip archives (S2), read where they are.

A zip is not a codec that Spark can split, so an archive is usually unpacked
first. This source reads it in place: the archive's directory is listed once,
every member is a partition of its own, and a task streams its member in
batches of Arrow, quoted as RFC 4180 has it. The archive has to lie in a folder
that all workers see.

    spark.dataSource.register(ZippedCsv)
    spark.read.format("zipped_csv").schema("a int, b string").option("sep", ";").load("/shared/x.zip")
"""

from __future__ import annotations

import zipfile

import pyarrow as pa
from pyarrow import csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from metricforge.session import ship


class Member(InputPartition):
    """One file of an archive."""

    def __init__(self, archive: str, name: str):
        self.archive, self.name = archive, name


class ZippedCsvReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.archive = schema, options["path"]
        self.sep, self.suffix = options.get("sep", ","), options.get("suffix", ".csv")
        self.encoding = options.get("encoding", "utf8")

    def partitions(self):
        with zipfile.ZipFile(self.archive) as z:
            return [Member(self.archive, m.filename) for m in z.infolist()
                    if not m.is_dir() and m.filename.lower().endswith(self.suffix)]

    def read(self, partition):
        # A null partition stands for an archive without members.
        if partition is None:
            return
        want = to_arrow_schema(self.schema)
        with zipfile.ZipFile(partition.archive) as z, z.open(partition.name) as f:
            batches = csv.open_csv(
                f, csv.ReadOptions(encoding=self.encoding), csv.ParseOptions(delimiter=self.sep, newlines_in_values=True),
                csv.ConvertOptions(column_types=want, include_columns=want.names, strings_can_be_null=True,
                                   quoted_strings_can_be_null=True))
            for batch in batches:
                yield pa.RecordBatch.from_arrays(batch.columns, schema=want)


class ZippedCsv(DataSource):
    """Options: ``path``, ``sep``, ``suffix`` of the members, ``encoding``."""

    @classmethod
    def name(cls):
        return "zipped_csv"

    def reader(self, schema):
        return ZippedCsvReader(schema, self.options)


def read_zip(spark: SparkSession, path: str, schema, sep: str = ",", suffix: str = ".csv", encoding: str = "utf8") -> DataFrame:
    """The CSV members of an archive as one frame, a partition each. Empty
    fields are NULL, as pandas reads them; a record that does not fit the
    schema fails the read."""
    ship(spark)
    spark.dataSource.register(ZippedCsv)
    return (spark.read.format("zipped_csv").schema(schema).option("sep", sep).option("suffix", suffix)
            .option("encoding", encoding).load(path))
