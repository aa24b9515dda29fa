"""CSV and JDBC sources (S1, S2, S3 live) and header normalisation.

Schemas are always declared: inference scans the data an extra time and
guesses types per file, which breaks on dirty columns. Dirty columns are
declared as strings and repaired with the ``try_*`` coercions in
``metricforge.functions.coerce``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


BAD_RECORD = "_bad_record"


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             sep: str = ",", header: bool = True, null_value: str | None = None,
             malformed: str = "FAILFAST") -> DataFrame:
    """CSV scan with an explicit schema, quoted as RFC 4180 and pandas do it:
    separators and line ends inside quotes, doubled quotes. ``sep=';'`` for
    the start-up export.

    A record that does not fit the schema fails the read (``FAILFAST``); with
    ``PERMISSIVE`` it is kept, and its text is in the ``_bad_record`` column.
    A multi-line file is read by one task, so stage large inputs as many part
    files. Zip archives are not a Hadoop codec: unzip at staging, then point
    ``path`` at the extracted folder.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    reader = spark.read
    if malformed == "PERMISSIVE":
        schema = StructType([*schema.fields, StructField(BAD_RECORD, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", BAD_RECORD)
    reader = (reader.schema(schema)
              .option("header", str(header).lower())
              .option("sep", sep)
              .option("mode", malformed)
              .option("multiLine", "true")
              .option("quote", '"')
              .option("escape", '"'))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              partition_column: str, lower: int, upper: int, num_partitions: int = 64) -> DataFrame:
    """Live relational source, always split into ``num_partitions`` parallel
    range queries on a numeric column (a read without a split would pass the
    whole table through one task). Not run here: no database is available."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties)


def _norm(name: str, snake: bool) -> str:
    out = name.strip()
    if snake:
        out = out.lower().replace(" ", "_")
    return out


def normalize_headers(df: DataFrame, snake: bool = True) -> DataFrame:
    """P7. ``snake=True``: lower case and spaces to ``_`` (games export);
    ``snake=False``: strip only (start-up export, H25)."""
    names = [_norm(c, snake) for c in df.columns]
    if len(set(names)) != len(names):
        dup = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"header normalisation collides: {dup}")
    return df.toDF(*names)
