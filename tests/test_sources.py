"""CSV sources (S1, S2) and header normalisation (P7) on small staged files."""

import tempfile

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from metricforge.functions.coerce import coerce_numeric
from metricforge.sources.files import normalize_headers, read_csv


def test_csv_semicolon_dirty_headers(spark):
    d = tempfile.mkdtemp(prefix="mf-csv-")
    with open(f"{d}/part-0.csv", "w") as f:
        f.write("name ;market ; funding_total_usd \n")
        f.write("a;x; 1,000 \n")
        f.write("b;y;tbd\n")
    schema = StructType([StructField("name ", StringType()), StructField("market ", StringType()),
                         StructField(" funding_total_usd ", StringType())])
    df = read_csv(spark, d, schema, sep=";")
    df = normalize_headers(df, snake=False)
    assert df.columns == ["name", "market", "funding_total_usd"]
    from pyspark.sql import functions as F
    vals = [r[0] for r in df.select(coerce_numeric("funding_total_usd", thousands=",")).collect()]
    assert vals == [1000.0, None]


def test_csv_comma_snake_headers(spark):
    d = tempfile.mkdtemp(prefix="mf-csv-")
    with open(f"{d}/games.csv", "w") as f:
        f.write("Name,Year of Release,EU sales\n")
        f.write("G,2001,0.5\n")
    schema = StructType([StructField("Name", StringType()), StructField("Year of Release", DoubleType()),
                         StructField("EU sales", StringType())])
    df = normalize_headers(read_csv(spark, d, schema), snake=True)
    assert df.columns == ["name", "year_of_release", "eu_sales"]
    assert df.collect()[0]["year_of_release"] == 2001.0


def test_write_table_roundtrip(spark, small_dir):
    from metricforge.plans import QUERIES
    from metricforge.sources.sinks import write_table
    out = tempfile.mkdtemp(prefix="mf-sink-") + "/dau"
    df = QUERIES["dau_purchase"](spark, small_dir)
    write_table(df, out, partition_by=["log_date"])
    back = spark.read.parquet(out)
    assert back.count() == df.count()
