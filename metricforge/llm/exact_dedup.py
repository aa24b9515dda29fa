"""Exact dedup with disk-backed streaming state.

The rows' digests are streamed through a stateful aggregation whose state
lives in RocksDB and never expires. For each digest it holds the number of
copies, the stable identifier that stays (the smallest id) and the locator
of its content (file and row). After the stream has run, the state itself is
read back. Wherever a digest was hit more than once, the full texts behind
the locators are compared; texts that differ in spite of one digest are
taken apart by their content.

Everything is DataFrame code. Partial aggregation combines a large group of
copies before each shuffle, and the comparison keeps two texts of a group
per task (the least and the greatest), so no group meets in one place.

Defined cases: a null text counts as empty, and all empty texts are equal; a
null id stays only where every copy has a null id; among copies with one id
the first by address stays, so one row of a group is kept even if rows
repeat; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricforge.llm.common import FILE, ROW, addressed, columns, keep, shared_path

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # There are many small stores: no space is set aside for each.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # All stores of an executor share this much native memory; stores that no
    # stream uses any more are closed soon.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.maintenanceInterval": "15s",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def digest_state(index: DataFrame, path: str, bytes_per_trigger: int = 64 << 30) -> DataFrame:
    """``(digest, copies, first)`` from the state of a stream over the Parquet
    files of ``index`` at ``path``. A stream that is started again with its
    checkpoint goes on where it stopped."""
    spark = index.sparkSession
    checkpoint = shared_path(spark, "dedup-state")
    rows = spark.readStream.schema(index.schema).option("maxBytesPerTrigger", bytes_per_trigger).parquet(path)
    groups = rows.groupBy("digest").agg(
        F.count("*").alias("copies"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", FILE, ROW)).alias("first"))
    with _settings(spark, STATE_STORE):
        stream = (groups.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
                  .trigger(availableNow=True).start())
        stream.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        count, first = state.schema["value"].dataType.names
        state = state.select("key.digest", F.col("value")[count].alias("copies"), F.col("value")[first].alias("first"))
        return keep(state.select("digest", "copies", F.col("first.doc_id").alias("keep_id"),
                                 F.col(f"first.{FILE}").alias("keep_file"), F.col(f"first.{ROW}").alias("keep_row")),
                    "groups")


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, bytes_per_trigger: int = 64 << 30) -> DataFrame:
    """For every row: ``(address, doc_id, keep_id, group_size, kept, digest)``."""
    spark = docs.sparkSession
    src = addressed(docs)
    src = src.select(FILE, ROW, src[id_col].alias("doc_id"), normalised(src[text_col]).alias("text"))
    path = shared_path(spark, "digests")
    (src.select(FILE, ROW, "doc_id", digest(F.col("text")).alias("digest"))
     .write.option("compression", "zstd").parquet(path))
    index = spark.read.parquet(path)
    groups = digest_state(index, path, bytes_per_trigger)

    # Full bytes of every digest that was hit again.
    hits = index.select(FILE, ROW, "digest").join(groups.where("copies > 1").select("digest"), "digest")
    texts = src.select(FILE, ROW, "text").join(hits, [FILE, ROW])
    unlike = keep(texts.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b"))
                  .where("a != b").select("digest"), "collisions")
    rows = index.join(groups, "digest")
    if not unlike.isEmpty():
        apart = (src.join(index.drop("doc_id").join(unlike, "digest"), [FILE, ROW])
                 .select(FILE, ROW, "doc_id", "digest", "text"))
        alike = apart.groupBy("digest", "text").agg(
            F.count("*").alias("copies"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", FILE, ROW)).alias("first"))
        alike = alike.select("digest", "text", "copies", F.col("first.doc_id").alias("keep_id"),
                             F.col(f"first.{FILE}").alias("keep_file"), F.col(f"first.{ROW}").alias("keep_row"))
        rows = (rows.join(unlike, "digest", "left_anti")
                .unionByName(apart.join(alike, ["digest", "text"]).drop("text")))
    return rows.select(FILE, ROW, "doc_id", "keep_id", F.col("copies").alias("group_size"),
                       ((F.col("keep_file") == F.col(FILE)) & (F.col("keep_row") == F.col(ROW))).alias("kept"),
                       "digest")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    src = addressed(docs)
    stay = find_copies(src, id_col, text_col).where("kept").select(FILE, ROW)
    return src.join(stay, [FILE, ROW], "left_semi").select(*columns(docs))
