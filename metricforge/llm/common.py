"""Helpers of the training-data operators: shared scratch tables and
connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricforge.session import checkpoint_dir, scratch, ship

#: Frees a finished statement's shuffle files, so that the disk holds one
#: step's shuffles at a time.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, which ``clean`` of
    the session removes."""
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    scratch(spark).append(path)
    return path


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts
    the lineage, survives lost executors, and releases the step's shuffle
    files."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


#: Rows that one row is expanded to at a time.
PORTION = 1 << 12


def each(df: DataFrame, count: str, name: str) -> DataFrame:
    """A row for each number from 0 below ``count`` as ``name``, in two steps,
    so that one row's many numbers are dealt over the tasks. The columns of
    ``df`` have plain names."""
    df = df.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({count} - 1) div {PORTION}"))).alias("__portion"))
    df = df.repartition(F.xxhash64(*df.columns))
    first = F.col("__portion") * PORTION
    return df.select("*", F.explode(F.sequence(first, F.least(first + PORTION, F.col(count)) - 1)).alias(name)).drop("__portion")


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)`` with
    the smallest node as component; nodes without an edge do not appear.

    Alternating large-star and small-star steps (Kiveris et al. 2014). Each
    step is a minimum per node (combined map-side) and a join back, which
    adaptive execution splits for a node with very many edges; nothing is
    gathered per node.
    """
    cur = keep(edges.where(F.col("a") != F.col("b"))
               .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def star(pairs: DataFrame, small: bool) -> DataFrame:
        # pairs(u, v): v is a neighbour of u.
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        joined = pairs.join(low, "u")
        if small:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
            out = out.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        else:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return out.where("a != b").distinct()

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    seen = mark(cur)
    while True:                     # each round that is not the last changes an edge
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = star(both, small=False)
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        cur = keep(star(down, small=True), "edges")
        now = mark(cur)
        if now == seen:
            break
        seen = now
    return (cur.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
            .unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))


#: Internal names of a row's address; not likely to meet a table's columns.
FILE, ROW = "__mf_file", "__mf_row"


def _plain_scan(df: DataFrame) -> bool:
    """Whether each row of ``df`` is a row of a file, and none is two: a scan,
    at most filtered and projected. Spark hands a file row's address on through
    all other steps as well, also those that repeat rows."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def addressed(docs: DataFrame) -> DataFrame:
    """``docs`` with the address of each row: the file it lies in (as a
    64-bit hash of the path) and its place there. Unlike an id column, an
    address is never null and never repeats. A frame that is not a plain scan
    of Parquet files (a join, a union, an exploded table) is written to the
    shared folder first."""
    if {FILE, ROW} <= {*docs.columns}:
        return docs

    def place(df: DataFrame) -> DataFrame:
        at = df.metadataColumn("_metadata")
        return df.select("*", F.xxhash64(at["file_path"]).alias(FILE), at["row_index"].alias(ROW))

    if _plain_scan(docs):
        with suppress(AnalysisException):     # files of another kind have no row numbers
            return place(docs)
    return place(keep(docs, "documents"))
