"""Distinct counts that add up.

A distinct count of a union is not the sum of the parts, so a dashboard that
keeps counts has to go back to the fact table for every selection. A bitmap
per cell can be united instead: members are numbered, and each cell of the
cube holds, for every bucket of numbers it meets, one bitmap of 4 KB at most.
Uniting bitmaps and counting their ones answers any selection and any roll-up
level exactly, from the cube alone.

Members are numbered in the order of a leading column, so the members of one
value of it are neighbours and share buckets: few bitmaps, well filled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metricforge.session import write_once


def numbered(members: DataFrame, order: Sequence[str], out: str = "member_no") -> DataFrame:
    """``members`` (distinct rows) numbered from 0 in the order of ``order``.
    They are dealt into ranges and written; a number is the sum of the ranges
    before (one row each) plus the rank in the own one."""
    dealt = write_once(members.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__range", (F.sum("__n").over(W.orderBy("__range")) - F.col("__n")).alias("__before"))
    rank = F.row_number().over(W.partitionBy("__range").orderBy(*order))
    return dealt.join(before, "__range").withColumn(out, F.col("__before") + rank - 1).drop("__range", "__n", "__before")


def build_cube(facts: DataFrame, dims: Sequence[str], member_no: str, measures: dict[str, Column]) -> DataFrame:
    """Cells ``(dims..., bucket, bits, measures...)`` of ``facts``. Facts are
    reduced to a row for each (cell, member) first, so a member with very many
    facts sets its bit once. ``measures`` are sums over the facts."""
    per = facts.groupBy(*dims, member_no).agg(*[F.sum(x).alias(n) for n, x in measures.items()])
    # Spark counts bitmap positions from 1.
    no = F.col(member_no) + 1
    return per.groupBy(*dims, F.bitmap_bucket_number(no).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(no)).alias("bits"), *[F.sum(n).alias(n) for n in measures])


def count_cube(cube: DataFrame, by: Sequence[str], measures: Sequence[str], members: str = "members",
               where: Column | None = None) -> DataFrame:
    """``(by..., members, measures...)``: distinct members and sums for each
    group of the selected cells."""
    cells = cube if where is None else cube.where(where)
    per = cells.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), *[F.sum(m).alias(m) for m in measures])
    ones = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias(members)
    return per.groupBy(*by).agg(ones, *[F.sum(m).alias(m) for m in measures])


def roll_up(cube: DataFrame, dims: Sequence[str], levels: Sequence[Sequence[str]], measures: Sequence[str],
            members: str = "members") -> DataFrame:
    """``(dims..., gid, members, measures...)`` for every level (a subset of
    ``dims``); ``gid`` has a bit for each dimension that is summed over, as
    ``GROUPING_ID(dims)``. Levels come from the cube in one pass."""
    gid = sum((F.grouping(x).cast("int") * (1 << (len(dims) - 1 - i)) for i, x in enumerate(dims)), F.lit(0))
    sets = [[*[F.col(x) for x in level], F.col("bucket")] for level in levels]
    per = cube.groupingSets(sets, *dims, "bucket").agg(
        gid.alias("gid"), F.bitmap_or_agg("bits").alias("bits"), *[F.sum(m).alias(m) for m in measures])
    return per.groupBy(*dims, "gid").agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias(members),
                                         *[F.sum(m).alias(m) for m in measures])
