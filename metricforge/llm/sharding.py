"""Shards by proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source and ranked; the
fractional rank (rank minus a seeded phase of the source, over the source's
size) spreads every source evenly over 0 to 1. All rows sorted by it and cut
into equal runs give shards that differ by one row at most and all have the
mixture of the whole.

No rank needs a source, or the whole table, in one task: ranks are counted
within blocks of the hash (of the fraction), whose number grows with the rows,
and the blocks' totals give the offsets.

Defined cases: a null source is a stratum of its own; a null text has no
bytes; the hash is of id, checksum and size, so rows without an id are dealt
like others; rows alike in all of these and the source are copies, counted
first and ranked side by side; fewer rows than shards leave some
shards empty; an empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricforge.llm.common import each, keep

#: Hexadecimal digits of the hash that choose a block, blocks of the fraction
#: (at least), and rows of a block from which there are more.
DIGITS = 3
BLOCKS = 16 ** DIGITS
ROWS = 1 << 14


def interleave(docs: DataFrame, shards: int, seed: int = 42, id_col: str = "doc_id",
               source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(doc_id, source, size, text_crc32, shard, slot)`` for every row;
    ``size`` is the text's bytes plus 16."""
    text = F.coalesce(docs[text_col], F.lit(""))
    salt = f"{seed}:"
    rows = docs.select(
        docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), docs[source_col].cast("string")), F.lit("null")).alias("stratum"))
    same = ["doc_id", "source", "size", "text_crc32", "stratum"]
    rows = rows.groupBy(*same).agg(F.count("*").alias("copies"))
    rows = keep(rows.withColumn("key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(
        F.col("doc_id").cast("string"), F.lit("null")), "text_crc32", "size"))), "rows")
    digits, n = DIGITS, rows.count()
    while 16 ** digits * ROWS < n:
        digits += 1
    cells_ = max(BLOCKS, 16 ** digits)
    rows = rows.withColumn("block", F.conv(F.substring("key", 1, digits), 16, 10).cast("long"))
    ties = ["key", F.col("doc_id").asc_nulls_first(), "text_crc32", "size"]

    # Rank within the source: offset of the block plus rank within the block.
    upto = Window.partitionBy("stratum").orderBy("block")
    whole = Window.partitionBy("stratum")
    blocks = rows.groupBy("stratum", "block").agg(F.sum("copies").alias("c"))
    blocks = blocks.select("stratum", "block", (F.sum("c").over(upto) - F.col("c")).alias("before"),
                           F.sum("c").over(whole).alias("n"))
    phase = F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col("stratum"))), 1, 8), 16, 10).cast("double")
    upto_row = Window.partitionBy("stratum", "block").orderBy(*ties).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("before") + F.coalesce(F.sum("copies").over(upto_row), F.lit(0)) + 1
    ranked = rows.join(blocks, ["stratum", "block"]).withColumn("rank", rank).drop("block", "before")
    several = each(ranked.where("copies > 1"), "copies", "copy").withColumn("rank", F.col("rank") + F.col("copy"))
    ranked = ranked.where("copies = 1").unionByName(several.drop("copy")).withColumn(
        "place", (F.col("rank").cast("double") - phase / F.lit(2.0 ** 32)) / F.col("n").cast("double"))
    ranked = ranked.withColumn("cell", F.least(F.floor(F.col("place") * cells_), F.lit(cells_ - 1)).cast("long"))
    ranked = keep(ranked.drop("n", "rank", "copies"), "places")

    # The same again for the order of all rows. One row for each cell.
    cells = ranked.groupBy("cell").agg(F.count("*").alias("c"))
    cells = cells.select("cell", (F.sum("c").over(Window.orderBy("cell")) - F.col("c")).alias("before"),
                         F.sum("c").over(Window.partitionBy()).alias("total"))
    within = F.row_number().over(Window.partitionBy("cell").orderBy("place", "stratum", *ties))
    placed = (ranked.join(cells, "cell").withColumn("at", F.col("before") + within - 1)
              .withColumn("shard", F.expr(f"(at * {shards}) div total")))
    return placed.select("doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                         F.expr(f"at - (shard * total + {shards - 1}) div {shards}").alias("slot"))


def interleave_sql(shards: int, seed: int = 42) -> str:
    """The placement in one statement for a second engine, without blocks.
    The checksum is folded byte by byte, by a table of the polynomial."""
    return f"""
WITH steps AS (
  SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), [CAST(0 AS BIGINT) FOR z IN range(8)]),
                          lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) r(i)),
base AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, coalesce('=' || source, 'null') AS stratum,
         xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT),
                        [CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),
           lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]))) AS text_crc32
  FROM documents, steps),
keyed AS (
  SELECT *, md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || text_crc32 || ':' || size) AS key FROM base),
spread AS (
  SELECT *, (CAST(row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id NULLS FIRST, text_crc32, size) AS DOUBLE)
             - CAST(CAST('0x' || substr(md5('{seed}:' || stratum), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0)
            / CAST(count(*) OVER (PARTITION BY stratum) AS DOUBLE) AS place
  FROM keyed),
line AS (
  SELECT *, row_number() OVER (ORDER BY place, stratum, key, doc_id NULLS FIRST, text_crc32, size) - 1 AS pos,
         count(*) OVER () AS total
  FROM spread)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(pos * {shards} // total AS INTEGER) AS shard,
       CAST(pos - (pos * {shards} // total * total + {shards - 1}) // {shards} AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM line"""
