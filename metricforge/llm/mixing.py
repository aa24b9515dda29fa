"""Mixing sources to target weights by a low-discrepancy schedule.

Each source gets a target number of words: the whole mix is shared by weight,
a source takes at most ``most`` times its own words, and what it cannot take
is shared among the others by weight until none is above its limit.

A source's documents are shuffled by a seeded hash, laid end to end and cut
into blocks of ``block`` words (the last of a source may be shorter). Slot
``j`` of the schedule stands at the van der Corput point ``j`` (its ``bits``
binary digits mirrored behind the point). The points are mapped through the
cumulative numbers of blocks that the sources need: the source whose interval
holds the point is served next; points above all intervals are idle. Every
source so gets exactly its number of slots, spread evenly over the mix. The
slots of a source are ranked, and rank ``r`` takes block ``r`` of the shuffled
source, which starts again after its last block. A source's last slot is cut
where its target is reached.

Everything is DataFrame code, texts do not cross a shuffle, and no source (or
the whole table) meets in one task. Running totals are taken within blocks of
the hash, of the schedule, or of a range of the sources, whose number grows
with the rows; the totals of the blocks give the offsets.

Defined cases: a null source is a source of its own, after all others; a null
text has no words; a document without words is never taken; rows alike in id,
source and text are copies that lie side by side, so any of them may stand
for any other; null ids are documents like others; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricforge.llm.common import each, keep

#: Rows of a block of the hash on average, and slots of a stretch of the
#: schedule.
ROWS = 1 << 14
STRETCH = 1 << 16

WHITE = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; null as empty."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.length(F.regexp_replace(body, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")).cast("long")


def _before(df: DataFrame, value: str, name: str, order: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before each one, by
    ``range`` and, within a range, by ``order``."""
    ranges = df.groupBy("range").agg(F.sum(value).alias("s"))
    ranges = ranges.select("range", (F.sum("s").over(Window.orderBy("range")) - F.col("s")).alias("__off"))
    within = F.sum(value).over(Window.partitionBy("range").orderBy(order)) - F.col(value)
    return df.join(ranges, "range").withColumn(name, F.col("__off") + within).drop("__off")


@dataclass
class Mix:
    """``documents``: ``(doc_id, stratum, size, at, source_size, target)``, a
    row for each document with its place in the shuffled source. ``slots``:
    ``(slot, stratum, block, pass, take)`` in the order of ``slot``.
    ``pieces``: ``(slot, pass, stratum, doc_id, at, first, words)``, which
    words of which documents a slot holds."""

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame

    def taken(self) -> DataFrame:
        """``documents`` with the number of words the mix takes of each."""
        some = self.pieces.groupBy("stratum", "at").agg(F.sum("words").alias("taken"))
        full = self.documents.where("size > 0").join(some, ["stratum", "at"], "left")
        return (full.withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
                .unionByName(self.documents.where("size = 0").withColumn("taken", F.lit(0).cast("long"))))


def share_out(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``sources(total, weight)`` with ``target``. A round looks which sources
    are above their limit at the present share of a unit of weight; only sums
    reach the driver."""
    limit = F.col("total") * F.lit(float(most))
    all_ = sources.agg(F.sum("total"), F.sum("weight")).first()
    whole, weights = float(all_[0] or 0) * share, float(all_[1] or 1)
    left, open_, full = whole, weights, 0
    while True:
        above = limit * F.lit(open_) < F.lit(left) * F.col("weight")
        row = sources.where(above).agg(F.count("*"), F.sum(limit), F.sum("weight")).first()
        if row[0] == full:
            break
        full, left, open_ = row[0], whole - row[1], weights - row[2]
    return sources.withColumn("target", F.when(above, limit).otherwise(
        F.lit(left) * F.col("weight") / F.lit(open_)))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2, block: int = 4096,
        seed: int = 42, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> Mix:
    """The mix of ``docs`` with ``share`` times their words. ``weights`` go to
    the sources in the order of their names, repeating."""
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].alias("doc_id"), word_count(text).alias("size"),
        F.coalesce(F.concat(F.lit("="), docs[source_col].cast("string")), F.lit("null")).alias("stratum"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id_col].cast("string"), F.lit("null")), F.lit(":"),
                       F.md5(text))).alias("key"))
    items = keep(rows.groupBy("stratum", "key").agg(F.min("doc_id").alias("doc_id"), F.min("size").alias("size"),
                                                    F.count("*").alias("copies")), "items")
    many = max(1, items.count() // ROWS)
    digits = max(2, min(15, -(-many.bit_length() // 4)))
    items = items.withColumn("bucket", F.conv(F.substring("key", 1, digits), 16, 10).cast("long"))

    # Sources, numbered by name in ranges.
    names = items.groupBy("stratum").agg(F.sum(F.col("size") * F.col("copies")).alias("total"))
    names = keep(names.repartitionByRange("stratum").withColumn("range", F.spark_partition_id())
                 .withColumn("one", F.lit(1)), "sources")
    cycle = F.array(*(F.lit(int(w)) for w in weights))
    names = _before(names, "one", "number", "stratum").drop("one").withColumn(
        "weight", F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int")))
    names = share_out(keep(names, "weights"), share, most)
    quota = F.floor(F.col("target") + 0.5)
    names = names.withColumn("blocks", F.expr(f"(total + {block - 1}) div {block}"))
    names = names.withColumn("passes", F.when(F.col("total") > 0, F.expr("floor(target + 0.5) div total")).otherwise(0))
    names = names.withColumn("rest", quota - F.col("passes") * F.col("total"))
    names = names.withColumn("n", F.col("passes") * F.col("blocks") + F.expr(f"(rest + {block - 1}) div {block}"))
    names = keep(_before(names, "n", "base", "stratum"), "targets")

    # The schedule: points of each source's interval, and the slots they mirror.
    bits = max(1, int(names.agg(F.sum("n")).first()[0] or 0) - 1).bit_length()
    slots = each(names.where("n > 0").select("stratum", "total", "blocks", "passes", "rest", "n", "base"), "n", "own")
    mirrored = F.reverse(F.lpad(F.bin(F.col("base") + F.col("own")), bits, "0"))
    slots = slots.withColumn("slot", F.conv(mirrored, 2, 10).cast("long"))
    slots = keep(slots.withColumn("stretch", F.expr(f"slot div {STRETCH}")).drop("own", "n", "base"), "slots")
    parts = slots.groupBy("stratum", "stretch").agg(F.count("*").alias("c"))
    parts = parts.select("stratum", "stretch", (F.sum("c").over(Window.partitionBy("stratum").orderBy("stretch"))
                                                - F.col("c")).alias("earlier"))
    rank = F.col("earlier") + F.row_number().over(Window.partitionBy("stratum", "stretch").orderBy("slot")) - 1
    slots = slots.join(parts, ["stratum", "stretch"]).withColumn("rank", rank)
    slots = slots.withColumn("pass", F.expr("rank div blocks")).withColumn("block", F.expr("rank % blocks"))
    end = F.when(F.col("pass") == F.col("passes"), F.col("rest")).otherwise(F.col("total"))
    slots = slots.select("slot", "stratum", "block", "pass",
                         F.least(F.lit(block), end - F.col("block") * block).alias("take"))

    # The shuffled sources, and the blocks their documents lie in.
    lots = items.groupBy("stratum", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("w"))
    lots = lots.select("stratum", "bucket", (F.sum("w").over(Window.partitionBy("stratum").orderBy("bucket"))
                                             - F.col("w")).alias("off"))
    lots = lots.join(names.select("stratum", F.col("total").alias("source_size"), "target"), "stratum")
    words = F.col("size") * F.col("copies")
    start = F.col("off") + F.sum(words).over(Window.partitionBy("stratum", "bucket").orderBy("key")) - words
    laid = items.join(lots, ["stratum", "bucket"]).withColumn("start", start)
    single = laid.where("copies = 1").withColumn("at", F.col("start"))
    several = each(laid.where("copies > 1"), "copies", "copy").withColumn(
        "at", F.col("start") + F.col("copy") * F.col("size"))
    columns = ["doc_id", "stratum", "size", "at", "source_size", "target"]
    documents = keep(single.select(*columns).unionByName(several.select(*columns)), "laid")

    held = documents.where("size > 0").select(
        "stratum", "doc_id", "at", "size",
        F.explode(F.sequence(F.expr(f"at div {block}"), F.expr(f"(at + size - 1) div {block}"))).alias("block"))
    low = F.greatest(F.col("at") - F.col("block") * block, F.lit(0))
    high = F.least(F.col("at") + F.col("size") - F.col("block") * block, F.col("take"))
    pieces = (held.join(slots, ["stratum", "block"]).where(high > low)
              .select("slot", "pass", "stratum", "doc_id", "at",
                      (F.col("block") * block + low - F.col("at")).alias("first"), (high - low).alias("words")))
    return Mix(documents, slots, pieces)


def mix_sql(weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2, seed: int = 42) -> str:
    """Words taken of each document in one statement for a second engine: the
    passes over a shuffled source in closed form, without a schedule."""
    picks = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return rf"""
WITH rows AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         coalesce('=' || source, 'null') AS stratum,
         md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
names AS (
  SELECT stratum, CAST(sum(size) AS DOUBLE) AS total,
         CASE (row_number() OVER (ORDER BY stratum) - 1) % {len(weights)} {picks} END AS weight
  FROM rows GROUP BY stratum),
filled AS (
  SELECT *, sum(total) OVER () * {share} - coalesce(sum({most} * total) OVER before, 0) AS lft,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS opn
  FROM names WINDOW before AS (ORDER BY total / weight, stratum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT lft, opn FROM filled WHERE {most} * total * opn >= lft * weight ORDER BY total / weight, stratum LIMIT 1),
targets AS (
  SELECT stratum, total, CASE WHEN {most} * total * l.opn < l.lft * weight THEN {most} * total
                              ELSE CAST(l.lft AS DOUBLE) * weight / l.opn END AS target
  FROM filled, level l),
laid AS (
  SELECT doc_id, size, total, target, CAST(floor(target + 0.5) AS BIGINT) AS quota, CAST(total AS BIGINT) AS own,
         sum(size) OVER (PARTITION BY stratum ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS place
  FROM rows JOIN targets USING (stratum))
SELECT doc_id, CAST(size AS BIGINT) AS size, own AS source_size, CAST(target AS DOUBLE) AS target,
       CAST(CASE WHEN own = 0 THEN 0 ELSE quota // own * size + greatest(0, least(size, quota % own - place)) END AS BIGINT)
         AS taken
FROM laid"""
