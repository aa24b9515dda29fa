"""Token-id files with a minimal perfect hash index.

Layout of a store (a folder of Parquet files, so that any file system Spark
writes to can hold it):

``payload/``  one row for each block: ``shard``, ``block``, ``ids`` (the raw
              ids, little-endian, two bytes each if the vocabulary allows,
              else four), ``doc_ids`` and ``counts`` of its documents.
              Documents lie in ascending id order over shards and blocks.
``index/``    one row for each index part: the bit levels of a minimal
              perfect hash over the part's keys (Limasset et al. 2017), and
              by slot a 32-bit fingerprint of the key, the place of its
              first document (shard, block, offset, count, global start) and
              the number of its documents.

A key is hashed to its part, through the part's levels to its slot, and the
fingerprint tells strangers off: constant time for each key, whatever the
store's size. A part holds about ``PART_KEYS`` keys, however many documents
share one; the others of a shared key are found by the payload's ids.

Defined cases: a null text counts as empty and has the end id alone;
documents with a null id are stored first and have no key, but are returned
by their place in the payload if ``unkeyed``; documents that share an id are all returned for it; an empty table gives an empty store.
Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricforge.llm.bpe import chunks
from metricforge.llm.common import CLEANUP, FILE, ROW, addressed, keep, map_arrow, shared_path, ship
from metricforge.llm.token_ids import added_tokens, with_end
from metricforge.llm.token_ids import encode as encode_ids

#: Ids in a block, keys in a part, and bits for each key in a level.
BLOCK_IDS = 1 << 19
PART_KEYS = 1 << 15
GAMMA = 2
FINGERPRINT = ("fp", "<u4")
#: What a slot's entries hold.
PLACES = (("shard", "<i4"), ("block", "<i4"), ("offset", "<i4"), ("count", "<i8"), ("start", "<i8"),
          ("documents", "<i8"))


def _mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of integer keys (the finaliser of splitmix64)."""
    x = keys.astype(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """Levels of bits: a key's slot is the rank of its first set bit."""

    levels: list[np.ndarray]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct."""
        levels = []
        while len(keys):
            size = max(64, GAMMA * len(keys))
            at = (_mix(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for a key that meets no set bit."""
        slot = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for n, bits in enumerate(self.levels):
            at = (_mix(keys[left], n) % np.uint64(len(bits))).astype(np.int64)
            rank = np.cumsum(bits)
            hit = bits[at]
            slot[left[hit]] = base + rank[at[hit]] - 1
            base += int(rank[-1])
            left = left[~hit]
        return slot

    def to_columns(self) -> tuple[list[int], bytes]:
        return ([len(b) for b in self.levels], b"".join(np.packbits(b).tobytes() for b in self.levels))

    @classmethod
    def from_columns(cls, sizes: list[int], raw: bytes) -> PerfectHash:
        levels, at = [], 0
        for n in sizes:
            width = -(-n // 8)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, width, at), count=n).astype(bool))
            at += width
        return cls(levels)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def _part_row(part: int, parts: int, keys: np.ndarray, places: dict[str, np.ndarray]) -> dict:
    mph = PerfectHash.build(keys)
    order = np.argsort(mph.slots(keys))
    sizes, bits = mph.to_columns()
    return {"part": part, "parts": parts, "sizes": sizes, "bits": bits,
            "fp": _fingerprint(keys)[order].astype("<u4").tobytes(),
            **{n: places[n][order].astype(t).tobytes() for n, t in PLACES}}


INDEX_SCHEMA = ("part long, parts long, sizes array<int>, bits binary, fp binary, "
                + ", ".join(f"{n} binary" for n, _ in PLACES))


def write_store(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write ``payload/`` and ``index/`` below ``path``."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path) as f:
        vocabulary = json.load(f)["model"]["vocab"]
    width = "<u2" if max(end_id, *vocabulary.values(), *added_tokens(tokenizer_path)[0].values()) < 1 << 16 else "<u4"
    src = addressed(docs)
    src = src.select(src[id_col].cast("long").alias("doc_id"), src[text_col].alias("text"), FILE, ROW)

    def encode(batches):
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        ids, keys, counts, size = [], [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()),
                 pa.array([np.concatenate(ids).astype(width).tobytes()], pa.binary()),
                 pa.array([keys], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))],
                names=["shard", "block", "ids", "doc_ids", "counts"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            for begin, texts in chunks(batch.column(1).to_pylist()):
                for i, x in enumerate(with_end(*encode_ids(tokenizer_path, texts), end_id)):
                    ids.append(x)
                    keys.append(names[begin + i])
                    counts.append(len(x))
                    size += len(x)
                    if size >= BLOCK_IDS:
                        yield flush()
                        ids, keys, counts, size, block = [], [], [], 0, block + 1
        if ids:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), FILE, ROW]
    payload = map_arrow(src.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"), encode,
                        "shard int, block int, ids binary, doc_ids array<long>, counts array<long>")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        payload.write.option("compression", "zstd").parquet(f"{path}/payload")
        _write_index(spark, path)
    finally:
        spark.conf.set(CLEANUP, before)


def _places(blocks: DataFrame, keyed: bool) -> DataFrame:
    """``(key, shard, block, offset, count, start)`` of the documents with an
    id (``keyed``) or without."""
    # Global starts: totals of the shards (one row each), then of the blocks.
    total = F.expr("aggregate(counts, 0L, (a, x) -> a + x)")
    sums = blocks.select("shard", "block", total.alias("n"))
    shards = sums.groupBy("shard").agg(F.sum("n").alias("n"))
    shards = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    starts = (sums.select("shard", "block", (F.sum("n").over(Window.partitionBy("shard").orderBy("block"))
                                             - F.col("n")).alias("block_start"))
              .join(shards, "shard")
              .select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("base")))

    def places(batches):
        for batch in batches:
            for shard, block, base, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                count = np.array(counts, np.int64)
                offset = np.cumsum(count) - count
                has = np.array([(k is not None) == keyed for k in keys])
                n = int(has.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k in keys if (k is not None) == keyed], pa.int64()), pa.array([shard] * n, pa.int32()),
                     pa.array([block] * n, pa.int32()), pa.array(offset[has]), pa.array(count[has]),
                     pa.array(base + offset[has])],
                    names=["key", "shard", "block", "offset", "count", "start"])

    return map_arrow(blocks.join(starts, ["shard", "block"]).select("shard", "block", "base", "doc_ids", "counts"),
                     places, "key long, shard int, block int, offset long, count long, start long")


def _write_index(spark: SparkSession, path: str) -> None:
    blocks = spark.read.parquet(f"{path}/payload").select("shard", "block", "doc_ids", "counts")
    place = F.struct("start", "shard", "block", "offset", "count")
    rows = (_places(blocks, True).groupBy("key").agg(F.min(place).alias("p"), F.count("*").alias("documents"))
            .select("key", "p.*", "documents"))
    documents = blocks.agg(F.sum(F.size("doc_ids"))).first()[0] or 0
    parts = max(1, -(-documents // PART_KEYS))

    def build(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_numpy() for n in table.column_names}
        row = _part_row(int(col["part"][0]), parts, col["key"], col)
        return pa.table({n: pa.array([v]) if n != "sizes" else pa.array([v], pa.list_(pa.int32()))
                         for n, v in row.items()})

    index = (rows.withColumn("part", F.expr(f"pmod(xxhash64(key), {parts})"))
             .groupBy("part").applyInArrow(build, INDEX_SCHEMA))
    index.write.option("compression", "zstd").parquet(f"{path}/index")


def find(keys: DataFrame, path: str) -> DataFrame:
    """``(key, shard, block, offset, count, start)`` of the documents stored
    under ``keys(key)``; unknown and null keys give nothing."""
    spark = keys.sparkSession
    found = keep(find_first(keys, path), "places")
    alone = found.where("documents = 1").drop("documents")
    shared = found.where("documents > 1").select("key")
    if shared.isEmpty():
        return alone
    blocks = spark.read.schema("shard int, block int, doc_ids array<long>, counts array<long>").parquet(f"{path}/payload")
    return alone.unionByName(_places(blocks, True).join(shared, "key", "left_semi"))


def find_first(keys: DataFrame, path: str) -> DataFrame:
    """``(key, shard, block, offset, count, start, documents)``: the place of
    the first document of each of ``keys(key)``, and how many it has."""
    spark = keys.sparkSession
    ship(spark)
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")
    parts = index.agg(F.max("parts")).first()[0] or 1
    keys = keys.select(F.col("key").cast("long").alias("key")).where("key is not null").distinct()
    keys = keys.withColumn("part", F.expr(f"pmod(xxhash64(key), {parts})"))

    def look(wanted: pa.Table, held: pa.Table) -> pa.Table:
        out = {n: np.zeros(0, np.int64) for n in ("key", *(n for n, _ in PLACES))}
        if wanted.num_rows and held.num_rows:
            row = held.to_pylist()[0]
            key = wanted.column("key").to_numpy()
            slot = PerfectHash.from_columns(row["sizes"], row["bits"]).slots(key)
            prints = np.frombuffer(row["fp"], "<u4")
            known = slot >= 0
            known[known] = prints[slot[known]] == _fingerprint(key[known])
            out = {"key": key[known], **{n: np.frombuffer(row[n], t)[slot[known]] for n, t in PLACES}}
        return pa.table({n: pa.array(v.astype(np.int64)) for n, v in out.items()})

    return keys.groupBy("part").cogroup(index.groupBy("part")).applyInArrow(
        look, "key long, shard long, block long, offset long, count long, start long, documents long")


def find_unkeyed(spark: SparkSession, path: str) -> DataFrame:
    """``find`` for the documents without an id. They lie first, so the blocks
    that hold one tell their starts."""
    ship(spark)
    blocks = spark.read.schema("shard int, block int, doc_ids array<long>, counts array<long>").parquet(
        f"{path}/payload")
    return _places(blocks.where("exists(doc_ids, x -> x is null)"), False)


def read_ids(keys: DataFrame, path: str, width: int | None = None, unkeyed: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, ids array<int>)`` of the
    documents stored under ``keys(key)``, with ``unkeyed`` also of those
    without an id: places from the index, ids from the payload files."""
    spark = keys.sparkSession
    places = find(keys, path)
    if unkeyed:
        places = places.unionByName(find_unkeyed(spark, path))
    wanted = (places.groupBy("shard", "block")
              .agg(F.collect_list(F.struct("key", "offset", "count", "start")).alias("wanted")))
    payload = spark.read.schema("shard int, block int, ids binary, doc_ids array<long>, counts array<long>").parquet(
        f"{path}/payload").select("shard", "block", "ids", F.expr("aggregate(counts, 0L, (a, x) -> a + x)").alias("n"))

    def cut(batches):
        for batch in batches:
            for raw, n, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")
                found = [ids[w["offset"]:w["offset"] + w["count"]].astype("<u4") for w in asked]
                ends = np.cumsum([len(x) for x in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["key"] for w in asked], pa.int64()), pa.array([w["start"] for w in asked], pa.int64()),
                     pa.array([len(x) for x in found], pa.int64()),
                     pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)),
                                              pa.array(np.concatenate(found).astype(np.int32)))],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return map_arrow(payload.join(wanted, ["shard", "block"]).select("ids", "n", "wanted"), cut,
                     "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")


def fresh_path(spark: SparkSession) -> str:
    return shared_path(spark, "tokens")
