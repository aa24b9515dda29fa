"""SimHash near-duplicates with BK-trees.

Every document gets a 64-bit fingerprint: per bit, the majority over the
XXH64 hashes of its word shingles. Two fingerprints link when they differ
in at most ``radius`` bits. Distinct fingerprints are dealt into shards, a
BK-tree is built in each shard (children keyed by their integer Hamming
distance to the parent), and searches follow only the edges within the
radius.

Sending every shard's tree to every task would broadcast data that grows
with the corpus. Instead the 64 bits are cut into ``radius + 1`` bands: two
linked fingerprints agree on one band at least, so a shard is one band
value, and a fingerprint visits only its ``radius + 1`` shards. The members of
a shard with more than ``TREE_NODES`` agree on its band, so links among them
differ in the other bits only: those are cut into ``radius + 1`` bands again,
until every shard is small (a few free bits leave few different members). No
member is left out, and the work for a hot band does not grow with its square.

Defined cases: null and empty texts (and texts of white space) have the
fingerprint zero and link like any other; equal fingerprints always link; a
null doc_id is never a component's name unless the whole component has no
other; repeated rows repeat in the result; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricforge.llm.common import FILE, ROW, addressed, columns, components, keep, map_arrow, union

BITS = 64
#: Nodes of one BK-tree (more where few bits tell the members apart), and
#: shingles whose bits are counted at once.
TREE_NODES = 4096
SHINGLES_AT_ONCE = 1 << 16


def _hashes(text: str | None, shingle: int, seed: int) -> list[int]:
    words = (text or "").encode().lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in
            zip(begins[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)]


def _majorities(hashes: list[list[int]]) -> np.ndarray:
    """One fingerprint for each list of hashes."""
    count = np.array([len(x) for x in hashes], np.int64)
    ones = np.zeros((len(hashes), BITS), np.int64)
    flat = np.fromiter((h for x in hashes for h in x), np.uint64, int(count.sum()))
    owner = np.repeat(np.arange(len(hashes)), count)
    for a in range(0, len(flat), SHINGLES_AT_ONCE):
        part, own = flat[a:a + SHINGLES_AT_ONCE], owner[a:a + SHINGLES_AT_ONCE]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
        begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        ones[own[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > count[:, None], axis=1).view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(address, doc_id, fp)``: the fingerprint as a signed 64-bit integer."""
    def run(batches):
        for batch in batches:
            found, pending, size = [], [], 0
            for text in batch.column(3).to_pylist():
                pending.append(_hashes(text, shingle, seed))
                size += len(pending[-1])
                if size >= SHINGLES_AT_ONCE:
                    found.append(_majorities(pending))
                    pending, size = [], 0
            if pending:
                found.append(_majorities(pending))
            fp = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fp.view(np.int64))],
                                             names=[FILE, ROW, "doc_id", "fp"])

    src = addressed(docs)
    src = src.select(FILE, ROW, src[id_col].alias("doc_id"), src[text_col].alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_arrow(src, run, f"{FILE} long, {ROW} long, doc_id {kind}, fp long")


class BKTree:
    """BK-tree over 64-bit fingerprints; batches of queries walk it together."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.children: list[dict[int, int]] = [{} for _ in points]
        todo = [np.arange(len(points))] if len(points) else []
        while todo:
            own = todo.pop()            # the first is the node, the others hang below it
            far = np.bitwise_count(points[own[1:]] ^ points[own[0]])
            for d in np.unique(far).tolist():
                below = own[1:][far == d]
                self.children[own[0]][d] = int(below[0])
                todo.append(below)

    def search(self, queries: np.ndarray, radius: int):
        """``(query, point)`` index pairs within the radius, in batches."""
        todo = [(0, np.arange(len(queries)))] if len(self.points) and len(queries) else []
        while todo:
            node, who = todo.pop()
            far = np.bitwise_count(queries[who] ^ self.points[node]).astype(np.int64)
            hit = who[far <= radius]
            if len(hit):
                yield hit, node
            for d, child in self.children[node].items():
                near = who[np.abs(far - d) <= radius]
                if len(near):
                    todo.append((child, near))


def _search_shard(tree: np.ndarray, batches, radius: int):
    """Edges ``(a, b)`` that connect what the shard's links connect: one for
    each query at most and one for each tree node at most."""
    bk = BKTree(tree)
    parent = np.arange(len(tree))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = int(parent[x])
        return x

    for queries in batches:
        first = np.full(len(queries), -1, np.int64)
        for hit, node in bk.search(queries, radius):
            for other in np.unique(first[hit]).tolist():
                if other >= 0:
                    parent[find(other)] = find(node)
            first[hit] = node
        linked = (first >= 0) & (queries != tree[first])
        yield queries[linked], tree[first[linked]]
    root = np.array([find(i) for i in range(len(tree))], np.int64)
    moved = root != np.arange(len(tree))
    yield tree[moved], tree[root[moved]]


def _bands(mask: int, radius: int) -> list[int]:
    """``mask`` plus each of ``radius + 1`` bands of the bits it leaves free."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    edges = np.linspace(0, len(free), radius + 2).astype(int)
    return [mask | sum(1 << b for b in free[a:z]) for a, z in zip(edges[:-1], edges[1:], strict=True)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def shards(fps: DataFrame, radius: int) -> DataFrame:
    """``(mask, value, fp)``: the shards (fingerprints that agree on the bits
    of ``mask``) of two members and more. Two fingerprints within the radius
    meet in one at least."""
    spark = fps.sparkSession
    rows, masks, small = fps.select("fp", F.lit(0).cast("long").alias("mask")), [0], []
    while True:
        # A row for each mask of this level: radius + 1 to the level at most.
        cuts = [(_signed(m), _signed(x)) for m in masks for x in _bands(m, radius)]
        rows = (rows.join(F.broadcast(spark.createDataFrame(cuts, "mask long, cut long")), "mask")
                .select("fp", F.col("cut").alias("mask"), F.col("cut").bitwiseAND(F.col("fp")).alias("value")))
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("size")).where("size > 1")
        rows = keep(rows.join(sizes, ["mask", "value"]), "shards")
        large = (F.col("size") > TREE_NODES) & (F.bit_count("mask") < BITS - radius)
        small.append(rows.where(~large).select("mask", "value", "fp"))
        rows = rows.where(large).select("fp", "mask")
        if rows.isEmpty():
            return union(small)
        masks = sorted({x for m in masks for x in _bands(m, radius)})


def link_edges(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Edges between distinct fingerprints ``fps(fp)`` whose closure is the
    closure of all links within ``radius`` bits."""
    def run(batches):
        def search(held):
            points = np.concatenate(held)
            for a, b in _search_shard(points, [points], radius):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                     names=["a", "b"])

        key, held = None, []
        for batch in batches:
            mask, value, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cut = np.flatnonzero(np.append(True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])))
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(fp)).tolist(), strict=True):
                now = (mask[a], value[a])
                if now != key and held:
                    yield from search(held)
                    held = []
                key = now
                held.append(fp[a:b].view(np.uint64))
        if held:
            yield from search(held)

    # A number of its own, so that adaptive execution does not merge the few
    # bytes of many searches into one task.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(shards(fps, radius).repartition(parts, "mask", "value").sortWithinPartitions("mask", "value"),
                     run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(address, doc_id, fp, root, component_id)`` for every row; the
    component is named by its smallest doc_id, ``root`` is its smallest
    fingerprint."""
    rows = keep(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    reps = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    linked = components(link_edges(rows.select("fp").distinct(), radius))
    named = (reps.join(linked, reps["fp"] == linked["node"], "left")
             .select("fp", "low", F.coalesce("component", "fp").alias("root")))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select(FILE, ROW, "doc_id", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id
    (null last; the first by address among equals)."""
    src = addressed(docs)
    rows = near_duplicates(src, shingle, radius, seed, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", FILE, ROW)
    stay = rows.groupBy("root").agg(F.min(order).alias("s")).select(f"s.{FILE}", f"s.{ROW}")
    return src.join(stay, [FILE, ROW], "left_semi").select(*columns(docs))
