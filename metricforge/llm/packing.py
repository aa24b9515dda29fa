"""Best-fit packing of documents into sequences of a fixed number of tokens.

Only lengths matter for a packing, and there are at most ``capacity`` of
them: the pieces are counted by length, and the plan is made on the counts.
Pieces above a third of the capacity are matched first, the largest with the
largest that fits beside it, two in a sequence at most; the smaller ones, in
falling order, go to the tightest gap that takes them. Sequences alike in
their lengths are one line of the plan with a multiplicity, so the plan's
size is bounded by the capacity and not by the data. Spark then numbers the
pieces of each length and deals them to the plan's places.

Defined cases: a null text counts as empty and is one piece with the end id
alone; a document longer than a sequence is cut into full pieces, of which
the first may be shorter; rows with one id are packed one by one; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricforge.llm.bpe import chunks
from metricforge.llm.common import FILE, ROW, addressed, keep, map_arrow
from metricforge.llm.token_ids import encode, with_end

#: Blocks in which the pieces of one length are numbered.
BLOCKS = 4096
BLOCK_ROWS = 1 << 14


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(address, doc_id, piece, start, length, ids_crc32[, ids binary])``."""
    def run(batches):
        for batch in batches:
            for begin, texts in chunks(batch.column(3).to_pylist()):
                rows, piece, start, length, crc, raw = [], [], [], [], [], []
                for i, ids in enumerate(with_end(*encode(tokenizer_path, texts), end_id)):
                    rest = len(ids) % capacity
                    cuts = [*([0] if rest else []), *range(rest, len(ids), capacity)]
                    for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)], strict=True)):
                        data = ids[a:b].tobytes()
                        rows.append(begin + i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(data))
                        if with_ids:
                            raw.append(data)
                cols = [*(batch.column(c).take(pa.array(rows, pa.int64())) for c in range(3)),
                        pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = [FILE, ROW, "doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(raw, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    src = addressed(docs)
    src = src.select(FILE, ROW, src[id_col].alias("doc_id"), src[text_col].alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_arrow(src, run, f"{FILE} long, {ROW} long, doc_id {kind}, piece int, start long, length long, "
                               "ids_crc32 long" + ", ids binary" * with_ids)


class _Plan:
    """Sequences grouped by their remaining gap, as ``lengths -> count``."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_gap: dict[int, Counter] = defaultdict(Counter)
        self.gaps: list[int] = []

    def add(self, lengths: tuple[int, ...], count: int) -> None:
        gap = self.capacity - sum(lengths)
        if not self.by_gap[gap]:
            bisect.insort(self.gaps, gap)
        self.by_gap[gap][lengths] += count

    def take(self, gap: int, most: int) -> tuple[tuple[int, ...], int]:
        lengths, have = next(iter(self.by_gap[gap].items()))
        count = min(most, have)
        self.by_gap[gap][lengths] -= count
        if have == count:
            del self.by_gap[gap][lengths]
            if not self.by_gap[gap]:
                self.gaps.remove(gap)
        return lengths, count

    def lines(self) -> list[tuple[tuple[int, ...], int]]:
        return [x for gap in self.gaps for x in self.by_gap[gap].items()]


def plan_sequences(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths in a sequence, how many such sequences)`` for ``counts`` of
    pieces by length."""
    plan = _Plan(capacity)
    third = capacity // 3
    large = {n: c for n, c in counts.items() if n > third and c}
    sizes = sorted(large)
    # Greedy matching: the largest piece takes the largest partner that fits.
    while sizes:
        top = sizes[-1]
        at = bisect.bisect_right(sizes, capacity - top) - 1
        if at < 0:
            plan.add((top,), large[top])
            sizes.pop()
            continue
        mate = sizes[at]
        pairs = large[top] // 2 if mate == top else min(large[top], large[mate])
        if pairs:
            plan.add((top, mate), pairs)
        elif large[top]:
            plan.add((top,), 1)      # the last of its length, without a partner
            large[top] -= 1
        large[top] -= pairs
        large[mate] -= pairs
        for n in {top, mate}:
            if not large[n]:
                sizes.remove(n)
    # Best fit of the small ones, in falling order.
    for n in sorted((n for n, c in counts.items() if n <= third and c), reverse=True):
        left = counts[n]
        while left:
            at = bisect.bisect_left(plan.gaps, n)
            if at == len(plan.gaps):
                # No gap is left: full stacks in new sequences, then the rest.
                stack = capacity // n
                if left // stack:
                    plan.add((n,) * stack, left // stack)
                if left % stack:
                    plan.add((n,) * (left % stack), 1)
                break
            gap = plan.gaps[at]
            stack = min(gap // n, left)
            lengths, count = plan.take(gap, left // stack)
            plan.add(lengths + (n,) * stack, count)
            left -= stack * count
    return plan.lines()


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset``. ``pieces`` has the
    address, ``piece`` and ``length`` (1 to ``capacity``)."""
    spark = pieces.sparkSession
    pieces = keep(pieces, "pieces")
    many = max(BLOCKS, pieces.count() // BLOCK_ROWS)
    blocks = pieces.withColumn("block", F.expr(f"pmod(xxhash64({FILE}, {ROW}, piece), {many})"))
    sizes = blocks.groupBy("length", "block").agg(F.count("*").alias("c"))
    before = sizes.select("length", "block", (F.sum("c").over(Window.partitionBy("length").orderBy("block"))
                                              - F.col("c")).alias("before"))
    # At most one row for each possible length.
    counts = {r["length"]: r["c"] for r in sizes.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    places, sequence = [], 0
    used: Counter = Counter()
    for lengths, count in plan_sequences(counts, capacity):
        offset = 0
        for n in lengths:
            places.append((n, used[n], used[n] + count, sequence - used[n], offset))
            used[n] += count
            offset += n
        sequence += count
    places = spark.createDataFrame(places, "length long, first long, stop long, shift long, offset long")
    rank = (F.col("before") + F.row_number().over(
        Window.partitionBy("length", "block").orderBy(FILE, ROW, "piece")) - 1).alias("rank")
    ranked = blocks.join(before, ["length", "block"]).select(*pieces.columns, rank)
    # The plan is bounded by the capacity (see plan_sequences), so it is broadcast.
    return (ranked.join(F.broadcast(places), "length").where("rank >= first and rank < stop")
            .withColumn("sequence_id", F.col("rank") + F.col("shift"))
            .select(*pieces.columns, "sequence_id", "offset"))
