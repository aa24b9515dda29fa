"""Exact substring dedup over a sorted suffix array.

Every byte covered by a ``length``-byte string that also starts anywhere
else is found and can be removed; strings never cross documents, and are
judged on the input as it is.

Sorting the suffixes of every byte would move each byte some 200 times.
Instead the array is sparse: each window of ``length`` bytes selects one
anchor, the leftmost smallest hash of its ``ANCHOR``-byte strings. Equal
windows select the same anchor at the same place, so no repeat is lost.
Consecutive windows with one anchor form a unit.

1. Units are counted by content. A unit that occurs twice is repeated in
   full; an anchor that occurs once ends there.
2. The other units of a repeated anchor are compared window by window: the
   suffixes go to buckets by their leading bytes between sampled splitters
   (a range partitioning), and every bucket sorts them with a multikey
   quicksort that looks at eight bytes at a time and only goes on with the
   suffixes that are still equal.
3. An anchor with more than ``GROUP_UNITS`` units would fill a bucket. Its
   windows are dealt over all tasks by content and compared across the
   buckets' boundaries through a count per window.

Texts pass a shuffle twice: once to cut the units to compare, once to
remove. Contents count as equal by a 128-bit hash in steps 1 and 3, and by
their bytes in step 2.

Defined cases: a null text counts as empty; a text shorter than ``length``
loses nothing; repeated rows are repeats of each other; an empty table gives
an empty result; null or repeated ids do not matter, because rows are held
apart by their address. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricforge.llm.common import FILE, ROW, addressed, columns, keep, map_arrow

#: Bytes whose hash selects anchors, bytes handled at once, units of one
#: anchor that one bucket compares, and windows sorted at once.
ANCHOR = 32
CHUNK_BYTES = 1 << 19
GROUP_UNITS = 5000
WINDOWS_AT_ONCE = 1 << 20
WORD = 8
#: A unit's name: the hash of its anchor, and both halves of its own.
UNIT = ["h", "u", "v"]


def _anchor_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``ANCHOR`` bytes from each position, by doubling."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    width, factor = 1, 0xD6E8FEB86659FD93
    while width < ANCHOR:
        right = h[width:]
        h = h[:-width] * np.uint64(factor) + (right ^ (right >> np.uint64(31)))
        factor = factor * factor % 2**64
        width *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    left = width - step
    return np.minimum(x[:len(x) - left], x[left:]) if left else x


def units(texts: list[bytes], length: int):
    """Units of several texts: ``(text, first window, windows, place of the
    anchor in the unit, hash of the anchor, both halves of the unit's hash)``."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = b"".join(texts)
    if len(joined) < length:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 3
    raw = np.frombuffer(joined, np.uint8)
    h = _anchor_hashes(raw)
    # The high half decides, the position breaks ties to the left.
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    anchor = (_sliding_min(key, length - ANCHOR + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    window = np.arange(len(anchor))
    window = window[owner[window] == owner[window + length - 1]]
    anchor, owner = anchor[window], owner[window]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))[:len(window)]
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(window)))
    at = window[begin]
    digest = xxhash.xxh3_128_digest
    content = b"".join([digest(joined[a:b]) for a, b in
                        zip(at.tolist(), (at + count + length - 1).tolist(), strict=True)])
    content = np.frombuffer(content, np.uint64).reshape(-1, 2)
    base = (np.cumsum(size) - size)[owner[begin]]
    return [owner[begin], at - base, count, anchor[begin] - at, h[anchor[begin]],
            content[:, 0].copy(), content[:, 1].copy()]


def _units_of(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        def emit(batch, begin, texts):
            who, at, count, place, *hashes = units(texts, length)
            who = pa.array(who + begin)
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(who), batch.column(1).take(who), pa.array(at), pa.array(count.astype(np.int32)),
                 pa.array(place.astype(np.int32)), *(pa.array(x.view(np.int64)) for x in hashes)],
                names=[FILE, ROW, "at", "n", "place", *UNIT])

        for batch in batches:
            run_, begin, size = [], 0, 0
            for i, text in enumerate(batch.column(2).to_pylist()):
                run_.append((text or "").encode())
                size += len(run_[-1])
                if size >= CHUNK_BYTES:
                    yield emit(batch, begin, run_)
                    run_, begin, size = [], i + 1, 0
            if run_:
                yield emit(batch, begin, run_)

    return map_arrow(docs.select(FILE, ROW, "text"), run,
                     f"{FILE} long, {ROW} long, at long, n int, place int, h long, u long, v long")


def multikey_groups(raw: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at ``start`` have the same ``length`` bytes as
    another one of their ``group``: a multikey quicksort, all partitions of a
    level at once. Each level sorts the partitions by the next eight bytes
    and drops what stands alone."""
    words = np.ndarray((len(raw) - WORD + 1,), ">u8", raw.tobytes(), strides=(1,))
    left = np.arange(len(start))
    depths = [length - WORD, *range(0, length - WORD, WORD)]  # the closing bytes first: most pairs end there
    for depth in depths:
        if not len(left):
            break
        word = words[start[left] + depth].astype(np.uint64)
        order = np.lexsort((word, group))
        word, group, left = word[order], group[order], left[order]
        new = np.append(True, (word[1:] != word[:-1]) | (group[1:] != group[:-1]))
        group = np.cumsum(new)
        many = np.bincount(group)[group] > 1
        left, group = left[many], group[many]
    same = np.zeros(len(start), bool)
    same[left] = True
    return same


def _compare(rows: list[tuple], length: int):
    """``rows``: (h, u, v, full, place, content) of whole groups of one lead.
    Yields (h, u, v, first repeated window, end) of units not known full."""
    raw = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
    size = np.fromiter((len(r[5]) for r in rows), np.int64, len(rows))
    count = size - length + 1
    place = np.fromiter((r[4] for r in rows), np.int64, len(rows))
    lead = {}
    group = np.fromiter((lead.setdefault(r[5][r[4]:r[4] + ANCHOR], len(lead)) for r in rows), np.int64, len(rows))
    row = np.repeat(np.arange(len(rows)), count)
    i = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    # Equal windows have their anchor at the same place.
    key = group[row] * length + (place[row] - i)
    same = multikey_groups(raw, np.repeat(np.cumsum(size) - size, count) + i, key, length)
    open_ = ~np.fromiter((r[3] for r in rows), bool, len(rows))
    for a, b, k in _runs(same & open_[row], row, i):
        yield *rows[k][:3], a, b


def _runs(mark: np.ndarray, row: np.ndarray, i: np.ndarray):
    at = np.flatnonzero(mark)
    if not len(at):
        return
    cut = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(row[at]) != 0)))
    for a, b in zip(cut.tolist(), np.append(cut[1:], len(at)).tolist(), strict=True):
        yield int(i[at[a]]), int(i[at[b - 1]]) + 1, int(row[at[a]])


def repeated_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """``(address, begin, end)``: byte ranges covered by repeated strings (they
    may overlap). ``docs`` has addresses and ``text``."""
    all_units = keep(_units_of(docs, length), "units")
    kinds = all_units.groupBy(*UNIT).agg(F.count("*").alias("c"))
    anchors = (kinds.groupBy("h").agg(F.count("*").alias("units"), F.sum("c").alias("total"),
                                      F.min("c").alias("least")).where("total > 1"))
    marked = keep(kinds.join(anchors, "h")
                  .select(*UNIT, (F.col("c") > 1).alias("full"), "units",
                          ((F.col("units") > 1) & (F.col("least") == 1)).alias("compare")), "marked")
    hits = keep(all_units.join(marked, UNIT), "hits")

    # The content of one unit of each kind that is to be compared.
    chosen = (hits.where("compare").groupBy(*UNIT)
              .agg(F.min(F.struct(FILE, ROW, "at", "n", "place")).alias("x"),
                   F.first("full").alias("full"), F.first("units").alias("units"))
              .select(*UNIT, "full", "units", "x.*"))
    per_doc = chosen.groupBy(FILE, ROW).agg(
        F.collect_list(F.struct(*UNIT, "full", "units", "at", "n", "place")).alias("cuts"))

    def cut(batches):
        for batch in batches:
            out = []
            for text, cuts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode()
                for c in cuts:
                    unit = raw[c["at"]:c["at"] + c["n"] + length - 1]
                    out.append((c["h"], c["u"], c["v"], c["full"], c["units"], c["place"],
                                unit[c["place"]:c["place"] + ANCHOR], unit))
                    if len(out) >= 20_000:
                        yield _cut_batch(out)
                        out = []
            if out:
                yield _cut_batch(out)

    contents = map_arrow(docs.select(FILE, ROW, "text").join(per_doc, [FILE, ROW]).select("text", "cuts"),
                         cut, "h long, u long, v long, full boolean, units long, place int, lead binary, unit binary")
    contents = keep(contents, "contents")

    def buckets(batches):
        rows, windows, last = [], 0, None

        def flush():
            found = list(_compare(rows, length))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)],
                                                 names=[*UNIT, "first", "stop"])

        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                lead = r[5]
                if windows >= WINDOWS_AT_ONCE and lead != last:
                    yield from flush()
                    rows, windows = [], 0
                rows.append((*r[:5], r[6]))
                windows += len(r[6]) - length + 1
                last = lead
        if rows:
            yield from flush()

    small = map_arrow(contents.where(F.col("units") <= GROUP_UNITS).select(*UNIT, "full", "place", "lead", "unit")
                      .repartitionByRange("lead").sortWithinPartitions("lead"),
                      buckets, "h long, u long, v long, first long, stop long")

    def windows(batches):
        for batch in batches:
            for *unit, place, content in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                n = len(content) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([x] * n) for x in unit),
                     pa.array(range(n), pa.int32()), pa.array(range(place, place - n, -1), pa.int32()),
                     pa.array([xxhash.xxh3_128_digest(content[i:i + length]) for i in range(n)], pa.binary())],
                    names=[*UNIT, "full", "i", "offset", "window"])

    dealt = map_arrow(contents.where(F.col("units") > GROUP_UNITS).select(*UNIT, "full", "place", "unit"),
                      windows, "h long, u long, v long, full boolean, i int, offset int, window binary")
    twice = dealt.groupBy("h", "offset", "window").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    large = (dealt.where("not full").join(twice, ["h", "offset", "window"], "left_semi")
             .select(*UNIT, F.col("i").cast("long").alias("first"), (F.col("i") + 1).cast("long").alias("stop")))

    part = hits.where("compare and not full").join(keep(small.unionByName(large), "repeats"), UNIT)
    return (hits.where("full").select(FILE, ROW, F.col("at").alias("begin"),
                                      (F.col("at") + F.col("n") + length - 1).alias("end"))
            .unionByName(part.select(FILE, ROW, (F.col("at") + F.col("first")).alias("begin"),
                                     (F.col("at") + F.col("stop") + length - 1).alias("end"))))


def _cut_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                      names=[*UNIT, "full", "units", "place", "lead", "unit"])


def _merge(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["begin"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text",
                   rest: Column | None = None) -> DataFrame:
    """``(address, doc_id, n_bytes, removed array<struct<begin, end>>, kept
    binary, kept_text, rest)`` for every row. ``removed`` holds the maximal
    removed runs; ``kept_text`` leaves out characters that were cut in two;
    ``rest`` is any column to carry along."""
    src = addressed(docs)
    src = src.select(FILE, ROW, src[id_col].alias("doc_id"), src[text_col].alias("text"),
                     (F.lit(0) if rest is None else rest).alias("rest"))
    spans = (repeated_spans(src, length).groupBy(FILE, ROW)
             .agg(F.collect_list(F.struct("begin", "end")).alias("spans")))

    def run(batches):
        for batch in batches:
            size, removed, kept, texts = [], [], [], []
            for text, spans in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                raw = (text or "").encode()
                gone = _merge(spans)
                edges = [0, *(x for s in gone for x in s), len(raw)]
                parts = [raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                size.append(len(raw))
                removed.append([{"begin": a, "end": b} for a, b in gone])
                kept.append(b"".join(parts))
                texts.append("".join(p.decode("utf-8", "ignore") for p in parts) if gone else text)
            pair = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(size, pa.int64()), pa.array(removed, pa.list_(pair)),
                 pa.array(kept, pa.binary()), pa.array(texts, pa.string())],
                names=[FILE, ROW, "doc_id", "rest", "n_bytes", "removed", "kept", "kept_text"])

    kind = src.schema["doc_id"].dataType.simpleString()
    carried = src.schema["rest"].dataType.simpleString()
    return map_arrow(src.join(spans, [FILE, ROW], "left").select(FILE, ROW, "doc_id", "rest", "text", "spans"), run,
                     f"{FILE} long, {ROW} long, doc_id {kind}, rest {carried}, n_bytes long, "
                     "removed array<struct<begin:long,end:long>>, kept binary, kept_text string")


def strip_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text",
                  chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated bytes out of their texts (and, where the
    column exists, the number of characters set anew)."""
    src = addressed(docs)
    whole = F.struct(*(x.alias(f"c{i}") for i, x in enumerate(columns(docs))))
    out = remove_repeats(src, length, id_col, text_col, whole)
    new = {text_col: F.col("kept_text"), chars_col: F.length(F.coalesce("kept_text", F.lit("")))}
    kinds = dict(docs.dtypes)
    return out.select(*(
        (F.when(F.size("removed") > 0, new[c].cast(kinds[c])).otherwise(F.col(f"rest.c{i}")) if c in new
         else F.col(f"rest.c{i}")).alias(c) for i, c in enumerate(docs.columns)))


def remove_repeats_sql(length: int) -> str:
    """The removal in one statement for a second engine: every window is
    counted, the repeated ones are joined to runs, and the runs are cut out."""
    return f"""
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (
  SELECT doc_id, q, substr(h, CAST(2 * q + 1 AS BIGINT), {2 * (256 + length - 1)}) AS block
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2, 256)) AS q FROM raw)),
windows AS (
  SELECT doc_id, q + i AS p, md5(substr(block, CAST(2 * i + 1 AS BIGINT), {2 * length})) AS w
  FROM (SELECT doc_id, q, block, unnest(range(least(256, len(block) // 2 - {length - 1}))) AS i FROM blocks)),
twice AS (
  SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS step
  FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
runs AS (
  SELECT doc_id, min(p) AS b, max(p) + {length} AS e
  FROM (SELECT doc_id, p, sum(CASE WHEN step <= {length} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run
        FROM twice)
  GROUP BY doc_id, run),
cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(e - b) AS n_removed, list_sort(list(b)) AS bs, list_sort(list(e)) AS es
  FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN bs IS NULL THEN h ELSE array_to_string(
         [substr(h, CAST(2 * x[1] + 1 AS BIGINT), CAST(2 * (x[2] - x[1]) AS BIGINT))
          FOR x IN list_zip(list_prepend(CAST(0 AS BIGINT), es), list_append(bs, len(h) // 2))], '') END)) AS kept_sha256
FROM raw LEFT JOIN cut USING (doc_id)"""
