"""Spelling variant grouping by a dictionary of trie-node pairs.

The words of the corpus are sorted and walked as a trie, once forwards and
once reversed, and the nodes are numbered. A word with the character at ``p``
skipped is then a pair of integers: the node of the prefix before ``p`` and
the node of the suffix after it. A word split at ``p``, with nothing skipped,
is the pair of the nodes on both sides. Words that differ by one replaced
character share a skipped pair; a word and one with a character more share a
split pair and a skipped pair. Equal pairs of integers are equal strings, so
the join gives exact neighbours and nothing is compared afterwards.

A pair of nodes has one split word and one skipped word for each character of
the alphabet at most, so its group is small whatever the corpus; a word's
neighbours are counted, and the most frequent one found, within the groups,
without listing pairs. Of equal adjacent characters only the last counts as
the one inserted, so that no neighbour is met twice.

Numbering: the words are range-partitioned, and each task numbers the nodes it
is the first to meet. The prefixes that a range's first word shares with the
word before it take their numbers from there; for that, one word and its
path of each range (bounded by the number of ranges) pass through the driver.
Numbers rise with the words in code-point order.

A word's form is its most frequent near word, if at least ``ratio`` times as
frequent, so counts rise along a chain of forms; roots are found by doubling
the chains until none is left to follow.

Defined cases: a null text has no words; a null id is written as nothing in
the checksum; rows that repeat count as often; runs are read whole, however
long; an empty table, or one without frequent words, gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricforge.llm.common import keep, map_arrow

#: Latin letters up to U+00FF are one byte in Latin-1; A-Z in lower case, all
#: other bytes a space.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Bytes of a text split at a time, and distinct words a task counts before it
#: passes them on.
STRIDE = 1 << 22
HELD = 200_000
#: Bits of a node's number within its range.
BITS = 40


def _runs(text: str):
    """Batches of a text's letter runs, as Latin-1 bytes."""
    # Characters beyond U+00FF become "?", which is no letter either.
    raw = text.encode("latin-1", "replace").translate(LETTERS)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + STRIDE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def count_words(docs: DataFrame, least_length: int = 5, typo_rate: int = 97, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(word, n)`` of the lower-cased letter runs. Where ``typo_rate``
    divides the checksum of ``<doc_id>:<run>``, the run loses one character."""
    def add(counts: Counter, doc_id, text: str):
        start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
        for words in _runs(text):
            for w, n in Counter(words).items():
                if len(w) < least_length:
                    continue
                h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                if h % typo_rate == 0:
                    k = h % len(w)
                    w = w[:k] + w[k + 1:]
                    if len(w) < least_length:
                        continue
                counts[w] += n

    def flush(counts: Counter):
        out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                          pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    def run(batches):
        counts = Counter()
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    add(counts, doc_id, text or "")
                if len(counts) > HELD:
                    yield flush(counts)
        yield flush(counts)

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return map_arrow(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    k, most = 0, min(len(a), len(b))
    while k < most and a[k] == b[k]:
        k += 1
    return k


def _walk(batches):
    """Paths of a range's sorted keys: the numbers of the nodes of all their
    prefixes, the empty one first."""
    base = TaskContext.get().partitionId() << BITS
    last, path, new = None, [], base
    for batch in batches:
        keys = batch.column("key").to_pylist()
        paths, ends = [], []
        for key in keys:
            same = -1 if last is None else _shared(last, key)
            path = path[:same + 1] + list(range(new, new + len(key) - same))
            new += len(key) - same
            last = key
            paths.append(path)
            ends.append([a != b for a, b in zip(key, key[1:])] + [True])
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("n"), batch.column("key"), pa.array([base >> BITS] * len(keys), pa.int32()),
             pa.array(paths, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.bool_()))],
            names=["word", "n", "key", "part", "path", "ends"])


def trie_paths(words: DataFrame, backwards: bool) -> DataFrame:
    """``(word, n, path, ends)``: ``path[p]`` is the number of the trie node of
    the first (last) ``p`` characters, ``ends[p]`` tells that character ``p``
    differs from the next."""
    key = F.reverse("word") if backwards else F.col("word")
    rows = words.select("word", "n", key.alias("key")).repartitionByRange("key").sortWithinPartitions("key")
    walked = keep(map_arrow(rows, _walk, "word string, n long, key string, part int, path array<long>, "
                                         "ends array<boolean>"), "paths")
    # What a range's first word shares with the last word before it.
    edges = walked.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"),
                                       F.max_by("path", "key").alias("path")).orderBy("part").collect()
    fixes, last, path = [], None, []
    for r in edges:
        fix = path[:_shared(last, r["first"]) + 1] if last is not None else []
        fixes.append((r["part"], fix))
        start = r["part"] << BITS
        path = [fix[p] if p < len(fix) and x == start + p else x for p, x in enumerate(r["path"])]
        last = r["last"]
    fixes = words.sparkSession.createDataFrame(fixes, "part int, fix array<long>")
    start = F.shiftleft(F.col("part").cast("long"), BITS)
    path = F.transform("path", lambda x, p: F.when((p < F.size("fix")) & (x == start + p), F.get("fix", p)).otherwise(x))
    return walked.join(F.broadcast(fixes), "part").select("word", "n", path.alias("path"), "ends")


def near_words(words: DataFrame) -> DataFrame:
    """``(id, word, n, n_near, best)`` of ``words(word, n)``: the number of
    words one character away, and the most frequent of them as ``(-n, id)``.
    Ids rise in code-point order."""
    ahead = trie_paths(words, backwards=False).select("word", "n", F.col("path").alias("heads"), "ends")
    behind = trie_paths(words, backwards=True).select("word", F.reverse("path").alias("tails"))
    named = keep(ahead.join(behind, "word").select(F.element_at("heads", -1).alias("id"), "word", "n", "heads", "tails",
                                                   "ends"), "nodes")
    # Kinds: 0 split, 1 skipped, 2 skipped where the next character differs.
    split = F.transform("heads", lambda x, p: F.struct(
        x.alias("head"), F.get("tails", p).alias("tail"), F.lit(0).alias("kind")))
    skipped = F.transform(F.slice("heads", F.lit(1), F.size("heads") - 1), lambda x, p: F.struct(
        x.alias("head"), F.get("tails", p + 1).alias("tail"), F.when(F.get("ends", p), 2).otherwise(1).alias("kind")))
    rows = named.select("id", "n", F.inline(F.concat(split, skipped)))
    group = Window.partitionBy("head", "tail")
    who = F.struct((-F.col("n")).alias("m"), F.col("id").alias("w"))
    rows = rows.withColumns({
        "members": F.count("*").over(group), "others": F.count_if(F.col("kind") > 0).over(group),
        "longer": F.count_if(F.col("kind") == 2).over(group),
        "first": F.min(F.when(F.col("kind") > 0, who)).over(group),
        "first_longer": F.min(F.when(F.col("kind") == 2, who)).over(group),
        "shorter": F.min(F.when(F.col("kind") == 0, who)).over(group)}).where("members > 1")
    rows = rows.withColumn("second", F.min(F.when((F.col("kind") > 0) & (who != F.col("first")), who)).over(group))
    replaced = F.when(F.col("first.w") == F.col("id"), F.col("second")).otherwise(F.col("first"))
    down = F.when(F.col("kind") == 2, F.col("shorter"))
    met = rows.select(
        "id", F.when(F.col("kind") == 0, F.col("longer")).otherwise(
            F.col("others") - 1 + down.isNotNull().cast("int")).alias("near"),
        F.when(F.col("kind") == 0, F.col("first_longer")).otherwise(F.least(replaced, down)).alias("best"))
    met = met.where("near > 0").groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return named.select("id", "word", "n").join(met, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best")


def chain_ends(links: DataFrame) -> DataFrame:
    """``(id, end)`` of ``links(id, end)``, a forest: each followed to its last.
    Every round doubles the steps that a link stands for."""
    links = keep(links, "chains")
    while True:
        then = links.select(F.col("id").alias("end"), F.col("end").alias("then"))
        if links.join(then, "end", "left_semi").isEmpty():
            return links
        links = keep(links.join(then, "end", "left").select("id", F.coalesce("then", "end").alias("end")), "chains")


def variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2, typo_rate: int = 97,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of the frequent words."""
    counted = count_words(docs, least_length, typo_rate, id_col, text_col)
    words = keep(near_words(keep(counted.where(F.col("n") >= least_count), "words")), "near")
    follows = -F.col("best.m") >= ratio * F.col("n")
    forms = words.where(follows).select("id", F.col("best.w").alias("end"))
    ends = chain_ends(forms)
    name = words.select(F.col("id").alias("end"), "word", F.col("n").alias("form_n"))
    form = forms.join(name, "end").select("id", F.col("word").alias("form"), "form_n")
    root = ends.join(name, "end").select("id", F.col("word").alias("root"))
    out = words.select("id", "word", "n", "n_near").join(form, "id", "left").join(root, "id", "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def variants_sql(least_length: int = 5, least_count: int = 3, ratio: int = 2, typo_rate: int = 97) -> str:
    """The same in one statement for a second engine. The checksum is folded
    byte by byte; near words meet by the strings around a skipped character."""
    return rf"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), [CAST(0 AS BIGINT) FOR z IN range(8)]),
                          lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) r(i)),
found AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
runs AS (SELECT doc_id, run, count(*) AS c FROM found WHERE length(run) >= {least_length} GROUP BY ALL),
marked AS (
  SELECT run, c, xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT),
                        [CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(
                          hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..')]),
           lambda k, x: xor(k >> 8, crc[(xor(k, x) & 255) + 1]))) AS h
  FROM runs, steps),
words AS MATERIALIZED (
  SELECT CASE WHEN h % {typo_rate} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, CAST(sum(c) AS BIGINT) AS n
  FROM marked GROUP BY 1 HAVING length(word) >= {least_length} AND sum(c) >= {least_count}),
skipped AS MATERIALIZED (
  SELECT word, n, substr(word, 1, p) || '_' || substr(word, p + 2) AS around
  FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words) x),
split AS (
  SELECT word, n, substr(word, 1, p) || '_' || substr(word, p + 1) AS around
  FROM (SELECT word, n, unnest(range(length(word) + 1)) AS p FROM words) x),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM skipped a JOIN skipped b USING (around) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM skipped a JOIN split b USING (around)
  UNION SELECT b.word, b.n, a.word, a.n FROM skipped a JOIN split b USING (around)),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {ratio} * n THEN form END AS form,
         CASE WHEN form_n >= {ratio} * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
roots AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL SELECT r.word, f.word, f.form FROM roots r JOIN forms f ON r.next = f.word)
SELECT f.word, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form, CAST(f.form_n AS BIGINT) AS form_n, r.at AS root
FROM forms f JOIN roots r USING (word) WHERE r.next IS NULL"""
