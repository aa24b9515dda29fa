"""Frames whose rows are not rows of a file (exploded, united), and
columns with dots and backticks in their names; hot ids and hot bands."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents, normal, plain_components, plain_fingerprint, plain_repeats, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from metricforge.llm import exact_dedup, packing, queries, simhash, suffix_dedup, token_store
from metricforge.llm.common import shared_path

SMALL = "/root/testdata/sf0.001"


def frames(spark, tmp_path):
    """Name -> frame over Parquet files, with rows that repeat."""
    path = str(tmp_path / "documents")
    documents(spark, texts(n=20)[:40] + [None, "", "é" * 150 + "a" * 250], dirty_ids=True).repartition(3).write.parquet(path)
    scan = spark.read.parquet(path)
    return {
        "exploded": scan.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("k")).drop("k"),
        "union": scan.unionByName(scan.where("doc_id % 2 = 0")).unionByName(spark.read.parquet(path)),
        "dotted": (scan.createOrReplaceTempView("mf_docs"), spark.table("mf_docs"))[1].where("doc_id is null or doc_id > 3")
        .withColumn("a.b", F.lit(1)).withColumn("c`d", F.col("lang")),
        "empty": scan.where("false"),
    }


@pytest.mark.parametrize("kind", ["exploded", "union", "dotted", "empty"])
def test_operators_on_derived_frames(spark, tmp_path, kind):
    docs = frames(spark, tmp_path)[kind]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    out = exact_dedup.find_copies(docs).collect()
    assert Counter(str(r["doc_id"]) for r in out) == Counter(str(i) for i, _ in rows)
    assert sum(r["kept"] for r in out) == len(groups)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(normal(r["text"]) for r in kept.collect()) == sorted(groups)

    prints = {normal(t): plain_fingerprint(t) for _, t in rows}
    points = sorted(set(prints.values()))
    comp = plain_components(points, [(a, b) for a in points for b in points if a < b and bin(a ^ b).count("1") <= 2])
    near = simhash.drop_near_duplicates(docs)
    assert near.columns == docs.columns
    assert sorted(comp[prints[normal(r["text"])]] for r in near.collect()) == sorted(set(comp.values()))

    marks = plain_repeats([(t or "").encode() for _, t in rows], 200)
    want = Counter((str(i), sum(m), hashlib.sha256(bytes(x for x, gone in zip((t or "").encode(), m, strict=True) if not gone))
                    .hexdigest()) for (i, t), m in zip(rows, marks, strict=True))
    cut = suffix_dedup.remove_repeats(docs, 200)
    got = cut.select("doc_id", (F.col("n_bytes") - F.octet_length("kept")).alias("n"), F.sha2("kept", 256).alias("h"))
    assert Counter((str(r["doc_id"]), r["n"], r["h"]) for r in got.collect()) == want
    assert suffix_dedup.strip_repeats(docs).columns == docs.columns

    library = Tokenizer.from_file(queries.TOKENIZER)
    sizes = Counter((str(i), len(library.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    path = shared_path(spark, "store")
    token_store.write_store(docs, queries.TOKENIZER, path)
    stored = token_store.read_ids(docs.select(F.col("doc_id").alias("key")), path, unkeyed=True).collect()
    assert Counter((str(r["doc_id"]), r["n_tokens"]) for r in stored) == sizes
    packed = packing.pack(packing.token_pieces(docs, queries.TOKENIZER, 64, 0), 64).collect()
    assert sum(r["length"] for r in packed) == sum(n * c for (_, n), c in sizes.items())
    used = defaultdict(list)
    for r in packed:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in used.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()][:-1]


def test_pipeline_of_an_awkward_table(spark, tmp_path):
    docs = frames(spark, tmp_path)
    table = docs["dotted"].unionByName(docs["exploded"].withColumn("a.b", F.lit(2)).withColumn("c`d", F.lit("x")))
    for source in (table, table.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, source, SMALL)
            assert out.columns == table.columns, name
            path = shared_path(spark, name)
            out.write.parquet(path)
            source = spark.read.parquet(path)
        packed = corpus_pipeline.STAGES[-1][1](spark, source, SMALL)
        assert packed.select("doc_id").distinct().count() == source.select("doc_id").distinct().count()


def test_one_id_on_most_rows(spark, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 300)
    monkeypatch.setattr(token_store, "PART_KEYS", 20)
    rows = [(7 if i % 4 else i, f"text {i} " * (i % 5)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = shared_path(spark, "store")
    token_store.write_store(docs, queries.TOKENIZER, path)
    # The index holds a place for each key, not for each document.
    index = spark.read.parquet(f"{path}/index")
    places = index.select((F.octet_length("start") / 8).alias("n")).agg(F.sum("n")).first()[0]
    assert places == len({i for i, _ in rows})
    got = token_store.read_ids(docs.selectExpr("doc_id AS key"), path).collect()
    library = Tokenizer.from_file(queries.TOKENIZER)
    want = Counter((i, zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()))
                   for i, t in rows)
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == want
    spans = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_one_band_value_with_many_fingerprints(spark):
    r = np.random.default_rng(8)
    points = (r.integers(0, 2 ** 43, 19_000, dtype=np.uint64) << np.uint64(21)) | np.uint64(12345)
    flips = np.uint64(1) << r.integers(21, 64, (1000, 3), dtype=np.uint64)
    points = np.unique(np.concatenate([points, points[:1000] ^ flips[:, 0], points[:1000] ^ flips[:, 0] ^ flips[:, 1],
                                       points[:1000] ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]]))
    fps = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    dealt = simhash.shards(fps, 2).groupBy("mask", "value").count()
    top, total = dealt.agg(F.max("count"), F.sum("count")).first()
    assert top <= simhash.TREE_NODES and total <= 9 * len(points)
    edges = simhash.link_edges(fps, 2).collect()
    linked = [(int(points[a]), int(points[b])) for a in range(len(points))
              for b in np.flatnonzero(np.bitwise_count(points[a + 1:] ^ points[a]) <= 2) + a + 1]
    got = plain_components(points.tolist(), [(e["a"] % 2 ** 64, e["b"] % 2 ** 64) for e in edges])
    assert got == plain_components(points.tolist(), linked) and len(linked) > 1500
