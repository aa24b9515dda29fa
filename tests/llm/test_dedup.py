import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import documents, normal, plain_components, plain_fingerprint, plain_repeats, texts
from pyspark.sql import functions as F

from metricforge.llm import embedding_dedup, exact_dedup, simhash, suffix_dedup
from metricforge.llm.common import components


def plain_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    return groups


@pytest.mark.parametrize("weak", [False, True])
@pytest.mark.parametrize("clash", [False, True])
def test_exact_copies(spark, weak, clash):
    docs = documents(spark, clash=clash).repartition(5)
    # A digest of four bits makes unlike texts collide: their bytes decide.
    digest = (lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 2))) if weak else exact_dedup.sha256
    out = exact_dedup.find_copies(docs, digest=digest, bytes_per_trigger=1000).collect()
    items = list(enumerate(texts()))
    groups = plain_groups(items)
    assert len(out) == len(items)
    for r in out:
        group = groups[normal(dict(items)[r["doc_id"]])]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(group), len(group), r["doc_id"] == min(group))
        if not weak:
            assert bytes(r["digest"]).hex() == hashlib.sha256(normal(dict(items)[r["doc_id"]]).encode()).hexdigest()


def test_exact_copies_with_null_and_repeated_ids(spark):
    docs = documents(spark, dirty_ids=True)
    out = exact_dedup.find_copies(docs)
    rows = out.collect()
    assert len(rows) == docs.count()
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    left = [r["text"] for r in kept.collect()]
    assert len(left) == len({normal(t) for t in left}) == len({normal(r["text"]) for r in docs.collect()})
    assert sum(r["kept"] for r in rows) == len(left)


def test_exact_copies_stream_goes_on_over_many_batches(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 700).cast("string"))
                                    .alias("text")).repartition(12)
    out = exact_dedup.find_copies(docs, bytes_per_trigger=2000)
    assert out.where("kept").count() == 700
    assert out.where("keep_id != doc_id % 700").count() == 0


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert exact_dedup.find_copies(docs).count() == 0
    assert exact_dedup.drop_copies(docs).columns == docs.columns
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0
    assert suffix_dedup.remove_repeats(docs).count() == 0
    assert suffix_dedup.strip_repeats(docs).count() == 0
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_vectors(none).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(500, 501), (501, 502), (502, 500)]
    edges += [(r.randint(2000, 2100), r.randint(2000, 2100)) for _ in range(70)] + [(7, 7)]
    r.shuffle(edges)
    want = plain_components({x for e in edges if e[0] != e[1] for x in e}, edges)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x["node"]: x["component"] for x in got} == want and len(got) == len(want)


@pytest.mark.parametrize("dirty", [False, True])
def test_simhash(spark, dirty):
    docs = documents(spark, clash=True, dirty_ids=dirty)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 2]
    comp = plain_components(range(len(rows)), linked)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[comp[k]] = min(i, low.get(comp[k], i))
    want = sorted(((i, prints[k], low.get(comp[k])) for k, (i, _) in enumerate(rows)), key=str)
    out = simhash.near_duplicates(docs)
    got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in out.collect()), key=str)
    assert got == want
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(comp.values()))


def test_simhash_dense_shard_uses_several_trees(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TREE_NODES", 16)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(3)]
    points = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(150)}
    points |= {(r.getrandbits(43) << 21) | 12345 for _ in range(100)}
    points = sorted(points)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in points]
    edges = simhash.link_edges(spark.createDataFrame(signed, "fp long"), 2).collect()
    got = plain_components(points, [(e["a"] % 2**64, e["b"] % 2**64) for e in edges])
    want = plain_components(points, [(a, b) for a in points for b in points if a < b and bin(a ^ b).count("1") <= 2])
    assert got == want
    assert len(edges) < 150 * len(points)


def test_bk_tree_finds_what_a_scan_finds():
    r = np.random.default_rng(1)
    points = r.integers(0, 2**12, 300, dtype=np.uint64)
    points = np.unique(points)
    queries = r.integers(0, 2**12, 200, dtype=np.uint64)
    for radius in (0, 1, 2, 5):
        got = {(int(q), n) for hit, n in simhash.BKTree(points).search(queries, radius) for q in hit}
        want = {(q, n) for q in range(len(queries)) for n in range(len(points))
                if bin(int(queries[q] ^ points[n])).count("1") <= radius}
        assert got == want


@pytest.mark.parametrize("length,limit", [(200, 5000), (40, 5000), (40, 2)])
def test_suffix_array(spark, monkeypatch, length, limit):
    monkeypatch.setattr(suffix_dedup, "GROUP_UNITS", limit)
    docs = documents(spark, clash=True, dirty_ids=True).repartition(4)
    rows = docs.collect()
    marks = plain_repeats([(r["text"] or "").encode() for r in rows], length)
    want = []
    for r, m in zip(rows, marks, strict=True):
        raw = (r["text"] or "").encode()
        kept = bytes(b for b, gone in zip(raw, m, strict=True) if not gone)
        spans = sum(1 for i, x in enumerate(m) if x and (not i or not m[i - 1]))
        want.append((r["doc_id"], len(raw), spans, kept))
    got = [(r["doc_id"], r["n_bytes"], len(r["removed"]), bytes(r["kept"]))
           for r in suffix_dedup.remove_repeats(docs, length).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_strip_repeats_keeps_columns_and_whole_characters(spark):
    docs = documents(spark, clash=True)
    out = suffix_dedup.strip_repeats(docs, 40)
    assert out.dtypes == docs.dtypes and out.count() == docs.count()
    for r in out.collect():
        assert r["n_chars"] == len(r["text"] or "")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out.collect():
        if len((before[r["doc_id"]] or "").encode()) < 40:
            assert r["text"] == before[r["doc_id"]]


def test_hot_passage_is_found_in_every_text(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    passage = " ".join(word() for _ in range(60))
    items = [" ".join(word() for _ in range(30)) + " " + passage + " " + " ".join(word() for _ in range(30))
             for _ in range(300)]
    out = suffix_dedup.remove_repeats(documents(spark, items)).collect()
    assert all(len(x["removed"]) == 1 and passage not in x["kept"].decode() for x in out)
    assert all(len(x["kept"]) >= 470 for x in out)


def plain_vectors(rows, threshold):
    able = [k for k, (i, v, l) in enumerate(rows) if i is not None and l is not None and v and None not in v
            and all(np.isfinite(v)) and any(v)]
    linked, links = [], defaultdict(int)
    for x, a in enumerate(able):
        for b in able[:x]:
            if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                p, q = (np.array(rows[k][1], float) for k in (a, b))
                if p @ q / np.sqrt(p @ p) / np.sqrt(q @ q) >= threshold:
                    linked.append((rows[a][0], rows[b][0]))
                    links[a] += 1
                    links[b] += 1
    comp = plain_components({r[0] for r in rows if r[0] is not None}, linked)
    return sorted([(i, links[k], comp.get(i), i is not None and comp[i] == i) for k, (i, _, _) in enumerate(rows)], key=str)


@pytest.mark.parametrize("tile", [2048, 8])
def test_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    r = np.random.default_rng(2)
    rows = []
    for i in range(160):
        v = r.normal(size=16) * r.uniform(0.1, 10)
        rows.append((len(rows), v.astype(np.float32).tolist(), int(i % 3)))
        for _ in range(i % 4):
            w = v + r.normal(size=16) * r.uniform(0, 0.6) * np.abs(v).mean()
            rows.append((len(rows), w.astype(np.float32).tolist(), int(i % 3)))
    rows += [(len(rows) + k, rows[4][1], rows[4][2]) for k in range(30)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] + [1.0] * 15, 1), (n + 3, [], 1),
             (n + 4, [None] + [1.0] * 15, 1), (n + 5, [float("inf")] + [1.0] * 15, 1), (n + 6, rows[4][1], None),
             (n + 7, rows[4][1][:8], rows[4][2]), (n + 8, rows[4][1][:8], rows[4][2]), (None, rows[4][1], rows[4][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "'x' AS node", "'y' AS component", "1 AS block")
    got = sorted([(x["vec_id"], x["n_links"], x["component_id"], x["kept"])
                  for x in embedding_dedup.near_vectors(df, 0.93).collect()], key=str)
    assert got == plain_vectors(rows, 0.93)
