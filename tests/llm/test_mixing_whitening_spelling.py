import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from helpers import documents

from metricforge.llm import common, mixing, spelling, whitening

SMALL = "/root/testdata/sf0.001"


def words_of(text):
    return len((text or "").translate({c: " " for c in range(9, 14)}).split(" ")) - \
        (text or "").translate({c: " " for c in range(9, 14)}).split(" ").count("")


def plain_targets(totals, weights, share, most):
    """Targets by rounds of sharing, in fractions."""
    names = sorted(totals, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = Fraction(share) * sum(totals.values()), set(names), {}
    while True:
        unit = left / (sum(weight[s] for s in open_) or 1)
        full = {s for s in open_ if unit * weight[s] > most * totals[s]}
        if not full:
            return {**out, **{s: unit * weight[s] for s in open_}}
        for s in full:
            out[s] = Fraction(most) * totals[s]
            left -= out[s]
        open_ -= full


def check_mix(spark, docs, block, weights=(5, 2, 1)):
    rows = docs.collect()
    m = mixing.mix(docs, weights=weights, block=block)
    taken = m.taken().collect()
    totals = Counter()
    for r in rows:
        totals[r["source"]] += words_of(r["text"])
    want = plain_targets(totals, weights, 1.5, 2)
    name = lambda s: "null" if s is None else f"={s}"
    assert Counter((str(r["doc_id"]), r["size"], r["stratum"]) for r in taken) == Counter(
        (str(r["doc_id"]), words_of(r["text"]), name(r["source"])) for r in rows)
    got = Counter()
    for r in taken:
        assert 0 <= r["taken"] <= 2 * r["size"]
        got[r["stratum"]] += r["taken"]
    for s, t in want.items():
        mine = [r for r in taken if r["stratum"] == name(s)]
        assert all(abs(r["target"] - float(t)) < 1e-6 and r["source_size"] == totals[s] for r in mine)
        assert got[name(s)] == int(t + Fraction(1, 2))
    # The schedule: equal blocks, every slot once, sources spread evenly.
    slots = sorted(tuple(r) for r in m.slots.select("slot", "stratum", "take").collect())
    assert len({s for s, _, _ in slots}) == len(slots)
    filled = Counter()
    for r in m.pieces.collect():
        filled[r["slot"]] += r["words"]
    assert filled == {s: t for s, _, t in slots}
    n, seen = Counter(s for _, s, _ in slots), Counter()
    for i, (_, s, _) in enumerate(slots):
        seen[s] += 1
        assert abs(seen[s] - n[s] * (i + 1) / len(slots)) <= 2 + np.log2(len(slots) + 1)
    return sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in taken)


@pytest.mark.parametrize("block", [1, 64])
def test_mix_of_awkward_documents(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "ROWS", 4)
    monkeypatch.setattr(mixing, "STRETCH", 8)
    monkeypatch.setattr(common, "PORTION", 3)
    docs = documents(spark, clash=True, dirty_ids=True).unionByName(documents(spark, clash=True, dirty_ids=True))
    if block == 1:
        docs = docs.where("length(text) < 300 or text is null")
    first = check_mix(spark, docs, block)
    again = mixing.mix(docs.repartition(3, "text"), block=block).taken().collect()
    assert first == sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in again)


def test_mix_reshares_and_takes_one_source_or_none(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate(
        [(5, "a"), (400, "b"), (900, "c"), (3, "d"), (0, "e"), (1, None), (50, "f")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(spark, docs, 16)
    check_mix(spark, docs, 16, weights=(1, 3))
    check_mix(spark, docs.where("source = 'b'"), 16)
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix(blank).taken().collect()] == [0, 0]
    assert mixing.mix(docs.limit(0)).taken().count() == 0


def plain_whitening(x):
    fit = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, s = len(fit), fit.sum(axis=0)
    v = ((n * fit - s).T @ (n * fit - s) / n ** 3).astype(float)
    e, u = np.linalg.eigh(v)
    return n, s, e[::-1], u[:, ::-1]


def test_whitening_equals_a_plain_one(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = table.collect()
    x = np.floor(np.array([r["embedding"] for r in rows], float) * 64).astype(np.int64) + 1_000_000
    n, s, e, u = plain_whitening(x)
    at = {r["vec_id"]: i for i, r in enumerate(rows)}
    out = whitening.whiten(table).collect()
    assert len(out) == 16 * len(rows)
    got = np.zeros((len(rows), 16))
    for r in out:
        i, k = at[r["vec_id"]], r["component"] - 1
        got[i, k] = r["whitened"]
        assert r["n"] == n and r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(x[i].tolist(), s, strict=True))
        assert abs(r["explained"] / (e[k] / e.sum()) - 1) < 1e-9 and 0 <= r["identity_error"] < 1e-9
    want = ((n * x - s.astype(np.int64)) / n) @ (u[:, :16] / np.sqrt(e[:16]))
    for k in range(16):
        assert min(np.abs(got[:, k] - want[:, k]).max(), np.abs(got[:, k] + want[:, k]).max()) < 1e-8


@pytest.mark.parametrize("high", [1, 3, 200, 2 ** 31, 2 ** 63])
def test_popcounts_are_exact_products(high):
    r = np.random.default_rng(high)
    x = r.integers(0, high, (133, 5), dtype=np.uint64)
    x[3] = high - 1
    want = x.astype(object).T @ x.astype(object)
    assert (whitening.cross_products(x) == want).all()
    signed = x.view(np.int64)
    n, s, q = whitening._moments(signed)
    assert (n, s.tolist()) == (133, signed.astype(object).sum(axis=0).tolist())
    assert (q == signed.astype(object).T @ signed.astype(object)).all()


def test_whitening_of_awkward_vectors(spark):
    good = [[0.1 * i, -0.3 * (i % 3), float(i % 2)] for i in range(9)]
    rows = [(i, v) for i, v in enumerate(good)] + [
        (0, good[0]), (None, good[1]), (20, None), (21, []), (22, [1.0, None, 2.0]), (23, [1.0, float("nan"), 2.0]),
        (24, [float("inf"), 0.0, 0.0]), (25, [1e300, 0.0, 0.0]), (30, [1.0, 2.0]), (31, [1.0, 2.0]), (40, [5.0] * 4),
        (41, [3e14, 0.0, 0.0, 1.0]), (42, [-3e14, 0.5, 0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS dims", "'x' AS x")
    out = whitening.whiten(table.repartition(3)).collect()
    ids = Counter(r["vec_id"] for r in out)
    # Two numbers 30 and 31 are one vector: without variance there is no component.
    assert ids[20] == ids[21] == ids[22] == ids[23] == ids[24] == ids[25] == ids[30] == ids[31] == 0
    assert ids[0] == 6 and ids[None] == 3 and all(ids[i] == 3 for i in range(1, 9))
    assert ids[40] == ids[41] == ids[42] >= 1
    assert all(r["deviation"] is None for r in out if r["vec_id"] in (41, 42))
    x = np.floor(np.array(good) * 64).astype(np.int64) + 1_000_000
    n, s, e, u = plain_whitening(x)
    for r in out:
        if r["vec_id"] is not None and r["vec_id"] < 9:
            want = ((n * x[r["vec_id"]] - s) / n).astype(float) @ u[:, r["component"] - 1] / np.sqrt(e[r["component"] - 1])
            assert abs(abs(r["whitened"]) - abs(want)) < 1e-9 and r["n"] == n
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id = 40")).count() == 0


def plain_variants(rows, least=5, often=3, ratio=2, rate=97):
    n = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                n[run if h % rate else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
            run = ""
    n = {w: c for w, c in n.items() if len(w) >= least and c >= often}
    # Without one character: what two near words have in common.
    met = defaultdict(set)
    for w in n:
        for p in range(len(w)):
            met[w[:p], w[p + 1:]].add(w)
    near = defaultdict(set)
    for same in met.values():
        for a in same:
            near[a] |= same - {a}
    for w in n:
        for p in range(len(w)):
            if (v := w[:p] + w[p + 1:]) in n:
                near[w].add(v)
                near[v].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


def check_variants(spark, docs, **limits):
    want = plain_variants([(r["doc_id"], r["text"]) for r in docs.collect()], **{
        {"least_length": "least", "least_count": "often", "typo_rate": "rate"}[k]: v for k, v in limits.items()})
    assert sorted((tuple(r) for r in spelling.variants(docs, **limits).collect()), key=lambda r: r[0]) == want
    return want


def test_variants_of_documents(spark):
    rows = check_variants(spark, spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert len(rows) > 1000 and sum(r[3] is not None for r in rows) > 50


def test_variants_of_awkward_documents(spark, monkeypatch):
    monkeypatch.setattr(spelling, "STRIDE", 16)
    monkeypatch.setattr(spelling, "HELD", 10)
    docs = documents(spark, clash=True, dirty_ids=True).unionByName(documents(spark, clash=True)).repartition(5)
    for rate in (97, 3):
        check_variants(spark, docs, typo_rate=rate)
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, ["rare words only", None, ""])).count() == 0


def test_variants_of_dense_words(spark):
    """Every word of few letters: repeated letters, long chains, ties."""
    r = np.random.default_rng(5)
    words = ["".join(r.choice(list("abé"), r.integers(1, 7))) for _ in range(4000)]
    docs = documents(spark, [" ".join(words[i:i + 40]) for i in range(0, 4000, 40)] + ["a" * 3000 + " b" + "a" * 3000] * 3)
    rows = check_variants(spark, docs, least_length=1, least_count=1)
    assert max(r[2] for r in rows) > 10 and any(r[5] != r[3] and r[3] for r in rows)
    check_variants(spark, docs.repartitionByRange(7, "text"), least_length=2, least_count=2, typo_rate=5)
