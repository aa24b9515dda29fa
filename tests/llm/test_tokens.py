import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import documents, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from metricforge.llm import bpe, packing, token_ids, token_store
from metricforge.llm.common import shared_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(JSON)
    return t


def encode(encoder, items, limit=1 << 20):
    out = []
    for _, run in bpe.chunks(items, limit):
        ids, ends = encoder.encode(run)
        out += [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    return out


PIECES = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", " ", "  ", "\n", "\t", "\r\n", "a", "bc", "é", "ß", "1",
          "²", "٣", "!", "?!", "中", "😀", "'S", "l", "e", "\x1c", "​", " ", "\x00", "<|endoftext|>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), min_size=1, max_size=6))
def test_encoding_of_awkward_texts(tik, library, items):
    want = [tik.encode_ordinary(t) for t in items]
    assert encode(bpe.rank_encoder(RANKS), items, 20) == want
    assert encode(token_ids.library_encoder(JSON), items, 20) == want
    assert [library.encode(t, add_special_tokens=False).ids for t in items] == want


def test_encoding_of_long_pieces_and_a_small_cache(tik, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 40)
    r = random.Random(2)
    items = ["a" * 3000, "ab" * 2000 + " " * 500 + "x", "!" * 999, "the" * 700, " " * 300]
    items += [" ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 90))) for _ in range(40)) for _ in range(60)]
    fresh = bpe.Encoder(bpe.PairMerger(bpe.read_ranks(RANKS)))
    assert encode(fresh, items + items, 3000) == [tik.encode_ordinary(t) for t in items + items]


def test_transition_functions_form_a_small_monoid():
    gens, product, funcs, _ = bpe.automaton()
    assert len(funcs) < 64
    for a in range(len(funcs)):
        for b in gens.tolist():
            assert (funcs[product[a, b]] == funcs[b][funcs[a]]).all()


def test_encode_and_decode_documents(spark, tik):
    docs = documents(spark, clash=True, dirty_ids=True)
    out = bpe.decode_documents(bpe.encode_documents(docs, RANKS), RANKS)
    both = bpe.encode_documents(docs, RANKS, decode=True)
    assert both.schema == out.schema
    out, both = out.collect(), both.collect()
    assert sorted(map(str, out)) == sorted(map(str, both))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(((r["doc_id"], tik.encode_ordinary(r["text"] or "")) for r in docs.collect()), key=key)
    assert sorted(((r["doc_id"], r["ids"]) for r in out), key=key) == want
    for r in out:
        parts = [tik.decode_single_token_bytes(t) for t in r["ids"]]
        assert bytes(r["decoded"]) == b"".join(parts)
        assert r["offsets"] == [sum(map(len, parts[:i])) for i in range(min(len(parts), 400))] + r["offsets"][400:]
    assert bpe.encode_documents(documents(spark, []), RANKS).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(4).integers(-2**62, 2**62, 20000))
    mph = token_store.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    again = token_store.PerfectHash.from_columns(*mph.to_columns())
    assert (again.slots(keys) == mph.slots(keys)).all()
    assert token_store.PerfectHash.build(keys[:0]).slots(keys[:5]).tolist() == [-1] * 5


def test_token_store_round_trip(spark, library, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 500)
    monkeypatch.setattr(token_store, "PART_KEYS", 10)
    docs = documents(spark, clash=True, dirty_ids=True).repartition(3)
    path = shared_path(spark, "store")
    token_store.write_store(docs, JSON, path, end_id=2)
    got = token_store.read_ids(docs.selectExpr("doc_id AS key"), path).collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    start, by_id, places = 0, defaultdict(list), []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        by_id[i].append(ids)
        places.append((start, len(ids)))
        start += len(ids)
    assert len(got) == sum(i is not None for i, _ in rows)
    for r in got:
        assert r["ids"] in by_id[r["doc_id"]]
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    # Without gaps or overlaps, in ascending id order.
    spans = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in got)
    assert [s[2] for s in spans] == sorted(s[2] for s in spans)
    assert [a + n for a, n, _ in spans[:-1]] == [a for a, _, _ in spans[1:]]
    assert spans[-1][0] + spans[-1][1] == start
    # Strangers are told off.
    strange = spark.createDataFrame([(i,) for i in range(10**6, 10**6 + 3000)] + [(None,)], "key long")
    assert token_store.find(strange, path).count() == 0


def test_token_store_of_an_empty_table(spark):
    path = shared_path(spark, "store")
    docs = documents(spark, [])
    token_store.write_store(docs, JSON, path)
    assert token_store.read_ids(docs.selectExpr("doc_id AS key"), path).count() == 0
    assert token_store.find(spark.createDataFrame([(1,)], "key long"), path).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sampled_from([1, 2, 5, 30, 100]).flatmap(lambda cap: st.tuples(
    st.just(cap), st.dictionaries(st.integers(1, cap), st.integers(0, 300)))))
def test_plan_places_every_piece_once(case):
    capacity, counts = case
    lines = packing.plan_sequences(dict(counts), capacity)
    placed = Counter()
    for lengths, n in lines:
        assert sum(lengths) <= capacity and n > 0
        assert sum(x > capacity // 3 for x in lengths) <= 2 or capacity // 3 * 3 != capacity
        for x in lengths:
            placed[x] += n
    assert +placed == +Counter(counts)


def test_plan_is_close_to_the_least_and_does_not_grow_with_the_counts():
    r = random.Random(5)
    counts = Counter(max(1, min(2048, int(r.lognormvariate(6.5, 1.1)))) for _ in range(100_000))
    lines = packing.plan_sequences(dict(counts), 2048)
    least = -(-sum(k * n for k, n in counts.items()) // 2048)
    assert sum(n for _, n in lines) <= least * 1.001
    more = packing.plan_sequences({k: n * 10**6 for k, n in counts.items()}, 2048)
    assert len(more) <= 4 * 2048


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_packing_documents(spark, library, capacity):
    docs = documents(spark, clash=True, dirty_ids=True)
    out = packing.pack(packing.token_pieces(docs, JSON, capacity, 0, with_ids=True), capacity).collect()
    ids = defaultdict(list)
    for r in docs.collect():
        ids[r["doc_id"]].append(library.encode(r["text"] or "", add_special_tokens=False).ids + [0])
    whole = defaultdict(list)
    for r in out:
        piece = np.frombuffer(r["ids"], "<u4")
        assert r["length"] == len(piece) <= capacity and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        whole[(r["__mf_file"], r["__mf_row"], r["doc_id"])].append((r["piece"], r["start"], piece.tolist()))
    got = defaultdict(list)
    for (_, _, i), parts in whole.items():
        parts.sort()
        assert [p for p, _, _ in parts] == list(range(len(parts)))
        assert all(len(x) == capacity for _, _, x in parts[1:])
        assert [s for _, s, _ in parts] == [sum(len(x) for _, _, x in parts[:k]) for k in range(len(parts))]
        got[i].append([t for _, _, x in parts for t in x])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in ids.items()}
    by_sequence = defaultdict(list)
    for r in out:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    least = -(-sum(r["length"] for r in out) // capacity)
    assert len(by_sequence) <= least * 1.25 + 2


def test_packing_an_empty_table(spark):
    assert packing.pack(packing.token_pieces(documents(spark, []), JSON, 64), 64).count() == 0


def test_texts_hold_the_awkward_cases():
    items = texts()
    assert None in items and "" in items and max(len(t or "") for t in items) >= 5000
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
