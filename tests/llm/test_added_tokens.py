import random
import zlib

import numpy as np
import pytest
from helpers import documents
from tokenizers import Tokenizer

from metricforge.llm import packing, token_ids, token_store
from metricforge.llm.common import shared_path
from metricforge.llm.queries import TOKENIZER

END = "<|endoftext|>"
TEXTS = [END, f"a {END} b", f"{END}{END}", f" {END}\n\n {END} x", "<|endoftext|", f"<|{END}|>", "", "no token", f"it{END}'s"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(TOKENIZER)                   # default flags
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_added_tokens_as_the_library(library):
    assert library(f"a {END} b") == [64, 220, 50256, 275]
    r = random.Random(3)
    parts = [END, " ", "a", "  ", "\n", "é", "'s", "<|", "|>", "end", "12"]
    items = TEXTS + ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(400)]
    for run in (items, items[:1], [""], []):
        ids, ends = token_ids.encode(TOKENIZER, run)
        got = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=False)]
        assert got == [library(t) for t in run]


def test_added_tokens_in_the_store_and_in_pieces(spark, library):
    docs = documents(spark, TEXTS)
    path = shared_path(spark, "store")
    token_store.write_store(docs, TOKENIZER, path, end_id=2)
    got = {r["doc_id"]: r["ids"] for r in token_store.read_ids(docs.selectExpr("doc_id AS key"), path).collect()}
    assert got == {i: [*library(t), 2] for i, t in enumerate(TEXTS)}
    pieces = packing.token_pieces(docs, TOKENIZER, 2048, 0).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in pieces} == {
        i: zlib.crc32(np.array([*library(t), 0], "<u4").tobytes()) for i, t in enumerate(TEXTS)}
