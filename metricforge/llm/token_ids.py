"""Ids of whole texts by the tokenizers library.

The library's BPE model encodes each distinct piece once: texts are cut into
the pieces of the byte-level pre-tokeniser (``bpe.boundaries``), written in
the byte-level alphabet, and pieces that the worker's cache does not hold go
to the model. Merges never cross pieces, so the ids are those of the whole
text. ``encode`` cuts texts at the json's added tokens first, as the library
does with its default flags, and gives these their own ids;
``library_encoder`` takes their strings as ordinary text.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np

from metricforge.llm.bpe import Encoder


@cache
def byte_alphabet() -> np.ndarray:
    """The character of each byte in byte-level vocabularies: printable
    Latin-1 as it is, the others in order from U+0100 on."""
    plain = np.zeros(256, bool)
    for a, b in (("!", "~"), ("\xa1", "\xac"), ("\xae", "\xff")):
        plain[ord(a):ord(b) + 1] = True
    out = np.arange(256)
    out[~plain] = 256 + np.arange((~plain).sum())
    return out.astype("<u4")


@cache
def library_encoder(path: str) -> Encoder:
    from tokenizers import Tokenizer

    tokenize = Tokenizer.from_file(path).model.tokenize

    def merge(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = byte_alphabet()[np.frombuffer(b"".join(pieces), np.uint8)].tobytes().decode("utf-32-le")
        flat, size, at = [], [], 0
        for p in pieces:
            found = tokenize(text[at:at + len(p)])
            flat += [t.id for t in found]
            size.append(len(found))
            at += len(p)
        return np.array(flat, np.int64), np.array(size, np.int64)

    return Encoder(merge)


@cache
def added_tokens(path: str) -> tuple[dict[str, int], re.Pattern]:
    """``(ids of the json's added tokens, what finds them)``, the longest first."""
    with open(path) as f:
        tokens = json.load(f).get("added_tokens") or []
    if wide := [t["content"] for t in tokens if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]:
        raise ValueError(f"added tokens that take in what is around them: {wide}")
    number = {t["content"]: t["id"] for t in tokens}
    return number, re.compile("|".join(map(re.escape, sorted(number, key=len, reverse=True))) or "(?!)")


def encode(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(ids of all texts, end of each text in them)``: those of the
    library's ``encode(text, add_special_tokens=False)``."""
    number, pattern = added_tokens(path)
    encoder = library_encoder(path)
    if not any(s in t for s in number for t in texts):
        return encoder.encode(texts)
    found = [pattern.findall(t) for t in texts]
    ids, ends = encoder.encode([part for t in texts for part in pattern.split(t)])
    tokens = np.cumsum([len(x) for x in found])
    last = np.arange(len(texts)) + tokens                # each text has a part more than tokens
    within = np.ones(len(ends), bool)
    within[last] = False
    return np.insert(ids, ends[within], [number[s] for x in found for s in x]), ends[last] + tokens


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> list[np.ndarray]:
    """The ids of each text, closed by ``end_id``, as unsigned 32-bit."""
    stop = [end_id]
    return [np.append(ids[a:b], stop).astype("<u4") for a, b in
            zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True)]
