"""Small tables with the awkward cases, and plain versions to compare with."""

import random
import re
import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that bear the operators' own names.
CLASHES = ["fp", "digest", "kept", "component_id", "h", "u", "block", "shard", "size", "rank", "__index__"]


def texts(seed=1, n=60):
    r = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "delta", "é", "ßx", "the", "of", "it's", "42", "x²", "!?", "naïve"]
    passage = " ".join(r.choice(words) + str(r.randint(0, 999)) for _ in range(60))
    out = []
    for i in range(n):
        own = " ".join(r.choice(words) + str(r.randint(0, 99999)) for _ in range(r.randint(0, 80)))
        out.append(own)
        if i % 7 == 3:
            out.append(own + " " + passage + " " + own[:50])
        if i % 11 == 5:
            out.append(own)
            out.append(own.replace(" ", "\t\n", 1))
    out += [None, "", " ", "\n\t ", None, "", "a", "a" * 5000, "ab" * 2000, "x " * 3000, passage, passage + " z",
            "日本語 " * 100, "😀" * 300, "'s's 'll we're  \n\n end ", "   wide", "a" * 5000, "A" * 5000]
    return out


def documents(spark, items=None, clash=False, dirty_ids=False):
    items = texts() if items is None else items
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or "")) for i, t in enumerate(items)]
    if dirty_ids:
        rows += [(None, "no id", "en", "s0", 5), (None, "no id", "en", "s0", 5), (3, "third again", None, None, None),
                 (3, "third again", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        for c in CLASHES:
            df = df.selectExpr("*", f"'x' AS `{c}`")
    return df


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def plain_repeats(raw_texts, length):
    """For each text (bytes): which bytes a repeated string covers."""
    seen = {}
    for raw in raw_texts:
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for raw in raw_texts:
        mark = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        out.append(mark)
    return out
