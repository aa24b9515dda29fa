"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regular expression. Each code point gets a class
from an array, a class (with one or two code points of lookahead folded in)
is a transition function of a small automaton, and the automaton's states
are found by an associative scan: functions are numbered elements of a
finite monoid, blocks of the text are folded side by side, the block totals
are scanned in log steps, and every position then knows the state before
it. Boundaries follow from (state, class). The slices between boundaries go
through a bounded cache; pieces that are not in it are merged together.

Defined cases: a null text counts as empty and gives no ids; texts of any
length are encoded whole; repeated rows give repeated results; an empty
table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from metricforge.llm.common import map_arrow

#: The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
               0x3000]

# Classes of code points.
LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
# Symbols the automaton reads; + FIRST at the start of a document.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_SPACE, S_WHITE, S_RUN = range(8)
FIRST = 8
# States: what the piece under way is.
BEGIN, SPACED, BLANK, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_MORE, TWO_MORE = range(8)

#: Characters handled at once, pieces a worker remembers, and the piece
#: length (bytes) from which a heap finds the merges.
CHUNK_CHARS = 1 << 20
CACHE_PIECES = 500_000
LONG_PIECE = 64
#: Slots of the cache's table (a power of two, well above what it holds), and
#: the bytes of a piece that fit into its key.
TABLE_SLOTS = 1 << 21
KEY_BYTES = 23
KEY_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


@cache
def class_table() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = WHITE
    table[0x20] = SPACE
    return table


def _next(state: int, symbol: int) -> int:
    if symbol >= FIRST:
        return _next(BEGIN, symbol - FIRST)
    if symbol == S_LETTER:
        return {ONE_MORE: BEGIN, TWO_MORE: ONE_MORE}.get(state, IN_LETTERS)
    if symbol in (S_SHORT, S_LONG) and state not in (SPACED, IN_OTHERS):
        return ONE_MORE if symbol == S_SHORT else TWO_MORE
    return {S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS, S_SHORT: IN_OTHERS, S_LONG: IN_OTHERS,
            S_SPACE: SPACED, S_WHITE: BLANK, S_RUN: BLANK}[symbol]


def _starts_piece(state: int, symbol: int) -> bool:
    if symbol >= FIRST:
        return True
    goes_on = {S_LETTER: (SPACED, IN_LETTERS, ONE_MORE, TWO_MORE), S_NUMBER: (SPACED, IN_NUMBERS),
               S_OTHER: (SPACED, IN_OTHERS), S_SHORT: (SPACED, IN_OTHERS), S_LONG: (SPACED, IN_OTHERS),
               S_SPACE: (), S_WHITE: (), S_RUN: (BLANK,)}
    return state not in goes_on[symbol]


@cache
def automaton():
    """``(generator of each symbol, product table, function table, starts)``:
    the transition functions closed under composition, as numbers."""
    n_sym = 2 * FIRST
    gens = [tuple(_next(s, y) for s in range(8)) for y in range(n_sym)]
    identity = tuple(range(8))
    found = {identity: 0}
    todo = [identity]
    while todo:
        f = todo.pop()
        for g in gens:
            h = tuple(g[f[s]] for s in range(8))
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    funcs = sorted(found, key=found.get)
    product = np.array([[found[tuple(g[f[s]] for s in range(8))] for g in funcs] for f in funcs], np.intp)
    starts = np.array([[_starts_piece(s, y) for y in range(n_sym)] for s in range(8)])
    return (np.array([found[g] for g in gens], np.uint8), product, np.array(funcs, np.uint8), starts)


def _symbols(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    n = len(cp)
    cls = class_table()[cp]
    white = cls >= SPACE
    last = np.append(first[1:], True)
    next_text = np.append(~white[1:], False) & ~last
    sym = cls.copy()
    sym[white] = S_RUN
    sym[white & next_text & (cls == SPACE)] = S_SPACE
    sym[white & next_text & (cls == WHITE)] = S_WHITE
    quote = np.flatnonzero(cp == 0x27)
    quote = quote[quote + 1 < n]
    quote = quote[~first[quote + 1]]
    one = cp[quote + 1]
    sym[quote[np.isin(one, [ord(c) for c in "stmd"])]] = S_SHORT
    far = quote[quote + 2 < n]
    far = far[~first[far + 2]]
    one, two = cp[far + 1], cp[far + 2]
    pair = np.zeros(len(far), bool)
    for a, b in ("re", "ve", "ll"):
        pair |= (one == ord(a)) & (two == ord(b))
    sym[far[pair]] = S_LONG
    return sym + FIRST * first.astype(np.uint8)


def boundaries(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions at which a piece starts, over concatenated documents;
    ``first`` marks the first code point of each."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    gen, product, funcs, starts = automaton()
    sym = _symbols(cp, first)
    block = max(16, int(np.sqrt(n) / 2))
    rows = -(-n // block)
    grid = np.zeros(rows * block, np.uint8)
    grid[:n] = gen[sym]
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)
    before = np.empty_like(grid)
    acc = np.zeros(rows, np.intp)
    flat = product.ravel()
    for j in range(block):                      # fold all blocks side by side
        before[j] = acc
        acc = flat.take(acc * len(funcs) + grid[j])
    step = 1
    while step < rows:                          # scan of the block totals
        acc[step:] = product[acc[:-step], acc[step:]]
        step *= 2
    at = np.zeros(rows, np.int64)
    at[1:] = funcs[acc[:-1], BEGIN]
    state = funcs.ravel().take(before * np.intp(8) + at[None, :]).T.ravel()[:n]
    return np.flatnonzero(starts.ravel().take(state * np.intp(2 * FIRST) + sym))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PairMerger:
    """Merges many pieces at once by the rank of the joined bytes: the lowest
    rank first, the leftmost of equal ranks first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        keys, vals = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        # Open addressing: a slot table filled round by round.
        self.mask = (1 << (2 * len(keys)).bit_length()) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.vals = np.zeros(self.mask + 1, np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):
            self.probes += 1
            free = left[self.keys[slot[left]] == -1]
            self.keys[slot[free]] = keys[free]
            won = free[self.keys[slot[free]] == keys[free]]
            self.vals[slot[won]] = vals[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask
        self.pairs = dict(pairs)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x >> np.uint64(40)) ^ (x >> np.uint64(20))).astype(np.int64) & self.mask

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        slot = self._slot(keys)
        out = np.full(len(keys), 1 << 20, np.int64)
        open_ = np.arange(len(keys))
        for _ in range(self.probes):
            have = self.keys[slot[open_]]
            hit = have == keys[open_]
            out[open_[hit]] = self.vals[slot[open_[hit]]]
            open_ = open_[~hit & (have != -1)]
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
        return out

    def long(self, piece: bytes) -> np.ndarray:
        """One long piece, with a heap of pairs."""
        tok = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(tok)
        nxt, prv = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, tok[i], tok[i + 1]) for i in range(n - 1)
                if (r := self.pairs.get(tok[i] << 32 | tok[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if tok[i] != a or j < 0 or tok[j] != b:
                continue
            tok[i], tok[j], nxt[i] = r, -1, nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y >= 0 and (s := self.pairs.get(tok[x] << 32 | tok[y])) is not None:
                    heapq.heappush(heap, (s, x, tok[x], tok[y]))
        return np.array([t for t in tok if t >= 0], np.int64)

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all pieces, number of ids of each)``."""
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        base = np.cumsum(length) - length
        out, count = np.full(int(length.sum()), -1, np.int64), np.zeros(len(pieces), np.int64)

        def put(owner: np.ndarray, tok: np.ndarray, size: np.ndarray) -> None:
            within = np.arange(len(tok)) - np.repeat(np.cumsum(size) - size, size)
            out[np.repeat(base[owner], size) + within] = tok
            count[owner] = size

        for i in np.flatnonzero(length > LONG_PIECE).tolist():
            tok = self.long(pieces[i])
            put(np.array([i]), tok, np.array([len(tok)]))
        owner = np.flatnonzero(length <= LONG_PIECE)
        size = length[owner]
        tok = self.byte_id[np.frombuffer(b"".join(pieces[i] for i in owner.tolist()), np.uint8)]
        while len(owner):
            ends = np.cumsum(size)
            key = np.full(len(tok), 1 << 20, np.int64)
            key[:-1] = self.rank(tok[:-1], tok[1:])
            key[ends - 1] = 1 << 20
            best = np.minimum.reduceat(key << 40 | np.arange(len(tok)), ends - size)
            done = best >> 40 >= 1 << 20
            if done.any():
                put(owner[done], tok[np.repeat(done, size)], size[done])
            pos = best[~done] & ((1 << 40) - 1)
            tok[pos] = best[~done] >> 40
            live = ~np.repeat(done, size)
            live[pos + 1] = False
            tok, size, owner = tok[live], (size - 1)[~done], owner[~done]
        return out[out >= 0], count


class Encoder:
    """Texts to ids through a bounded cache of pieces; ``merge`` encodes the
    pieces that the cache does not hold.

    Pieces of up to ``KEY_BYTES`` bytes are three machine words (the last
    holds the length), looked up together in an open-addressing table; longer
    ones are in a dict. An entry keeps its piece's ids and the number of
    chunks that had it.
    """

    def __init__(self, merge: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.merge = merge
        self._clear()

    def _clear(self) -> None:
        self.slots = np.full(TABLE_SLOTS, -1, np.int32)
        self.entries, self.used = 0, 0
        self.keys = np.zeros((1 << 14, 3), np.uint64)
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.chunks_in = np.zeros(1 << 14, np.int32)
        self.flat = np.zeros(1 << 16, np.int32)
        self.long: dict[bytes, int] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x = (x + keys[:, 1]) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x = (x + keys[:, 2]) * np.uint64(0x94D049BB133111EB)
        return (x >> np.uint64(32)).astype(np.int64) & (TABLE_SLOTS - 1)

    def _look(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, or -1."""
        slot, out = self._slot(keys), np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        while len(left):
            entry = self.slots[slot[left]]
            left, entry = left[entry >= 0], entry[entry >= 0]
            have, want = self.keys[entry], keys[left]
            same = (have[:, 0] == want[:, 0]) & (have[:, 1] == want[:, 1]) & (have[:, 2] == want[:, 2])
            out[left[same]] = entry[same]
            left = left[~same]
            slot[left] = (slot[left] + 1) & (TABLE_SLOTS - 1)
        return out

    def _add(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """New entries for pieces with these ids."""
        at, n = self.entries, len(sizes)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while at + n > len(self.start):
            self.keys, self.start, self.size, self.chunks_in = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.keys, self.start, self.size, self.chunks_in))
        self.flat[self.used:self.used + len(flat)] = flat
        self.start[at:at + n] = self.used + np.cumsum(sizes) - sizes
        self.size[at:at + n] = sizes
        self.entries, self.used = at + n, self.used + len(flat)
        return np.arange(at, at + n)

    @staticmethod
    def _spread(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The slices of ``flat``, one after the other."""
        stop = np.cumsum(size)
        return flat[np.repeat(start - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)]

    def _insert(self, entry: np.ndarray) -> None:
        """Put entries whose keys are set, all different, into the table."""
        slot, left = self._slot(self.keys[entry]), np.arange(len(entry))
        while len(left):
            free = left[self.slots[slot[left]] < 0]
            self.slots[slot[free]] = entry[free]
            left = left[self.slots[slot[left]] != entry[left]]
            slot[left] = (slot[left] + 1) & (TABLE_SLOTS - 1)

    def _shrink(self) -> None:
        """Forget what only one chunk has had; everything, if that is not
        half of the cache."""
        keys, start, size, seen, flat = self.keys, self.start, self.size, self.chunks_in, self.flat
        old, again = self.long, seen[:self.entries] > 1
        self._clear()
        if not again.any() or again.sum() > CACHE_PIECES // 2:
            return
        self.long = {p: k for p, k in old.items() if again[k]}
        is_long = np.zeros(len(again), bool)
        is_long[list(self.long.values())] = True
        for kind in (False, True):
            which = np.flatnonzero(again & (is_long == kind))
            if len(which):
                entry = self._add(self._spread(flat, start[which], size[which]), size[which])
                if kind:
                    number = dict(zip(which.tolist(), entry.tolist(), strict=True))
                    self.long = {p: number[k] for p, k in self.long.items()}
                else:
                    self.keys[entry] = keys[which]
                    self._insert(entry)

    def _entries(self, raw: bytes, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The entry of each piece ``raw[begin:begin + size]``."""
        padded = raw + bytes(24)
        words = np.ndarray((len(raw) + 17,), "<u8", padded, strides=(1,))
        keys = np.zeros((len(begin), 3), np.uint64)
        keys[:, 0] = words[begin] & KEY_MASKS[np.minimum(size, 8)]
        for k in (1, 2):
            on = np.flatnonzero(size > 8 * k)
            keys[on, k] = words[begin[on] + 8 * k] & KEY_MASKS[np.minimum(size[on] - 8 * k, 8 - k // 2)]
        keys[:, 2] |= size.astype(np.uint64) << np.uint64(56)
        short = size <= KEY_BYTES
        every = bool(short.all())
        entry = np.full(len(begin), -1, np.int64)
        entry[short] = self._look(keys if every else keys[short])
        new = np.flatnonzero(short & (entry < 0))
        if len(new):
            order = new[np.lexsort(keys[new].T)]
            first = np.append(True, (keys[order[1:]] != keys[order[:-1]]).any(axis=1))
            once = order[first]
            added = self._add(*self.merge([raw[a:a + n] for a, n in zip(begin[once].tolist(), size[once].tolist(),
                                                                        strict=True)]))
            self.keys[added] = keys[once]
            self._insert(added)
            entry[order] = added[np.cumsum(first) - 1]
        if not every:
            at = np.flatnonzero(~short)
            pieces = [raw[a:a + n] for a, n in zip(begin[at].tolist(), size[at].tolist(), strict=True)]
            if once := [p for p in dict.fromkeys(pieces) if p not in self.long]:
                self.long.update(zip(once, self._add(*self.merge(once)).tolist(), strict=True))
            entry[at] = [self.long[p] for p in pieces]
        seen = np.zeros(self.entries, bool)
        seen[entry] = True
        self.chunks_in[:self.entries] += seen
        return entry

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts, end of each text in them)``."""
        joined = "".join(texts)
        cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        if not len(cp):
            return np.zeros(0, np.int32), ends
        first = np.zeros(len(cp), bool)
        begins = np.append(0, ends[:-1])
        first[begins[begins < ends]] = True
        cut = boundaries(cp, first)
        # Code point positions to byte positions.
        wide = (cp >= 0x80).astype(np.int8) + (cp >= 0x800) + (cp >= 0x10000)
        extra = np.append(0, np.cumsum(wide, dtype=np.int64))
        at = np.append(cut + extra[cut], len(cp) + extra[-1])
        if self.entries > CACHE_PIECES:
            self._shrink()
        entry = self._entries(joined.encode(), at[:-1], np.diff(at))
        size = self.size[entry]
        ids = self._spread(self.flat, self.start[entry], size)
        return ids, np.append(0, np.cumsum(size))[np.searchsorted(cut, ends)]


def chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``limit`` characters (one text at least)."""
    run, begin, size = [], 0, 0
    for i, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1])
        if size >= limit:
            yield begin, run
            run, begin, size = [], i + 1, 0
    if run:
        yield begin, run


@cache
def rank_encoder(path: str) -> Encoder:
    return Encoder(PairMerger(read_ranks(path)))


@cache
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """``(all tokens' bytes, end of each)`` in id order."""
    ranks = sorted(read_ranks(path).items(), key=lambda x: x[1])
    size = np.zeros(ranks[-1][1] + 1, np.int64)
    size[[r for _, r in ranks]] = [len(t) for t, _ in ranks]
    return np.frombuffer(b"".join(t for t, _ in ranks), np.uint8), np.cumsum(size)


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat.astype(np.int32)))


def _encoded(batches, ranks_path: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) batches to (doc_id, ids, offsets) batches."""
    enc = rank_encoder(ranks_path)
    _, stops = token_bytes(ranks_path)
    width = np.diff(np.append(0, stops))
    for batch in batches:
        for begin, texts in chunks(batch.column(1).to_pylist()):
            ids, ends = enc.encode(texts)
            stop = np.append(0, np.cumsum(width[ids]))
            per_doc = np.diff(np.append(0, ends))
            offsets = stop[:-1] - np.repeat(stop[np.append(0, ends[:-1])], per_doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(begin, len(texts)), _lists(ids, ends), _lists(offsets, ends)],
                names=["doc_id", "ids", "offsets"])


def encode_documents(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
                     decode: bool = False) -> DataFrame:
    """``(doc_id, ids array<int>, offsets array<int>)``: the ids of each whole
    text and the byte at which each token starts. With ``decode``, also what
    ``decode_documents`` adds, from the same task."""
    def run(batches):
        found = _encoded(batches, ranks_path)
        return _decoded(found, ranks_path, ["doc_id", "ids", "offsets"]) if decode else found

    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    schema = T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("offsets", T.ArrayType(T.IntegerType())),
                           *([T.StructField("decoded", T.BinaryType())] if decode else [])])
    return map_arrow(src, run, schema)


def _parts(batch: pa.RecordBatch, column: int, limit: int = CHUNK_CHARS // 4) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` list elements (one row at least)."""
    ends = np.cumsum(batch.column(column).value_lengths().to_numpy(zero_copy_only=False))
    a = 0
    while a < batch.num_rows:
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(a, b - a)
        a = b


def _decoded(batches, ranks_path: str, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches with ids and offsets, plus each document's bytes."""
    flat, stops = token_bytes(ranks_path)
    begins = np.append(0, stops[:-1])
    at_ids, at_offsets = columns.index("ids"), columns.index("offsets")
    for batch in batches:
        for part in _parts(batch, at_ids):
            ids, offsets = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in (at_ids, at_offsets))
            count = part.column(at_ids).value_lengths().to_numpy(zero_copy_only=False)
            size = stops[ids] - begins[ids]
            # Length of a document: its last token's offset and size.
            ends = np.cumsum(count)
            has = count > 0
            length = np.zeros(len(count), np.int64)
            length[has] = offsets[ends[has] - 1] + size[ends[has] - 1]
            base = np.append(0, np.cumsum(length))
            target = np.repeat(base[:-1], count) + offsets
            stop = np.cumsum(size)
            within = np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - size, size)
            out = np.zeros(base[-1], np.uint8)
            out[np.repeat(target, size) + within] = flat[np.repeat(begins[ids], size) + within]
            raw = out.tobytes()
            texts = [raw[a:b] for a, b in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())],
                                             names=[*columns, "decoded"])


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` plus ``decoded`` (binary): each token's bytes put at its
    offset."""
    columns = encoded.columns
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return map_arrow(encoded, lambda batches: _decoded(batches, ranks_path, columns), schema)
