"""Whitening of embeddings from a bit-sliced scatter matrix.

Every entry becomes an integer (``floor(scale * c) + offset``), and each
distinct integer vector counts once (the fit list). The scatter matrix is
counted, not multiplied: a batch's entries are shifted to start at zero in
each dimension, bit ``a`` of dimension ``i`` of all its rows is packed into
the words of a plane, and the cross-product of two dimensions is the sum of
``2 ** (a + b)`` times the ones of plane ``(i, a)`` AND plane ``(j, b)``.
Shifts are taken back, tasks' sums added and the whole centred in integers
(``n * Q - S S'``), so nothing is lost before the one division that
``eigh`` starts from. The covariance and components are bounded by the width
of a vector and are all that the driver and the workers hold.

Defined cases: vectors that are null or hold null or non-finite entries, or
entries of ``LARGEST`` and more, are dropped; vectors of different lengths are
whitened apart; empty vectors have no components; components without variance
(below ``LEAST`` of the first one's) do not exist, so a single vector and its
copies give no rows; a null id is an id like others, and rows that repeat are
returned as often; ``deviation`` is null beyond 64 bits; an empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricforge.llm.common import keep, map_arrow

#: Entries so large or larger count as not finite (products with the scale
#: stay integers of 64 bits).
LARGEST = 2.0 ** 50
#: Least variance of a component, as a share of the first one's: what double
#: precision tells from zero.
LEAST = 1e-12
#: Rows whose planes are packed at a time.
ROWS = 1 << 14
LIMB = 60


def integers(table: DataFrame, scale: int = 64, offset: int = 1_000_000, id_col: str = "vec_id",
             vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, dims, x)`` of the usable rows."""
    rows = table.select(table[id_col].alias("vec_id"), table[vec_col].cast("array<double>").alias("vec"))
    sound = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return rows.where(F.coalesce(sound, F.lit(False)) & (F.size("vec") > 0)).select(
        "vec_id", F.size("vec").alias("dims"),
        F.transform("vec", lambda c: F.floor(c * scale).cast("long") + offset).alias("x"))


def _by_width(batch: pa.RecordBatch):
    """``(dims, part of the batch, matrix of x)`` for each length."""
    dims = batch.column("dims").to_numpy()
    for d in np.unique(dims).tolist():
        part = batch.filter(pa.array(dims == d))
        yield d, part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def cross_products(x: np.ndarray) -> np.ndarray:
    """Exact ``x' x`` of a matrix of unsigned 64-bit integers (as Python
    integers) by popcounts of its bit planes."""
    n, dims = x.shape
    planes = max(1, int(x.max()).bit_length())
    bits = (x.T[:, None, :] >> np.arange(planes, dtype=np.uint64)[None, :, None]) & np.uint64(1)
    packed = np.packbits(bits.astype(np.uint8), axis=2)
    packed = np.ascontiguousarray(np.pad(packed, ((0, 0), (0, 0), (0, -packed.shape[2] % 8)))).view(np.uint64)
    packed = packed.reshape(dims * planes, -1)
    ones = np.zeros((dims * planes, dims * planes), np.int64)
    for k in range(dims * planes):
        ones[k, k:] = np.bitwise_count(packed[k] & packed[k:]).sum(axis=1, dtype=np.int64)
    ones = np.maximum(ones, ones.T).reshape(dims, planes, dims, planes)
    weight = [[1 << (a + b) for b in range(planes)] for a in range(planes)]
    if 2 * planes + n.bit_length() <= 62:
        return np.einsum("iajb,ab->ij", ones, np.array(weight, np.int64)).astype(object)
    return sum(ones[:, a, :, b].astype(object) * weight[a][b] for a in range(planes) for b in range(planes))


def _moments(x: np.ndarray):
    """``(n, S, Q)`` of rows of integers: count, sums and cross-products."""
    low = x.min(axis=0)
    y = x.view(np.uint64) - low.view(np.uint64)[None, :]        # exact modulo 2**64
    n, low = len(x), low.astype(object)
    s = y.astype(object).sum(axis=0) if int(y.max()).bit_length() > 44 else y.sum(axis=0).astype(object)
    q = cross_products(y) + np.outer(low, s) + np.outer(s, low) + n * np.outer(low, low)
    return n, s + n * low, q


def scatter(fit: DataFrame) -> dict[int, tuple]:
    """``{dims: (n, S, Q)}`` of ``fit(dims, x)``, exact. Each task returns one
    matrix for each length; they are added as decimals in limbs."""
    def run(batches):
        held = {}
        for batch in batches:
            for d, _, x in _by_width(batch):
                for a in range(0, len(x), ROWS):
                    new = _moments(np.ascontiguousarray(x[a:a + ROWS]))
                    old = held.get(d, (0, 0, 0))
                    held[d] = tuple(p + q for p, q in zip(old, new, strict=True))
        for d, (n, s, q) in held.items():
            at = [(-1, -1, n), *((i, -1, s[i]) for i in range(d)),
                  *((i, j, q[i, j]) for i in range(d) for j in range(i, d))]
            i, j, v = zip(*at, strict=True)
            low = (1 << LIMB) - 1
            limbs = [[x & low for x in v], [x >> LIMB & low for x in v], [x >> 2 * LIMB for x in v]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), d, np.int32)), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 *(pa.array(x, pa.int64()) for x in limbs)], names=["dims", "i", "j", "l0", "l1", "l2"])

    parts = map_arrow(fit, run, "dims int, i int, j int, l0 long, l1 long, l2 long")
    sums = parts.groupBy("dims", "i", "j").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("l0", "l1", "l2")))
    found = defaultdict(dict)
    for r in sums.collect():                      # bounded by the square of the width
        found[r["dims"]][r["i"], r["j"]] = int(r["l0"]) + (int(r["l1"]) << LIMB) + (int(r["l2"]) << 2 * LIMB)
    return {d: (v[-1, -1], [v[i, -1] for i in range(d)], [[v[min(i, j), max(i, j)] for j in range(d)] for i in range(d)])
            for d, v in found.items()}


@dataclass
class Whitener:
    """``n`` vectors with sums ``sums``; ``components`` are the unit vectors
    (columns), by falling ``variances``; ``explained`` are their shares."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int], products: list[list[int]], most: int) -> Whitener:
        s = np.array(sums, object)
        centred = n * np.array(products, object) - np.outer(s, s)      # n * n times the covariance
        values, axes = np.linalg.eigh((centred / (n * n)).astype(np.float64))
        trace = sum(centred[i, i] for i in range(len(s))) / (n * n)
        order = np.argsort(-values, kind="stable")[:most]
        order = order[values[order] > max(values.max() * LEAST, 0)]
        axes, values = axes[:, order], values[order]
        # Either sign would do: the largest entry of a component is positive.
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))])
        return cls(n, sums, axes, values, values / trace if trace else values)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: 64-bit integers where they hold it."""
        most = max(1, int(np.abs(x).max(initial=0)))
        if self.n * most + max(map(abs, self.sums)) < 2 ** 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whiten(self, gap: np.ndarray) -> np.ndarray:
        return (gap / self.n).astype(np.float64) @ (self.components / np.sqrt(self.variances))


def _squares(gap: np.ndarray) -> list[int | None]:
    if len(gap) and gap.dtype != object and gap.shape[1] * int(np.abs(gap).max()) ** 2 < 2 ** 63:
        return (gap * gap).sum(axis=1).tolist()
    return [v if v < 2 ** 63 else None for v in (sum(int(g) ** 2 for g in row) for row in gap)]


def fit_whitening(fit: DataFrame, components: int = 16) -> dict[int, Whitener]:
    """A whitener for each length of the distinct vectors ``fit(dims, x)``."""
    return {d: Whitener.of(*moments, components) for d, moments in scatter(fit).items()}


def identity_errors(fit: DataFrame, models: dict[int, Whitener]) -> dict[int, float]:
    """The largest absolute entry of the whitened fit list's covariance minus
    the identity, measured on the whitened vectors."""
    held = fit.sparkSession.sparkContext.broadcast(models)   # bounded by the width

    def run(batches):
        sums = {}
        for batch in batches:
            for d, _, x in _by_width(batch):
                model = held.value[d]
                w = model.whiten(model.deviations(x))
                w = np.hstack([w, np.ones((len(w), 1))])
                sums[d] = sums.get(d, 0) + w.T @ w
        for d, s in sums.items():
            i, j = np.indices(s.shape)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, d, np.int32)), pa.array(i.ravel().astype(np.int32)),
                                              pa.array(j.ravel().astype(np.int32)), pa.array(s.ravel())],
                                             names=["dims", "i", "j", "s"])

    sums = map_arrow(fit, run, "dims int, i int, j int, s double").groupBy("dims", "i", "j").agg(F.sum("s").alias("s"))
    found = {d: np.zeros((len(m.variances) + 1,) * 2) for d, m in models.items()}
    for r in sums.collect():                      # components squared
        found[r["dims"]][r["i"], r["j"]] = r["s"]
    out = {}
    for d, s in found.items():
        mean = s[-1, :-1] / models[d].n
        gap = s[:-1, :-1] / models[d].n - np.outer(mean, mean) - np.eye(len(mean))
        out[d] = float(np.abs(gap).max(initial=0))
    return out


def whiten(table: DataFrame, components: int = 16, scale: int = 64, offset: int = 1_000_000, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained,
    identity_error)`` for each usable row and component."""
    rows = integers(table, scale, offset, id_col, vec_col)
    fit = keep(rows.select("dims", "x").distinct(), "fit")
    models = fit_whitening(fit, components)
    errors = identity_errors(fit, models)
    held = table.sparkSession.sparkContext.broadcast((models, errors))

    def run(batches):
        models, errors = held.value
        for batch in batches:
            for d, part, x in _by_width(batch):
                model, k = models[d], len(models[d].variances)
                if not k:
                    continue
                for a in range(0, len(x), 4096):
                    gap = model.deviations(x[a:a + 4096])
                    m = len(gap)
                    at = pa.array(np.repeat(np.arange(a, a + m), k))
                    again = pa.array(np.repeat(np.arange(m), k))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                         pa.array(np.full(m * k, model.n, np.int64)), pa.array(_squares(gap), pa.int64()).take(again),
                         pa.array(model.whiten(gap).ravel()), pa.array(np.tile(model.explained, m)),
                         pa.array(np.full(m * k, errors[d]))],
                        names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return map_arrow(rows, run, f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                                "explained double, identity_error double")
