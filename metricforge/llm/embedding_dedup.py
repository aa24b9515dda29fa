"""Near-duplicate vectors by a subspace pigeonhole join.

Two unit vectors have a cosine of at least ``threshold`` exactly when their
squared distance is at most ``2 - 2 * threshold``. The vectors are rotated
and split into blocks of a few dimensions, and the budget of squared distance
is shared among the blocks in proportion to their variance. A pair within the
whole budget is within the share of one block at least. So in each block a
range join finds the candidates, and the union of the candidates is verified
by the exact cosine.

The range join cuts a block's first axis into strips as wide as the block's
radius; a strip meets itself and the next one, and its rows are held against a
window of the second axis. Only the block's coordinates travel there (two
bytes each; their rounding is allowed for), and what comes back is which rows
have a candidate at all. The whole vectors of those rows alone go to the same
place a second time to be verified.

Equal vectors are joined once, with a multiplicity. Strips are split into
tiles of ``TILE`` vectors, so a full strip is many tasks. Rotated coordinates
are integers (exact in double precision), so every task sees the same block
distances, and a pair that is near in several blocks counts in the first
only. Tasks return a count and one edge for each vector, never pairs.

Defined cases: vectors that are null, empty or all zero, or hold null or
non-finite components, and rows with a null label or a null id link with
nothing; vectors of different lengths do not link; rows that share an id are
one node of the graph; an empty table gives an empty result. Other columns
are not read. Rows find their group by a 128-bit hash of the vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricforge.llm.common import components, keep, map_arrow, ship, union

#: Blocks, vectors in a tile, and vectors the rotation is fitted on (it
#: decides the speed, not the result).
BLOCKS = 4
TILE = 2048
ROTATION_SAMPLE = 4096
#: Steps of a coordinate, and room for their rounding in a budget.
STEPS = 1 << 20
SLACK = 1e-3
#: Steps of a coordinate that travels as two bytes.
COARSE = 1 << 14
#: Cosines so close to the threshold are summed anew, term by term.
CLOSE = 1e-9


def _unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Subspaces:
    """A rotation, its split into blocks, and each block's share."""

    def __init__(self, sample: np.ndarray, threshold: float):
        dims = sample.shape[1]
        values, axes = np.linalg.eigh(np.cov(sample.T).reshape(dims, dims) if len(sample) > 1 else np.eye(dims))
        order = np.argsort(values)[::-1]
        blocks = min(BLOCKS, dims)
        turn = np.arange(dims) % (2 * blocks)
        where = np.minimum(turn, 2 * blocks - 1 - turn)     # there and back, so that shares are alike
        self.rotation = np.rint(axes[:, order] * STEPS)
        self.members = [np.flatnonzero(where == b) for b in range(blocks)]
        spread = np.array([values[order][m].clip(0).sum() for m in self.members])
        # No block's share falls below a tenth of the even share.
        share = np.maximum(spread / (spread.sum() or 1), 0.1 / blocks)
        budget = (2 - 2 * threshold) * (1 + SLACK) + SLACK
        self.budgets = np.floor(share / share.sum() * budget * STEPS * STEPS) + 1
        self.widths = np.ceil(np.sqrt(self.budgets))

    def rotate(self, unit: np.ndarray) -> np.ndarray:
        # Products and sums of integers below 2**53 are exact in any order.
        return np.rint(np.rint(unit * STEPS) @ self.rotation / STEPS)


    def coarse(self, turned: np.ndarray, b: int) -> np.ndarray:
        """A block's coordinates, in steps that two bytes hold."""
        return np.rint(turned[:, self.members[b]] * (COARSE / STEPS)).astype(np.int16)

    def coarse_budget(self, b: int) -> float:
        """The block's budget for coarse coordinates: each is off by half a
        step on both sides of a pair."""
        return (np.sqrt(self.budgets[b]) * COARSE / STEPS + np.sqrt(len(self.members[b]))) ** 2


def _may_be_near(x: np.ndarray, y: np.ndarray, budget: float, same: bool):
    """Which rows of ``x`` and of ``y`` have a row of the other within the
    budget (another row, if they are the same). Windows on the second axis."""
    axis = min(1, x.shape[1] - 1)
    ox, oy = np.argsort(x[:, axis], kind="stable"), np.argsort(y[:, axis], kind="stable")
    x, y = x[ox].astype(np.float64), y[oy].astype(np.float64)
    sx, sy, reach = (x * x).sum(axis=1), (y * y).sum(axis=1), np.sqrt(budget)
    hit_x, hit_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
    for a in range(0, len(x), 256):
        part = x[a:a + 256]
        lo, hi = np.searchsorted(y[:, axis], [part[0, axis] - reach, part[-1, axis] + reach + 1])
        near = sx[a:a + 256, None] + sy[None, lo:hi] - 2 * (part @ y[lo:hi].T) <= budget
        if same:
            at = np.arange(max(a, lo), min(a + len(part), hi))      # not each with itself
            near[at - a, at - lo] = False
        hit_x[a:a + 256] |= near.any(axis=1)
        hit_y[lo:hi] |= near.any(axis=0)
    out_x, out_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
    out_x[ox], out_y[oy] = hit_x, hit_y
    return out_x, out_y


def _near(space: Subspaces, b: int, threshold: float, x: np.ndarray, y: np.ndarray, same: bool):
    """Index pairs (into x, into y) with block ``b`` as their first near block
    and a cosine of at least ``threshold``; below the diagonal left out if x
    and y are the same."""
    ux, uy = _unit(x), _unit(y)
    rx, ry = space.rotate(ux), space.rotate(uy)
    squares = [((rx[:, m] ** 2).sum(axis=1), (ry[:, m] ** 2).sum(axis=1)) for m in space.members[:b + 1]]
    for a in range(0, len(x), 256):
        part = slice(a, a + 256)
        left = None
        for k, m in enumerate(space.members[:b + 1]):
            sx, sy = squares[k]
            within = sx[part, None] + sy[None, :] - 2 * (rx[part][:, m] @ ry[:, m].T) <= space.budgets[k]
            within = within if k == b else ~within
            left = within if left is None else left & within
        cosine = ux[part] @ uy.T
        left &= cosine >= threshold - CLOSE
        i, j = np.nonzero(left)
        if same:
            i, j = i[i + a < j], j[i + a < j]
        sure = cosine[i, j] >= threshold + CLOSE
        p, q = i[~sure] + a, j[~sure]
        norm = np.sqrt((x[p] * x[p]).sum(axis=1)) * np.sqrt((y[q] * y[q]).sum(axis=1))
        sure[~sure] = (x[p] * y[q]).sum(axis=1) / norm >= threshold
        yield i[sure] + a, j[sure]


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of ``parent`` (all of depth one, roots the smallest)
    that the pairs connect: the larger root hangs below the smaller until no
    pair has two."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent[:] = up


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def link_vectors(reps: DataFrame, threshold: float) -> DataFrame:
    """``(node, links, root)`` of the vectors ``reps(rep, label, node, copies,
    vec)`` (``rep`` is their own number; several may have one node) that link with another one: the linked vectors (with copies) of one task,
    and the smallest node its links reach there."""
    spark = reps.sparkSession
    ship(spark)
    reps = reps.withColumn("dims", F.size("vec"))
    sample = reps.select("dims", "vec").orderBy(F.xxhash64("vec")).limit(ROTATION_SAMPLE).collect()
    by_dims: dict[int, list] = {}
    for r in sample:
        by_dims.setdefault(r["dims"], []).append(r["vec"])
    spaces = {d: Subspaces(_unit(np.array(v, np.float64)), threshold) for d, v in by_dims.items()}

    def space(dims: int) -> Subspaces:
        if dims not in spaces:
            spaces[dims] = Subspaces(np.zeros((0, dims)), threshold)
        return spaces[dims]

    def strips(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                own = space(d)
                at = own.rotate(_unit(_matrix(part.column("vec"))))
                for b, m in enumerate(own.members):
                    strip = np.floor(at[:, m[0]] / own.widths[b]).astype(np.int32)
                    block = own.coarse(at, b)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("label"), part.column("dims"), pa.array(np.full(len(part), b, np.int32)),
                         pa.array(strip), part.column("rep"),
                         pa.array([x.tobytes() for x in block], pa.binary())],
                        names=["label", "dims", "block", "strip", "rep", "at"])

    kind = reps.schema["label"].dataType.simpleString()
    rows = keep(map_arrow(reps.select("label", "dims", "rep", "vec"), strips,
                          f"label {kind}, dims int, block int, strip int, rep long, at binary"), "strips")
    # A row for each strip, with the tiles of its neighbours.
    where = ["label", "dims", "block"]
    tiles = rows.groupBy(*where, "strip").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    sides = [tiles.select(*where, (F.col("strip") + step).alias("strip"), F.lit(0).alias("own"),
                          F.when(F.lit(step == 1), F.col("tiles")).otherwise(0).alias("before"),
                          F.when(F.lit(step == -1), F.col("tiles")).otherwise(0).alias("after")) for step in (1, -1)]
    around = union([tiles.select(*where, "strip", F.col("tiles").alias("own"), F.lit(0).alias("before"),
                                 F.lit(0).alias("after")), *sides])
    around = keep(around.groupBy(*where, "strip").agg(F.max("own").alias("own"), F.max("before").alias("before"),
                                                      F.max("after").alias("after")).where("own > 0"), "tiles")
    rows = rows.join(around, [*where, "strip"]).withColumn("tile", F.expr("cast(pmod(xxhash64(rep), own) as int)"))

    # A unit (strip, i, j): tile i at home, tile j of its strip (if later) and
    # tile j of the next strip as guests.
    home = rows.select("*", F.col("strip").alias("s"), F.col("tile").alias("i"), F.lit(0).alias("role"),
                       F.explode(F.sequence(F.lit(0), F.greatest("own", "after") - 1)).alias("j")).where(
        ((F.col("j") >= F.col("tile")) & (F.col("j") < F.col("own"))) | (F.col("j") < F.col("after")))
    later = rows.where("tile > 0").select("*", F.col("strip").alias("s"), F.col("tile").alias("j"), F.lit(1).alias("role"),
                                          F.explode(F.sequence(F.lit(0), F.col("tile") - 1)).alias("i"))
    guest = rows.where("before > 0").select("*", (F.col("strip") - 1).alias("s"), F.col("tile").alias("j"),
                                            F.lit(2).alias("role"),
                                            F.explode(F.sequence(F.lit(0), F.col("before") - 1)).alias("i"))
    unit = [*where, "s", "i", "j"]
    load = union([x.select(*unit, "role", "rep", "at") for x in (home, later, guest)])

    def candidates(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1).select(unit[1:]).to_pylist()[0]
        own, b = space(first["dims"]), first["block"]
        at = np.frombuffer(b"".join(table.column("at").to_pylist()), np.int16).reshape(len(table), -1)
        role, budget, hit = table.column("role").to_numpy(), own.coarse_budget(b), np.zeros(len(table), bool)
        h = np.flatnonzero(role == 0)
        if first["i"] == first["j"]:
            x, y = _may_be_near(at[h], at[h], budget, True)
            hit[h] |= x | y
        for side in (1, 2):
            p = np.flatnonzero(role == side)
            if len(h) and len(p):
                x, y = _may_be_near(at[h], at[p], budget, False)
                hit[h] |= x
                hit[p] |= y
        return table.filter(pa.array(hit)).drop_columns(["at"])

    names = f"label {kind}, dims int, block int, s int, i int, j int, role int, rep long"
    few = keep(load.groupBy(*unit).applyInArrow(candidates, names), "candidates")
    few = few.join(reps.select("rep", "node", "copies", "vec"), "rep")

    def match(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")           # roots are the smallest nodes
        first = table.slice(0, 1).select(unit[1:]).to_pylist()[0]
        role = table.column("role").to_numpy()
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        vec = _matrix(table.column("vec"))
        h = np.flatnonzero(role == 0)
        pairs = [(h, np.flatnonzero(role == side), False) for side in (1, 2)]
        if first["i"] == first["j"]:
            pairs.append((h, h, True))
        links, parent = np.zeros(len(node), np.int64), np.arange(len(node))
        for x, y, same in pairs:
            if len(x) and len(y):
                for i, j in _near(space(first["dims"]), first["block"], threshold, vec[x], vec[y], same):
                    i, j = x[i], y[j]
                    # Sums of counts below 2**53 are exact in doubles.
                    links += np.bincount(i, copies[j], len(node)).astype(np.int64)
                    links += np.bincount(j, copies[i], len(node)).astype(np.int64)
                    _join(parent, i, j)
        at = np.flatnonzero(links)
        return pa.table({"node": pa.array(node[at]), "links": pa.array(links[at]), "root": pa.array(node[parent[at]])})

    load = few.select(*unit, "role", "node", "copies", "vec")
    return load.groupBy(*unit).applyInArrow(match, "node long, links long, root long")


def near_vectors(table: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row."""
    rows = table.select(table[id_col].cast("long").alias("vec_id"), table[label_col].alias("label"),
                        table[vec_col].alias("vec"))
    # Null where any component is null, or not finite.
    sound = F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists("vec", lambda x: x != 0), F.lit(False))
    able = sound & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    reps = keep(rows.where(able).groupBy("label", "vec").agg(F.min("vec_id").alias("node"),
                                                            F.count("*").alias("copies"))
                .withColumn("rep", F.monotonically_increasing_id()), "vectors")
    found = keep(link_vectors(reps, threshold), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    print_ = [F.xxhash64("vec").alias("h"), F.xxhash64(F.lit(1), "vec").alias("k")]
    reps = (reps.select("label", "node", "copies", *print_).join(links, "node", "left").join(linked, "node", "left")
            .select("label", "h", "k", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("component", "node").alias("component")))
    rows = rows.select("vec_id", "label", able.alias("able"), *print_)
    same = [F.col(f"r.{c}") == F.col(f"g.{c}") for c in ("label", "h", "k")]
    out = rows.alias("r").join(reps.alias("g"), same[0] & same[1] & same[2] & F.col("r.able"), "left")
    component = F.coalesce("g.component", "r.vec_id")
    return out.select("r.vec_id", F.coalesce("g.n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("r.vec_id") == component, F.lit(False)).alias("kept"))


def near_vectors_sql(threshold: float) -> str:
    """Links and components in one statement for a second engine."""
    return f"""
WITH RECURSIVE able AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= {threshold}),
reach AS (
  SELECT DISTINCT a AS x, a AS y FROM links
  UNION SELECT x, b FROM reach JOIN links ON y = a),
named AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN named ON x = vec_id LEFT JOIN counted ON a = vec_id"""
