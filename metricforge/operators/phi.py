"""Correlation of columns of any kind (A36, H14): the coefficient phi_K of
Baak et al. (2018, arXiv:1811.11440).

Two columns are tabulated (numbers in ``BINS`` equal-width bins, other values
as they are). Pearson's chi-square of the table is then read as if it came
from a bivariate normal distribution cut into as many uniform bins between -5
and 5 standard deviations; the correlation of that distribution is phi_K: 0
without association, 1 where one column tells the other.

The tables of all pairs come from one pass over the rows (a row gives one row
for each pair, counted map-side). Chi-square is added up over the cells that
occur, as in ``chi_square``. What is left is a row for each pair, bounded by
the columns, and the solver: a bisection for all pairs of a batch at once.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricforge.functions.numeric import dec_round
from metricforge.session import ship, write_once

#: Bins of a number, reach of the normal distribution in standard deviations,
#: nodes of the integral, halvings of the bisection, and the largest
#: correlation below the full one.
BINS = 10
REACH = 5.0
ALMOST = 1 - 1e-9
NODES = 48
HALVINGS = 44
#: Cells of a table for which the theory is worked out (one task, one pair),
#: and values of an array.
CELLS = 1 << 20
AT_ONCE = 1 << 18


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x])


class Theory:
    """Chi-square per row of a bivariate normal distribution with correlation
    rho, in ``rows x columns`` uniform bins, against independence."""

    def __init__(self, rows: int, columns: int):
        self.a, self.b = (np.linspace(-REACH, REACH, n + 1) for n in (rows, columns))
        self.apart = np.outer(np.diff(_normal_cdf(self.a)), np.diff(_normal_cdf(self.b)))
        self.nodes, self.weights = np.polynomial.legendre.leggauss(NODES)

    def chi_square(self, rho: float) -> float:
        # The cells' gain over independence: the density's derivative by the
        # correlation is the density, integrated over the angle asin(rho).
        top, gain = math.asin(rho), np.zeros(self.apart.shape)
        h, k = self.a[None, :, None], self.b[None, None, :]
        step = max(1, AT_ONCE // self.apart.size)
        for i in range(0, NODES, step):
            angle = (self.nodes[i:i + step, None, None] + 1) * top / 2
            corner = np.exp(-(h * h + k * k - 2 * h * k * np.sin(angle)) / (2 * np.cos(angle) ** 2))
            cells = np.diff(np.diff(corner, axis=1), axis=2)
            gain += (cells * self.weights[i:i + step, None, None]).sum(axis=0) * top / (4 * math.pi)
        return float((gain * gain / self.apart).sum())


def solve_phi(chi2: float, n: float, rows: int, columns: int) -> float | None:
    """The correlation whose theory gives ``chi2`` (above the noise of
    ``(rows - 1)(columns - 1)`` degrees of freedom, scaled so that the largest
    possible chi-square is that of full correlation). None for a constant, and
    for tables of more than ``CELLS`` cells."""
    if rows < 2 or columns < 2 or rows * columns > CELLS:
        return None
    most, noise = n * (min(rows, columns) - 1), (rows - 1) * (columns - 1)
    if chi2 <= noise or most <= noise:
        return 0.0
    if chi2 >= most:
        return 1.0
    theory = Theory(rows, columns)
    low, high = 0.0, ALMOST
    goal = (chi2 - noise) / (most - noise) * theory.chi_square(high)
    for _ in range(HALVINGS):
        mid = (low + high) / 2
        low, high = (mid, high) if theory.chi_square(mid) < goal else (low, mid)
    return (low + high) / 2


def binned(df: DataFrame, numbers: Sequence[str], bins: int = BINS) -> DataFrame:
    """``df`` with each of ``numbers`` as the number of its equal-width bin
    between the column's least and greatest value (one aggregate for all);
    NaN is missing, as in pandas."""
    number = lambda x: F.nullif(F.col(x).cast("double"), F.lit(float("nan")))
    ends = write_once(df.agg(*[f(number(x)).alias(f"{side}_{i}") for i, x in enumerate(numbers)
                               for f, side in ((F.min, "lo"), (F.max, "hi"))]))

    def bin_of(i: int, x: str) -> Column:
        lo, hi = (ends.select(f"{side}_{i}").scalar() for side in ("lo", "hi"))
        at = F.floor(F.try_divide(number(x) - lo, hi - lo) * bins)
        # LEAST would pass over a NULL.
        return F.when(number(x).isNotNull(), F.when(hi == lo, F.lit(0)).otherwise(F.least(at, F.lit(bins - 1))))

    return df.select(*[bin_of(numbers.index(c), c).alias(c) if c in numbers else F.col(c) for c in df.columns])


def pair_tables(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(pair, a, b, o)``: the contingency tables of all pairs of ``cols``,
    by position; rows with a NULL on either side of a pair are left out."""
    pairs = list(itertools.combinations(range(len(cols)), 2))
    text = [F.col(c).cast("string") for c in cols]
    long = df.select(F.inline(F.array(*[F.struct(F.lit(p).alias("pair"), text[i].alias("a"), text[j].alias("b"))
                                        for p, (i, j) in enumerate(pairs)])))
    return long.where("a IS NOT NULL AND b IS NOT NULL").groupBy("pair", "a", "b").agg(F.count(F.lit(1)).alias("o"))


def pair_chi_squares(cells: DataFrame) -> DataFrame:
    """``(pair, chi2, n, ka, kb)`` from the cells that occur; the others add
    their expected counts, n less the sum of e."""
    ra = cells.groupBy("pair", "a").agg(F.sum("o").cast("double").alias("ra"))
    rb = cells.groupBy("pair", "b").agg(F.sum("o").cast("double").alias("rb"))
    n = ra.groupBy("pair").agg(F.sum("ra").alias("n"), F.count(F.lit(1)).alias("ka"))
    kb = rb.groupBy("pair").agg(F.count(F.lit(1)).alias("kb"))
    seen = cells.join(ra, ["pair", "a"]).join(rb, ["pair", "b"]).join(n, "pair").withColumn(
        "e", F.col("ra") / F.col("n") * F.col("rb"))
    gap = F.col("o").cast("double") - F.col("e")
    chi = seen.groupBy("pair").agg(F.sum(gap * gap / F.col("e")).alias("c"), F.sum("e").alias("e"))
    return chi.join(n, "pair").join(kb, "pair").select(
        "pair", (F.col("c") + F.greatest(F.col("n") - F.col("e"), F.lit(0.0))).alias("chi2"), "n", "ka", "kb")


def phi_matrix(df: DataFrame, cols: Sequence[str], numbers: Sequence[str], scale: int = 6) -> DataFrame:
    """``(col_a, col_b, chi2, phi)`` of every pair of ``cols``; ``numbers``
    are binned. A column with one value has no coefficient (NULL), nor has a
    table of more than ``CELLS`` cells; a pair without a row that has both is
    not there."""
    ship(df.sparkSession)
    cells = write_once(pair_tables(binned(df.select(*cols), numbers), cols))
    sums = pair_chi_squares(cells)

    def run(batches):
        for batch in batches:
            col = [c.to_pylist() for c in batch.columns]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([solve_phi(*x) for x in zip(*col[1:], strict=True)], pa.float64())],
                names=["pair", "chi2", "phi"])

    solved = sums.mapInArrow(run, "pair int, chi2 double, phi double")
    pairs = list(itertools.combinations(cols, 2))
    names = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    return solved.select(names[F.col("pair")]["a"].alias("col_a"), names[F.col("pair")]["b"].alias("col_b"),
                         dec_round("chi2", 4).alias("chi2"), dec_round("phi", scale).alias("phi"))


def phi_sql(table: str, cols: Sequence[str], numbers: Sequence[str], scale: int = 6) -> str:
    """The same in one statement for a second engine: bins, tables and
    chi-squares by grouping, the normal cells by quadrature, the bisection by
    recursion. ``table`` is a query."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    points = ", ".join(f"({x!r}, {w!r})" for x, w in zip(nodes.tolist(), weights.tolist(), strict=True))

    def side(c: str) -> str:
        if c not in numbers:
            return f"CAST({c} AS VARCHAR)"
        lo, hi = (f"(SELECT CAST({f}({c}) AS DOUBLE) FROM t)" for f in ("min", "max"))
        return (f"CAST(CASE WHEN {lo} = {hi} THEN CASE WHEN {c} IS NOT NULL THEN 0 END "
                f"ELSE least(floor((CAST({c} AS DOUBLE) - {lo}) / ({hi} - {lo}) * {BINS}), {BINS - 1}) END AS VARCHAR)")

    tables = "\n  UNION ALL ".join(
        f"SELECT {p} AS pair, '{a}' AS col_a, '{b}' AS col_b, {side(a)} AS a, {side(b)} AS b, COUNT(*) AS o FROM t "
        f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL" for p, (a, b) in enumerate(itertools.combinations(cols, 2)))
    edge = lambda i, n: f"(-{REACH} + {2 * REACH} * ({i}) / {n})"
    mass = lambda i, n: (f"(SELECT SUM(w * exp(-power({edge('2 * ' + i + ' + 1 + x', '(2 * ' + n + ')')}, 2) / 2)) * {REACH} "  # noqa: E731
                         f"/ {n} / sqrt(2 * pi()) FROM nodes)")
    g = lambda i, j: (f"exp(-(power({edge(i, 'ka')}, 2) + power({edge(j, 'kb')}, 2) "  # noqa: E731
                      f"- 2 * {edge(i, 'ka')} * {edge(j, 'kb')} * sin(angle)) / (2 * power(cos(angle), 2)))")
    corner = f"{g('i + 1', 'j + 1')} - {g('i', 'j + 1')} - {g('i + 1', 'j')} + {g('i', 'j')}"

    def theory(source: str, rho: str, carry: str) -> str:
        """Chi-square per row at ``rho`` for each row of ``source``."""
        return f"""(
    SELECT pair, {carry}, SUM(gain * gain / apart) AS x2 FROM (
      SELECT pair, {carry}, i, j, apart, SUM(w * ({corner}) * asin({rho}) / (4 * pi())) AS gain
      FROM (SELECT s.*, grid.i, grid.j, grid.apart, grid.ka, grid.kb, w, (x + 1) * asin({rho}) / 2 AS angle
            FROM {source} s JOIN grid USING (pair), nodes) z
      GROUP BY pair, {carry}, i, j, apart) y GROUP BY pair, {carry})"""

    value = lambda e, n: f"CAST(ROUND(CAST(CAST(({e}) AS STRING) AS DECIMAL(38,15)), {n}) AS DOUBLE)"
    return f"""
WITH RECURSIVE t AS MATERIALIZED ({table}),
nodes(x, w) AS MATERIALIZED (VALUES {points}),
cells AS MATERIALIZED (
  {tables}),
margins AS (
  SELECT *, CAST(SUM(o) OVER (PARTITION BY pair, a) AS DOUBLE) * SUM(o) OVER (PARTITION BY pair, b)
         / SUM(o) OVER (PARTITION BY pair) AS e
  FROM cells),
sums AS MATERIALIZED (
  SELECT pair, col_a, col_b, CAST(SUM(o) AS DOUBLE) AS n, COUNT(DISTINCT a) AS ka, COUNT(DISTINCT b) AS kb,
         SUM(power(o - e, 2) / e) + greatest(SUM(o) - SUM(e), 0) AS chi2
  FROM margins GROUP BY ALL),
cases AS MATERIALIZED (
  SELECT *, n * (least(ka, kb) - 1) AS most, (ka - 1) * (kb - 1) AS noise FROM sums),
open_ AS MATERIALIZED (
  SELECT pair, ka, kb, (chi2 - noise) / (most - noise) AS part, CAST({ALMOST!r} AS DOUBLE) AS top FROM cases
  WHERE ka > 1 AND kb > 1 AND chi2 > noise AND chi2 < most),
grid AS MATERIALIZED (
  SELECT pair, ka, kb, i, j, {mass('i', 'ka')} * {mass('j', 'kb')} AS apart
  FROM (SELECT pair, ka, kb, i, unnest(range(kb)) AS j FROM (SELECT pair, ka, kb, unnest(range(ka)) AS i FROM open_) q) r),
goals AS MATERIALIZED (SELECT pair, part * x2 AS goal FROM {theory('open_', 'top', 'part, top')}),
halved AS (
  SELECT pair, goal, CAST(0 AS DOUBLE) AS low, CAST({ALMOST!r} AS DOUBLE) AS high, 0 AS round FROM goals
  UNION ALL
  SELECT pair, goal, CASE WHEN x2 < goal THEN (low + high) / 2 ELSE low END,
         CASE WHEN x2 < goal THEN high ELSE (low + high) / 2 END, round + 1
  FROM {theory('(SELECT * FROM halved WHERE round < ' + str(HALVINGS) + ')', '((low + high) / 2)', 'goal, low, high, round')})
SELECT col_a, col_b, {value('chi2', 4)} AS chi2,
       {value('CASE WHEN ka < 2 OR kb < 2 THEN NULL WHEN chi2 <= noise OR most <= noise THEN 0 WHEN chi2 >= most THEN 1 '
              'ELSE (low + high) / 2 END', scale)} AS phi
FROM cases LEFT JOIN (SELECT * FROM halved WHERE round = {HALVINGS}) h USING (pair)"""
