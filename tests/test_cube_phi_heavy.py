"""Distinct counts from bitmaps, phi_K, top values and losses by step, against
plain versions."""

import itertools
import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from metricforge.operators import heavy
from metricforge.operators.distinct_cube import build_cube, count_cube, numbered, roll_up
from metricforge.operators.heavy import top_values
from metricforge.operators.phi import Theory, binned, pair_chi_squares, pair_tables, phi_matrix, solve_phi
from metricforge.operators.steps import Steps

SMALL = "/root/testdata/sf0.001"


def facts(spark, n=4000):
    r = np.random.default_rng(1)
    rows = [(f"c{k % 3}", f"c{k % 3}.{k % 7}" if k % 11 else None, f"t{int(r.integers(0, 4))}", int(m), int(k))
            for k, m in zip((r.integers(0, 90_000, n) ** 2 % 90_000).tolist(), r.integers(1, 13, n).tolist())]
    return rows, spark.createDataFrame(rows, "country string, conf string, tag string, month int, who long")


def test_cube_counts_distinct_members_of_any_selection(spark):
    rows, df = facts(spark)
    no = numbered(df.select("country", "conf", "who").distinct(), ["country", "conf", "who"])
    assert sorted(r["member_no"] for r in no.collect()) == list(range(no.count()))
    dims = ["country", "conf", "tag", "month"]
    cube = build_cube(df.join(no.select("who", "member_no"), "who"), dims, "member_no", {"n": F.lit(1)})
    t = pd.DataFrame(rows, columns=[*dims, "who"])
    for where, keep in ((F.col("tag") == "t1", t.tag == "t1"),
                        (F.col("month").between(3, 5) & (F.col("country") != "c0"), t.month.between(3, 5) & (t.country != "c0")),
                        (F.col("month") > 99, t.month > 99)):
        for by in ([], ["country"], ["tag", "month"]):
            got = {tuple(r[:len(by)]): (r["members"], r["n"]) for r in count_cube(cube, by, ["n"], where=where).collect()}
            if by:
                want = {k if isinstance(k, tuple) else (k,): (g.who.nunique(), len(g)) for k, g in t[keep].groupby(by)}
            else:
                want = {(): (t[keep].who.nunique(), len(t[keep]) or None)}
            assert got == want
    levels = [[], ["country"], ["country", "conf"], ["tag"], ["conf", "month"]]
    got = {(*r[:4], r["gid"]): (r["members"], r["n"]) for r in roll_up(cube, dims, levels, ["n"]).collect()}
    want = {}
    for level in levels:
        gid = sum(8 >> i for i, x in enumerate(dims) if x not in level)
        for k, g in (t.groupby(level, dropna=False) if level else [((), t)]):
            k = dict(zip(level, (None if pd.isna(x) else x for x in (k if isinstance(k, tuple) else (k,)))))
            want[*(k.get(x) for x in dims), gid] = (g.who.nunique(), len(g))
    assert got == want


def plain_phi(chi2, n, r, k):
    """By densities on a fine grid instead of an integral over the angle."""
    most, noise = n * (min(r, k) - 1), (r - 1) * (k - 1)
    if chi2 <= noise or most <= noise:
        return 0.0
    fine = 1200
    x = np.linspace(-5, 5, fine * r + 1)
    phi = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in np.linspace(-5, 5, k + 1)])
    edges = np.linspace(-5, 5, k + 1)

    def theory(rho):
        # Given x, the other is normal around rho x: its bins by erfc, x by Simpson's rule.
        z = (edges[None, :] - rho * x[:, None]) / math.sqrt(1 - rho * rho)
        up = np.vectorize(lambda v: 0.5 * math.erfc(-v / math.sqrt(2)))(np.clip(z, -40, 40))
        f = np.diff(up, axis=1) * (np.exp(-x * x / 2) / math.sqrt(2 * math.pi))[:, None]
        h, out = x[1] - x[0], []
        for i in range(r):
            part = f[i * fine:(i + 1) * fine + 1]
            out.append(h / 3 * (part[0] + part[-1] + 4 * part[1:-1:2].sum(axis=0) + 2 * part[2:-1:2].sum(axis=0)))
        px = np.diff([0.5 * math.erfc(-v / math.sqrt(2)) for v in np.linspace(-5, 5, r + 1)])
        apart = np.outer(px, np.diff(phi))
        return ((np.array(out) - apart) ** 2 / apart).sum()

    top = min(r, k) - 1     # the theory's chi-square at full correlation, by its limit
    low, high = 0.0, 0.999
    goal = (chi2 - noise) / (most - noise) * Theory(r, k).chi_square(1 - 1e-9)
    assert r != k or abs(Theory(r, k).chi_square(1 - 1e-9) / top - 1) < 0.02
    for _ in range(24):
        mid = (low + high) / 2
        low, high = (mid, high) if theory(mid) < goal else (low, mid)
    return (low + high) / 2


@pytest.mark.parametrize("chi2,n,r,k", [(60.0, 500.0, 3, 4), (400.0, 900.0, 5, 5), (30.0, 2000.0, 2, 2), (900.0, 1000.0, 4, 3)])
def test_phi_solver(chi2, n, r, k):
    assert abs(solve_phi(chi2, n, r, k) - plain_phi(chi2, n, r, k)) < 1e-6


def test_phi_solver_limits():
    assert solve_phi(5, 10, 1, 4) is None and solve_phi(5, 10, 2000, 2000) is None
    assert solve_phi(11.9, 100, 4, 5) == 0.0 and solve_phi(300.0, 100, 4, 5) == 1.0
    values = [solve_phi(x, 1000, 4, 4) for x in (10, 30, 100, 500, 2000, 2900)]
    assert values == sorted(values) and 0 < values[0] < values[-1] < 1


def test_phi_of_columns(spark):
    r = np.random.default_rng(2)
    n = 1500
    x = r.normal(size=n)
    t = pd.DataFrame({"x": x, "y": x * 0.8 + r.normal(size=n) * 0.6, "kind": np.where(x > 0.5, "b", "a"),
                      "noise": r.integers(0, 6, n).astype(str), "same": "k", "copy": np.floor(x).astype(int).astype(str)})
    t.loc[::7, "kind"] = None
    t.loc[::5, "y"] = np.nan
    df = spark.createDataFrame(t.astype(object).where(t.notna(), None), "x double, y double, kind string, noise string, same string, copy string")
    cols, numbers = list(t.columns), ["x", "y"]
    got = {(r["col_a"], r["col_b"]): (r["chi2"], r["phi"]) for r in phi_matrix(df, cols, numbers).collect()}
    for c in numbers:
        low, high = t[c].min(), t[c].max()
        t[c] = np.minimum(np.floor((t[c] - low) / (high - low) * 10), 9)
    assert len(got) == 15
    for a, b in itertools.combinations(cols, 2):
        both = t[[a, b]].dropna()
        o = pd.crosstab(both[a], both[b]).to_numpy(float)
        e = np.outer(o.sum(1), o.sum(0)) / o.sum()
        chi2, phi = got[a, b]
        assert abs(chi2 - ((o - e) ** 2 / e).sum()) < 1e-3
        want = solve_phi(((o - e) ** 2 / e).sum(), o.sum(), *o.shape)
        assert (phi is None and want is None) if "same" in (a, b) else abs(phi - want) < 1e-5
    assert got["x", "kind"][1] > 0.9 > got["x", "y"][1] > 0.6 and got["x", "noise"][1] < 0.3
    none = df.where("false")
    assert phi_matrix(none, cols, numbers).count() == 0
    assert binned(df.select("x"), ["x"]).agg(F.min("x"), F.max("x")).first()[:] == (0, 9)
    assert pair_chi_squares(pair_tables(none, cols)).count() == 0


@pytest.mark.parametrize("shape", ["skewed", "uniform", "ties", "few"])
def test_top_values(spark, shape, monkeypatch):
    monkeypatch.setattr(heavy, "LEAD", 2)
    r = np.random.default_rng(6)
    values = {"skewed": (r.zipf(1.3, 30_000) % 20_000).tolist(), "uniform": r.integers(0, 3000, 30_000).tolist(),
              "ties": [i % 500 for i in range(5000)], "few": [3, 3, 1]}[shape]
    df = spark.createDataFrame([(f"v{x:05d}",) for x in values] + [(None,)] * 50, "v string").repartition(4)
    want = sorted(Counter(f"v{x:05d}" for x in values).items(), key=lambda x: (-x[1], x[0]))[:10]
    for width in (64, 1 << 12):
        assert [tuple(x) for x in top_values(df, "v", 10, width=width).collect()] == want
    assert top_values(df.where("false"), "v", 10).count() == 0


def test_skewed_values_are_counted_in_few_buckets(spark, monkeypatch):
    seen = []
    true = heavy.write_once
    monkeypatch.setattr(heavy, "write_once", lambda df: (seen.append(true(df)), seen[-1])[1])
    df = spark.range(60_000).selectExpr("case when id % 3 = 0 then id % 12 else id end AS v")
    assert [r["n"] for r in top_values(df, "v", 4).collect()] == [5000] * 4
    counted = [x.count() for x in seen if "v" in x.columns]
    assert sum(counted) < 200       # of 40,004 values


def test_losses_by_step(spark):
    from metricforge.plans.games import games
    t = games(spark, SMALL).toPandas()
    out = E.queries()["loss_by_step"](spark, SMALL).toPandas()
    a = t[t["genre"].notna()]
    b = a[a["year_of_release"].notna()]
    cleaned = E.queries()["clean_lines"](spark, SMALL).count()
    assert out["rows_in"].tolist() == [len(t), len(a), len(b)] and out["rows_out"].tolist() == [len(a), len(b), cleaned]
    whole = E.queries()["loss_report"](spark, SMALL).first()
    assert whole["removed_rows"] == (out["rows_in"] - out["rows_out"]).sum()


def test_steps_are_counted_anew_if_the_observed_figures_are_off(spark):
    steps = Steps()
    df = steps(spark.range(100).toDF("id"), "source")
    df = steps(df.where("id % 2 = 0"), "even")
    steps.run(df, source_rows=101)          # as if Spark had repeated a task
    assert steps.counts == [100, 50]
    assert [tuple(r)[:4] for r in steps.report().collect()] == [(1, "even", 100, 50)]
