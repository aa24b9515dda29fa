"""The distributed exact quantiles equal Spark's built-in exact percentile
(continuous and discrete) on random grouped data with ties, NULLs, a hot
group and a group without values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from metricforge.operators import percentiles
from metricforge.operators.percentiles import Limit, quantiles, quantiles_long, trim_percentile

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def _data(spark, seed):
    rnd = random.Random(seed)
    rows = [("empty", None)]
    for g, n in (("one", 1), ("two", 2), ("small", 37), ("hot", 3000)):
        for _ in range(n):
            rows.append((g, rnd.choice([None, float(rnd.randint(0, 20)), rnd.random() * 100, 7.0])))
    rows.append((None, 5.0))
    rows.append((None, 9.0))
    return spark.createDataFrame(rows, "k string, v double")


@pytest.fixture(params=["by_value", "coalesced", "many_blocks"])
def layout(spark, request, monkeypatch):
    """``by_value``: as columns of few values are counted; else as those of
    many. ``many_blocks``: AQE coalescing off and 23 range partitions, so
    groups span many blocks and the two ranks of an interpolation can sit
    in different blocks (offsets and block selection are exercised)."""
    if request.param != "by_value":
        monkeypatch.setattr(percentiles, "FEW", 0)
    if request.param == "many_blocks":
        monkeypatch.setattr(percentiles, "GROUP_ROWS", 0)
    if request.param == "many_blocks":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        yield request.param
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    else:
        yield request.param


@pytest.mark.parametrize("kind", ["cont", "disc"])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_builtin(spark, layout, kind, seed):
    df = _data(spark, seed)
    fn = "percentile_cont" if kind == "cont" else "percentile_disc"
    exprs = [F.expr(f"{fn}({p}) WITHIN GROUP (ORDER BY v)").alias(f"q{i}") for i, p in enumerate(PROBS)]
    ref = {r["k"]: [r[f"q{i}"] for i in range(len(PROBS))] for r in df.groupBy("k").agg(*exprs).collect()}
    got = {r["k"]: [r[f"q{i}"] for i in range(len(PROBS))] for r in quantiles(df, "v", PROBS, ["k"], kind).collect()}
    for k, want in ref.items():
        have = got.get(k, [None] * len(PROBS))
        for a, b in zip(have, want):
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12), (k, have, want)


def test_long_form_several_columns(spark):
    df = _data(spark, 3).withColumn("w", F.col("v") * 2)
    q = {(r["__m"]): r["q0"] for r in quantiles_long(df, ["v", "w"], [0.5]).collect()}
    ref = df.agg(F.expr("percentile_cont(0.5) WITHIN GROUP (ORDER BY v)").alias("a"),
                 F.expr("percentile_cont(0.5) WITHIN GROUP (ORDER BY w)").alias("b")).collect()[0]
    assert math.isclose(q["v"], ref["a"]) and math.isclose(q["w"], ref["b"])


def test_trim_keeps_nulls_and_is_strict(spark):
    df = spark.createDataFrame([(float(i), None if i % 10 == 0 else float(i)) for i in range(1, 101)], "a double, b double")
    rules = [Limit("a", 0.99, "cont", keep_null=False, name="a_lim"), Limit("b", 0.99, "disc", name="b_lim")]
    kept = trim_percentile(df, rules)
    # a: p99 cont of 1..100 = 99.01 -> a < 99.01 keeps 1..99; b: disc p99 of non-null
    # values (90 of them) = 99 -> b < 99 or NULL drops 99 only.
    assert sorted(r["a"] for r in kept.collect()) == [float(i) for i in range(1, 99)]


def test_hot_group_is_split_across_partitions(spark):
    """One group holds ~90 % of the rows: its distinct values are spread over
    several range partitions, so no single task holds the whole group."""
    from metricforge.operators.percentiles import ranged_counts
    rows = [("hot", float(i)) for i in range(20000)] + [(f"g{i % 50}", float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v double")
    # At test size AQE would merge the small range partitions (it only keeps
    # partitions apart once they reach the advisory size); switch that off
    # to look at the split itself.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        r = ranged_counts(df, ["v"], ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    pids = {row["__pid"] for row in r.where(F.col("k") == "hot").select("__pid").distinct().collect()}
    assert len(pids) > 1
    # and the exact answer is unchanged
    q = quantiles(df, "v", [0.5], ["k"]).where(F.col("k") == "hot").collect()[0]["q0"]
    assert q == 9999.5


@pytest.mark.parametrize("reach", [0.01, 0.0005])
def test_brackets_and_what_misses_them(spark, monkeypatch, reach):
    """Far from exact brackets are noticed; the answer is the same."""
    from metricforge.operators import percentiles as P
    monkeypatch.setattr(P, "SKETCH_SIZE", 20)
    monkeypatch.setattr(P, "REACH", reach)
    rnd = random.Random(11)
    rows = [(g, rnd.gauss(0, 10) if rnd.random() < 0.9 else 3.0) for g in "ab" for _ in range(20_000)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r["k"]: [r[f"q{i}"] for i in range(len(PROBS))] for r in quantiles(df, "v", PROBS, ["k"]).collect()}
    for k in "ab":
        xs = sorted(v for g, v in rows if g == k)
        for p, have in zip(PROBS, got[k], strict=True):
            at = p * (len(xs) - 1)
            lo, hi = math.floor(at), math.ceil(at)
            assert math.isclose(have, xs[lo] + (at - lo) * (xs[hi] - xs[lo]), rel_tol=1e-9, abs_tol=1e-9)


def test_few_rows_are_written(spark):
    from metricforge.operators.percentiles import bracketed_counts
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"))
    counts, rows = bracketed_counts(df, ["v"], [0.5])
    assert counts.count() == rows < 8_000 and counts.agg(F.sum("__c")).first()[0] == 200_000
