"""Layouts that spare shuffles and reads, archives read in place, profiles
that add up, removal of intermediates."""

import io
import os
import zipfile

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as E
from metricforge.operators.profile import file_states, merged_profile
from metricforge.plans.talks import CARD_KEY
from metricforge.session import clean, scratch, shared_path, write_once
from metricforge.sources.layout import bucketed, lookup, sorted_copy
from metricforge.sources.tables import load
from metricforge.sources.zipped import read_zip

SMALL = "/root/testdata/sf0.001"


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_bucketed_tables_join_without_an_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(E.queries()["completeness_years_bucketed"](spark, SMALL))
        join = text[text.index("SortMergeJoin"):]
        assert "Exchange" not in join and "Exchange" in text
        plain = plan(E.queries()["completeness_years"](spark, SMALL))
        assert plain[plain.index("Join"):].count("Exchange") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    t = bucketed(spark.range(1000).withColumn("v", F.col("id") % 7), "v", 3)
    assert t.count() == 1000 and len({os.path.basename(f) for f in t.inputFiles()}) == 3


def scanned_rows(df):
    """Rows the scan of an executed plan has read."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.nodeName() == "AdaptiveSparkPlan":
        node = node.executedPlan()
    leaf = node.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookup_opens_one_row_group_of_many(spark):
    rows = spark.range(400_000).select("id", (F.xxhash64("id") % 1_000_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    path = sorted_copy(rows.repartition(4), "id", files=4, group_bytes=1 << 20, bloom=["k"])
    folder = path.replace("file:", "", 1)
    groups = [pq.ParquetFile(f"{folder}/{f}").metadata for f in os.listdir(folder) if f.endswith(".parquet")]
    spans = sorted((m.row_group(i).column(0).statistics.min, m.row_group(i).column(0).statistics.max, m.row_group(i).num_rows)
                   for m in groups for i in range(m.num_row_groups))
    assert len(spans) > 12 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    found = lookup(spark, path, "id", 123_456)
    assert [r["id"] for r in found.collect()] == [123_456]
    assert 0 < scanned_rows(found) <= max(n for _, _, n in spans)
    # The Bloom filter excludes groups for an unsorted column.
    value = rows.where("id = 77").first()["k"]
    assert 77 in [r["id"] for r in lookup(spark, path, "k", value).collect()]
    assert scanned_rows(lookup(spark, path, "k", value)) < 200_000
    assert scanned_rows(lookup(spark, path, "k", 1_000_001)) == 0
    card = E.queries()["dashboard_card_sorted"](spark, SMALL).collect()
    assert [r["o_orderkey"] for r in card] == [CARD_KEY]


def test_zipped_exports_as_pandas_reads_them(spark, tmp_path):
    parts = ['name;note;amount\na;"He said ""hi""; ok";1.5\nb;"two\nlines";\n;x;3\n', "name;note;amount\nc;é;4\n"]
    path = str(tmp_path / "export.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i, p in enumerate(parts):
            z.writestr(f"data/part{i}.csv", p)
        z.writestr("readme.txt", "not;a;table")
    df = read_zip(spark, path, "name string, note string, amount double", sep=";")
    want = pd.concat([pd.read_csv(io.StringIO(p), sep=";") for p in parts])
    clean_ = lambda rows: sorted(str([None if x is None or x != x else x for x in r]) for r in rows)
    assert clean_(map(list, df.collect())) == clean_(want.values.tolist())
    assert df.rdd.getNumPartitions() == 2
    assert df.agg(F.sum("amount")).first()[0] == 8.5
    empty = str(tmp_path / "empty.zip")
    zipfile.ZipFile(empty, "w").close()
    assert read_zip(spark, empty, "name string", sep=";").count() == 0


def test_profile_after_an_append_equals_the_whole(spark, tmp_path):
    path, r = str(tmp_path / "t"), np.random.default_rng(4)
    t = pd.DataFrame({"a": r.normal(1e9, 1, 9000), "b": r.integers(0, 300, 9000).astype(float)})
    t.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(t.astype(object).where(t.notna(), None), "a double, b double").withColumn("none", F.lit(None).cast("double"))
    cols = ["a", "b", "none"]
    df.where("b < 100").repartition(2).write.parquet(path)
    first = write_once(file_states(spark.read.parquet(path), cols))
    df.where("b >= 100 or b is null").repartition(3).write.mode("append").parquet(path)
    new = write_once(file_states(spark.read.parquet(path), cols, known=first))
    assert first.select("file").distinct().count() == 2 and new.select("file").distinct().count() == 3
    out = {x["column_name"]: x for x in merged_profile(first.unionByName(new)).collect()}
    whole = {x["column_name"]: x for x in merged_profile(file_states(spark.read.parquet(path), cols)).collect()}
    assert {c: [out[c][k] for k in ("n_rows", "n", "missing", "low", "high")] for c in cols} == {
        c: [whole[c][k] for k in ("n_rows", "n", "missing", "low", "high")] for c in cols}
    for c in ("a", "b"):
        x = t[c].dropna()
        assert (out[c]["n_rows"], out[c]["n"], out[c]["missing"]) == (9000, len(x), 9000 - len(x))
        assert abs(out[c]["mean"] / x.mean() - 1) < 1e-12 and abs(out[c]["sd"] / x.std() - 1) < 1e-6
        assert abs(out[c]["distinct_about"] / x.nunique() - 1) < 0.05
        assert abs((x < out[c]["median_about"]).mean() - 0.5) < 0.02
    assert tuple(out["none"])[1:6] == (9000, 0, 9000, None, None)


def test_intermediates_can_be_removed(spark):
    kept = write_once(spark.range(10))
    folder = scratch(spark)[-1]
    other = shared_path(spark, "other")
    spark.range(3).write.parquet(other)
    local = [p.replace("file:", "", 1) for p in (folder, other)]
    assert kept.count() == 10 and all(os.path.isdir(p) for p in local)
    clean(spark, [other])
    assert os.path.isdir(local[0]) and not os.path.isdir(local[1]) and other not in scratch(spark)
    clean(spark, [folder])
    assert not os.path.isdir(local[0]) and folder not in scratch(spark)
