"""Answers worked out by hand or by pandas (not by the SQL twins), on small
altered copies of sf0.001 with what the driver tables lack: NULL texts, an
unlisted segment, a conference without talks, rates of three decimals,
missing items, several first dates of one user."""

import datetime as dt
import os
import tempfile

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from metricforge.functions.numeric import dec_round, money, rate
from metricforge.operators.aggregates import duplicate_rows, wide_totals, with_share
from metricforge.operators.audit import lost_by_key
from metricforge.operators.retention import retention
from metricforge.operators.stats import category_codes, chi_square
from metricforge.plans.common import R
from metricforge.plans.product import supplier_ltv
from metricforge.sources.files import BAD_RECORD, read_csv

SMALL = "/root/testdata/sf0.001"


def altered(**tables):
    """A folder with every table of sf0.001; ``tables`` maps a name to SQL
    over ``t``."""
    d = tempfile.mkdtemp(prefix="mf-altered-")
    for f in os.listdir(SMALL):
        name = f.split(".")[0]
        if name in tables:
            duckdb.sql(tables[name].replace(" t ", f" '{SMALL}/{f}' t ")).write_parquet(f"{d}/{f}")
        else:
            os.symlink(f"{SMALL}/{f}", f"{d}/{f}")
    return d


def pandas_of(d, name):
    return duckdb.sql(f"SELECT * FROM '{d}/{name}.parquet'").df()


@pytest.fixture(scope="module")
def null_texts():
    return altered(documents="SELECT * REPLACE (CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS text) FROM t ")


def norm(t):
    return None if t is None or pd.isna(t) else t.lower().strip().replace("  ", " ")


def test_clean_documents_keeps_null_texts(spark, null_texts):
    out = E.queries()["clean_documents"](spark, null_texts).toPandas().set_index("doc_id")
    docs = pandas_of(null_texts, "documents").merge(pandas_of(null_texts, "labels"), on="doc_id", how="left")
    assert len(out) == len(docs) == 200
    dup = docs.set_index("doc_id")["text"].map(norm).duplicated(keep=False)
    assert out["is_duplicate"].to_dict() == dup.to_dict()


def test_dup_rows_lists_null_texts(spark, null_texts):
    out = {r["doc_id"]: r["group_size"] for r in E.queries()["dup_rows"](spark, null_texts).collect()}
    docs = pandas_of(null_texts, "documents").set_index("doc_id")["text"].map(norm)
    assert set(out) == set(docs[docs.duplicated(keep=False)].index)
    nulls = docs[docs.isna()].index
    assert all(out[i] == len(nulls) for i in nulls)


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)], "k string, v int")
    assert sorted(r["v"] for r in duplicate_rows(df, ["k"]).collect()) == [1, 2, 3, 4]
    share = {r["v"]: r["s"] for r in with_share(df, "v", "s", partition=["k"]).collect()}
    assert share == {1: 33.33, 2: 66.67, 3: 42.86, 4: 57.14, 5: 100.0}


def test_pivot_shows_every_segment(spark):
    d = altered(customer="SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 'SIXTH' ELSE c_mktsegment END AS c_mktsegment) FROM t ")
    out = E.queries()["pivot_year_group"](spark, d).toPandas()
    orders = pandas_of(d, "orders").merge(pandas_of(d, "customer"), left_on="o_custkey", right_on="c_custkey")
    want = orders[orders["c_mktsegment"] != "HOUSEHOLD"]
    assert "SIXTH" in set(out["segment"])
    assert abs(out["total"].sum() - want["o_totalprice"].sum()) < 0.5
    table = want.pivot_table(index=want["o_orderdate"].dt.year, columns="c_mktsegment", values="o_totalprice", aggfunc="sum")
    for r in out.itertuples():
        assert abs(table.loc[r.year, r.segment] - r.total) < 0.02


def test_growing_mass_markets(spark):
    d = altered(part="SELECT * REPLACE (concat('market ', CASE WHEN p_partkey <= 10 THEN 9 ELSE p_partkey % 4 END) AS p_name) FROM t ")
    out = E.queries()["mass_market_growing"](spark, d).toPandas().set_index("market")
    x = pandas_of(d, "lineitem").merge(pandas_of(d, "orders"), left_on="l_orderkey", right_on="o_orderkey").merge(
        pandas_of(d, "part"), left_on="l_partkey", right_on="p_partkey")
    x = x[x["p_name"] != "market 9"]        # ten parts: a niche market
    sums = x.groupby(["p_name", x["o_orderdate"].dt.year])["l_extendedprice"].sum().unstack()
    want = sums[sums[1998] > sums[1997]]
    fall = sums[sums[1998] <= sums[1997]]
    assert set(out.index) == set(want.index) and len(want) and len(fall)
    assert abs(out["total_before"] - want[1997]).max() < 0.011 and abs(out["total_after"] - want[1998]).max() < 0.011


def test_counters_have_conferences_without_talks(spark):
    d = altered(customer="SELECT * FROM t WHERE c_nationkey <> 3")
    assert E.queries()["dashboard_counters"](spark, d).first()["n_conferences"] == 25


def test_item_popularity_counts_buyers_of_missing_items(spark):
    d = altered(part="SELECT * FROM t WHERE p_partkey % 2 = 0")
    out = E.queries()["item_popularity"](spark, d).toPandas().set_index("item")
    sales = pandas_of(d, "lineitem").query("l_discount > 0").merge(
        pandas_of(d, "orders"), left_on="l_orderkey", right_on="o_orderkey")
    named = sales.merge(pandas_of(d, "part"), left_on="l_partkey", right_on="p_partkey")
    for item, g in named.groupby("p_name"):
        assert out.loc[item, "sales"] == len(g)
        assert abs(out.loc[item, "buyers_part"] - g["o_custkey"].nunique() / sales["o_custkey"].nunique()) <= 0.00501


def test_one_rounding_of_unrounded_rates(spark):
    df = spark.createDataFrame([(100.0, 0.125, 0.0049999996)], "price double, r double, x double")
    r = df.select((money("price") * rate("r")).cast("double"), dec_round("x", 2), dec_round(F.lit(2.675), 2),
                  dec_round(F.lit(123456.785), 2)).first()
    assert tuple(r) == (12.5, 0.0, 2.68, 123456.79)
    twin = duckdb.sql(f"SELECT {R('0.0049999996::DOUBLE')}, {R('2.675::DOUBLE')}, {R('123456.785::DOUBLE')}, {R('1e-7::DOUBLE', 6)}")
    assert twin.fetchall() == [(0.0, 2.68, 123456.79, 0.0)]
    wide = wide_totals(spark.createDataFrame([(0.125,), (0.125,)], "a double"), ["a"], scale=3).first()
    assert wide["value"] == 0.25


def test_check_with_rates_of_three_decimals(spark):
    d = altered(lineitem="SELECT * REPLACE (0.125 AS l_discount, 100.0 AS l_extendedprice) FROM t ")
    out = E.queries()["monthly_avg_check"](spark, d).toPandas()
    geo = pandas_of(d, "nation").merge(pandas_of(d, "region"), left_on="n_regionkey", right_on="r_regionkey")
    people = pandas_of(d, "customer").merge(geo[geo["r_name"] == "EUROPE"], left_on="c_nationkey", right_on="n_nationkey")
    lines = pandas_of(d, "lineitem").merge(pandas_of(d, "orders"), left_on="l_orderkey", right_on="o_orderkey")
    lines = lines[lines["o_custkey"].isin(people["c_custkey"])
                  & lines["o_orderdate"].between("1995-01-01", "2001-12-31 23:59:59")]
    assert abs(out["commission_sum"].sum() - 12.5 * len(lines)) < 1e-6
    assert out["orders_count"].sum() == lines["l_orderkey"].nunique()


def region_lines(d):
    """Lines of the LTV window and region with their commission, by pandas."""
    s = {n: pandas_of(d, n) for n in ("lineitem", "orders", "customer", "nation", "region")}
    x = s["lineitem"].merge(s["orders"], left_on="l_orderkey", right_on="o_orderkey").merge(
        s["customer"], left_on="o_custkey", right_on="c_custkey").merge(
        s["nation"], left_on="c_nationkey", right_on="n_nationkey").merge(
        s["region"], left_on="n_regionkey", right_on="r_regionkey")
    x = x[(x["r_name"] == "EUROPE") & x["o_orderdate"].between("1995-01-01", "2001-12-31 23:59:59")]
    return x.assign(commission=x["l_extendedprice"].round(2) * x["l_discount"])


def test_ltv_counts_every_line(spark):
    x = region_lines(SMALL)
    out = supplier_ltv(spark, SMALL, "EUROPE").toPandas()
    assert abs(out["ltv"].sum() - x["commission"].sum()) < 0.01 * len(out)
    want = x.groupby("l_suppkey")["commission"].sum().nlargest(3)
    top = E.queries()["ltv_top3"](spark, SMALL).toPandas()
    assert top["s_suppkey"].tolist() == want.index.tolist()
    assert all(abs(a - b) < 0.011 for a, b in zip(top["ltv"], want, strict=True))
    names = pandas_of(SMALL, "supplier").set_index("s_suppkey")["s_name"]
    dishes = x[x["l_suppkey"].isin(want.index[:2])].merge(pandas_of(SMALL, "part"), left_on="l_partkey", right_on="p_partkey")
    keys = ["s_name", "p_name", "p_brand", "p_type", "p_size"]
    best = dishes.assign(s_name=dishes["l_suppkey"].map(names)).groupby(keys)["commission"].sum().nlargest(5)
    five = E.queries()["ltv_nested_top5"](spark, SMALL).toPandas()
    assert [tuple(r) for r in five[keys].values] == best.index.tolist()
    assert all(abs(a - b) < 0.011 for a, b in zip(five["ltv"], best, strict=True))


def test_join_audit_shows_what_is_lost(spark):
    whole = E.queries()["join_audit_ltv"](spark, SMALL).toPandas()
    assert (whole[["lost_rows", "lost_amount", "extra_rows"]] == 0).all().all()
    d = altered(part="SELECT * FROM t WHERE p_partkey % 3 <> 0", region="SELECT * FROM t UNION ALL SELECT * FROM t WHERE r_regionkey = 3",
                customer="SELECT * REPLACE (CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey) FROM t ")
    out = E.queries()["join_audit_ltv"](spark, d).toPandas().set_index("join_name")
    lines = pandas_of(d, "lineitem").merge(pandas_of(d, "orders"), left_on="l_orderkey", right_on="o_orderkey")
    homeless = lines[lines["o_custkey"] % 5 == 0]
    row = out.loc["customers to nations"]
    assert row["lost_rows"] == len(homeless) and row["left_rows"] == len(lines)
    assert abs(row["lost_amount"] - (homeless["l_extendedprice"].round(2) * homeless["l_discount"]).sum()) < 0.01
    x = region_lines(SMALL)
    x = x[x["o_custkey"] % 5 != 0]
    row = out.loc["menus to parts"]
    assert row["lost_rows"] == (x["l_partkey"] % 3 == 0).sum()
    assert abs(row["lost_amount"] - x.loc[x["l_partkey"] % 3 == 0, "commission"].sum()) < 0.01
    settled = lines[lines["o_custkey"] % 5 != 0].merge(pandas_of(d, "customer"), left_on="o_custkey", right_on="c_custkey").merge(
        pandas_of(d, "nation"), left_on="c_nationkey", right_on="n_nationkey")
    assert out.loc["nations to regions", "extra_rows"] == (settled["n_regionkey"] == 3).sum()
    keys = lost_by_key(spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 5.0), (None, 7.0)], "k int, v double"),
                       spark.createDataFrame([(2,), (3,)], "j int"), [("k", "j")], amount="v").collect()
    assert sorted((str(r["k"]), r["lost_rows"], r["lost_amount"]) for r in keys) == [("1", 2, 5.0), ("None", 1, 7.0)]


def test_retention_of_a_user_with_two_first_dates(spark):
    day = lambda n: dt.date(2024, 1, n)
    new = spark.createDataFrame([(1, day(1)), (1, day(3)), (2, day(1)), (2, day(1))], "user_id long, first_date date")
    seen = spark.createDataFrame([(1, day(1)), (1, day(3)), (1, day(4)), (2, day(1)), (2, day(4)), (3, day(4))],
                                 "user_id long, log_date date")
    out = {r["day_no"]: (r["users"], r["share"]) for r in retention(new, seen, 7).collect()}
    # User 1 counts from both dates: offsets 0, 2, 3 and 0, 1; user 2: 0, 3.
    assert out == {0: (2, 1.0), 1: (1, 0.5), 2: (1, 0.5), 3: (2, 1.0)}


def test_cohorts_have_their_own_running_maximum(spark):
    day = lambda m, n: dt.date(2024, m, n)
    new = spark.createDataFrame([(1, day(1, 30)), (1, day(2, 2)), (2, day(1, 30)), (3, day(2, 5))],
                                "user_id long, first_date date")
    seen = spark.createDataFrame([(1, day(1, 30)), (1, day(2, 2)), (2, day(1, 30)), (2, day(1, 31)), (3, day(2, 6)),
                                  (1, day(2, 3))], "user_id long, log_date date")
    out = {(r["cohort"], r["day_no"]): (r["users"], r["share"]) for r in retention(new, seen, 7, cohort=True).collect()}
    jan, feb = day(1, 1), day(2, 1)
    # January starts with two users; February's user 1 is there at once, user 3 after a day.
    assert out == {(jan, 0): (2, 1.0), (jan, 1): (1, 0.5), (jan, 3): (1, 0.5), (jan, 4): (1, 0.5),
                   (feb, 0): (1, 1.0), (feb, 1): (2, 1.0)}


def test_chi_square_of_very_large_counts(spark):
    big = 4_000_000_000
    cells = spark.createDataFrame([("a", "x", big), ("a", "y", big // 2), ("b", "x", big // 2), ("b", "y", big)],
                                  "p string, q string, o long")
    r = chi_square(cells, "p", "q").first()
    n, e = 3 * big, 1.5 * big / 2
    want = 2 * (big - e) ** 2 / e + 2 * (big / 2 - e) ** 2 / e
    assert abs(r["chi2"] / want - 1) < 1e-12 and (r["n"], r["ka"], r["kb"]) == (n, 2, 2)
    sparse = spark.createDataFrame([("a", "x", big), ("b", "y", big), ("c", "z", 7)], "p string, q string, o long")
    assert abs(chi_square(sparse, "p", "q").first()["chi2"] / (2 * (2 * big + 7)) - 1) < 1e-9


def test_category_codes_of_many_values(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 9 != 0, F.md5(F.col("id").cast("string"))).alias("v"))
    out = category_codes(df.unionByName(df.limit(100)), "v", "code").toPandas()
    want = pd.Categorical(out["v"]).codes
    assert out["code"].tolist() == want.tolist()


ROWS = 'name;note;amount\na;"He said ""hi"", ok";1\nb;"two\nlines; quoted";2\n"c;d";;3\n'


@pytest.mark.parametrize("sep", [",", ";"])
def test_csv_as_pandas_reads_it(spark, sep):
    d = tempfile.mkdtemp(prefix="mf-csv-")
    for k in range(2):
        with open(f"{d}/part-{k}.csv", "w") as f:
            f.write(ROWS.replace(";", sep) if sep == "," else ROWS)
    want = pd.concat([pd.read_csv(f"{d}/part-{k}.csv", sep=sep) for k in range(2)])
    got = read_csv(spark, d, "name string, note string, amount int", sep=sep).toPandas()
    key = lambda df: sorted((n, None if pd.isna(x) else x, int(a)) for n, x, a in df.itertuples(index=False))
    assert [str(x) for x in key(got)] == [str(x) for x in key(want)]


def test_csv_reports_malformed_records(spark):
    d = tempfile.mkdtemp(prefix="mf-csv-")
    with open(f"{d}/x.csv", "w") as f:
        f.write("a,b\n1,2\nx,3\n4,5\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_csv(spark, d, "a int, b int").collect()
    rows = read_csv(spark, d, "a int, b int", malformed="PERMISSIVE").collect()
    assert [r[BAD_RECORD] for r in rows] == [None, "x,3", None] and len(rows) == 3
