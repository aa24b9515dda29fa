"""Property checks on the metric catalogue (small scale factor)."""

from pyspark.sql import functions as F

from metricforge.plans import QUERIES


def test_shares_sum_to_100(spark, small_dir):
    pct = [r["pct"] for r in QUERIES["share_pct"](spark, small_dir).collect()]
    assert abs(sum(pct) - 100.0) <= 0.01 * len(pct)
    terms = QUERIES["term_groups"](spark, small_dir).collect()
    assert abs(sum(r["company_pct"] for r in terms) - 100.0) <= 0.03


def test_retention_at_most_one(spark, small_dir):
    for name in ("retention_daily", "retention_cohort_month", "retention_cohort_month_offset"):
        rates = [r["share"] for r in QUERIES[name](spark, small_dir).collect()]
        assert rates and all(0 <= x <= 1 for x in rates)


def test_semi_join_never_grows(spark, small_dir):
    n = QUERIES["semi_in_subquery"](spark, small_dir).count()
    total = spark.read.parquet(f"{small_dir}/orders.parquet").count()
    assert n <= total


def test_buckets_partition_rows(spark, small_dir):
    closed = QUERIES["bucket_left_closed"](spark, small_dir).collect()
    p = spark.read.parquet(f"{small_dir}/part.parquet").where(F.col("p_retailprice").between(920, 990))
    assert sum(r["n"] for r in closed) == p.where(F.col("p_size").isNotNull()).count()


def test_loss_report_balances(spark, small_dir):
    r = QUERIES["loss_report"](spark, small_dir).collect()[0]
    assert r["rows_before"] == r["rows_after"] + r["removed_rows"]


def test_topk_rank_one_is_max(spark, small_dir):
    top = QUERIES["ltv_top3"](spark, small_dir).collect()
    assert [r["ltv"] for r in top] == sorted([r["ltv"] for r in top], reverse=True)


def test_histogram_counts_all_rows(spark, small_dir):
    h = QUERIES["histogram_50"](spark, small_dir).collect()
    n = spark.read.parquet(f"{small_dir}/lineitem.parquet").count()
    assert len(h) == 50 and sum(r["n"] for r in h) == n
