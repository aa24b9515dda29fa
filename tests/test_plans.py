"""Plan guards over every registered metric: no Cartesian or nested-loop
join, no single-task percentile aggregate; with tables too large to
broadcast by their estimate, what may pass a shuffle."""

import contextlib
import io
import re

import pytest

from metricforge import session
from metricforge.operators.audit import join_audit
from metricforge.plans import QUERIES, product

SMALL = "/root/testdata/sf0.001"
#: Between the written aggregates (a few KB) and the tables of sf0.001.
LARGE_TABLES = "6000"


def plan_of(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture
def threshold(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    yield lambda value: spark.conf.set(key, value)
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, threshold, name):
    df = QUERIES[name](spark, SMALL)
    plans = [plan_of(df)]
    threshold("-1")                       # planned again, as if nothing were small
    plans.append(plan_of(df.select("*")))
    for plan in plans:
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan
        assert "percentile(" not in plan.lower()


def exchanges(plan):
    """The output columns of each shuffle of a formatted plan."""
    return [m[1] for m in re.finditer(r"\n\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)]


def test_no_text_in_the_shuffles_of_clean_documents(spark, threshold):
    threshold("-1")
    plan = plan_of(QUERIES["clean_documents"](spark, SMALL))
    assert exchanges(plan) and not any(re.search(r"\b(text|t)#", x) for x in exchanges(plan))
    assert "documents.parquet" not in plan   # the scan is in the written rows' job, once


@pytest.mark.parametrize("name,fact", [("impute_group_mean", None), ("iqr_outlier_removed", None), ("box_stats", None),
                                       ("active_years", None)])
def test_rows_are_not_shuffled_on_few_keys(spark, threshold, name, fact):
    threshold(LARGE_TABLES)
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_year_reaches_the_scan_of_completeness_months(spark):
    plan = plan_of(QUERIES["completeness_months"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in plan and "Scan ExistingRDD" not in plan


def test_date_window_reaches_scan(spark):
    plan = plan_of(QUERIES["dau_purchase"](spark, SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan and "LessThan(ts,2024-01-31T00:00)" in plan
    plan = plan_of(QUERIES["monthly_avg_check"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01T00:00)" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(QUERIES["zero_share"](spark, SMALL))
    assert "ReadSchema: struct<l_discount:double>" in plan
    plan = plan_of(QUERIES["payer_share"](spark, SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan


def test_audits_deal_keys_by_the_size_of_the_tables(spark, monkeypatch):
    """Keys as many as the lines: with a fixed number of partitions, a task's
    memory grows with the input."""
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 250, raising=False)
    audits = []

    def audit(*args):
        audits.append(join_audit(*args))
        return audits[-1]

    monkeypatch.setattr(product, "join_audit", audit)
    before = spark.conf.getAll
    out = QUERIES["join_audit_ltv"](spark, SMALL)
    needed = spark.read.parquet(f"{SMALL}/lineitem.parquet").count() / 250
    assert len(audits) == 8 and needed > 2 * int(before["spark.sql.shuffle.partitions"])
    for x in audits:
        plan = plan_of(x, "simple")
        dealt = [int(n) for n in re.findall(r"hashpartitioning\(.*, (\d+)\)", plan)]
        assert "FullOuter" in plan and "NestedLoop" not in plan and dealt and min(dealt) >= needed
    # The caller's session keeps its settings, and the result is its own.
    assert spark.conf.getAll == before
    out.createOrReplaceTempView("audit_result")
    assert spark.table("audit_result").count() == 8


def test_sized_session_has_the_settings_of_the_caller(spark, monkeypatch, threshold):
    threshold("12345")
    own = session.sized_session(spark, 10 * session.ROWS_PER_PARTITION + 1)
    assert own.conf.get("spark.sql.autoBroadcastJoinThreshold") == "12345"
    assert own.conf.get("spark.sql.shuffle.partitions") == "11"
    assert session.sized_session(spark, 1).conf.get("spark.sql.shuffle.partitions") == "8"
    monkeypatch.setattr(session, "MOST_PARTITIONS", 9)
    assert session.sized_session(spark, 10 * session.ROWS_PER_PARTITION).conf.get("spark.sql.shuffle.partitions") == "9"
