"""The same metrics written as Spark SQL over registered views give the
DataFrame results (several SQL twins are plain ANSI SQL that Spark runs
as is: FILTER clauses, WITHIN GROUP percentiles, window totals, ROLLUP)."""

import pytest

import __spark_entry__ as E
from check_oracle import digest
from metricforge.sources.tables import register_views

SMALL = "/root/testdata/sf0.001"
PORTABLE = ["dau_purchase", "conversion_daily", "share_pct", "payer_share_by_group", "zero_share",
            "rollup_country_conf", "mean_by_group", "dup_full", "drop_dups", "top7_groups"]


@pytest.mark.parametrize("name", PORTABLE)
def test_sql_text_runs_on_spark(spark, name):
    register_views(spark, SMALL)
    sql_df = spark.sql(E.oracle_sql()[name])
    df = E.queries()[name](spark, SMALL)
    a, b = [tuple(r) for r in sql_df.collect()], [tuple(r) for r in df.collect()]
    assert sorted(sql_df.columns) == sorted(df.columns)
    assert digest(sql_df.columns, a, 6)[0] == digest(df.columns, b, 6)[0]
