"""Dirty-table cleaning and profiling (M22, M33-M35, A19-A21, A32, A33,
C6-C9, C19, F10, P13, P14, U3, W6) on the driver tables.

The driver tables have no nulls and no dirty text, so dirt is injected with
deterministic expressions (the same expressions in the oracle SQL):
missing values on key residues, ``'tbd'`` / padded numbers in a score text,
unparseable and out-of-range date strings, padded category labels.
Mapping for the games table: platform -> return flag, genre -> line status,
year -> ship year, EU sales -> discount, user score -> discount in percent
(0..10), rating -> lower-cased line status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricforge.functions.binning import bucketize
from metricforge.functions.coerce import coerce_date, coerce_numeric, midpoint
from metricforge.functions.numeric import dec_round, pct
from metricforge.functions.text import strip_unicode
from metricforge.operators.aggregates import distinct_values, null_profile, topk, value_counts
from metricforge.operators.impute import drop_null, fill_const, fill_group_mean
from metricforge.operators.profile import file_states, merged_profile
from metricforge.operators.steps import Steps
from metricforge.plans.common import PCT, R, register, tables
from metricforge.session import write_once

NULL_COLS = ["l_discount", "l_tax", "l_shipdate", "l_returnflag"]

# Fixed labels of the score categories (ASCII), lowest first.
SCORE_LABELS = ["no_rating", "low", "medium", "high"]
SIZE_LABELS = ["small", "medium", "large"]


def dirty_lines(spark: SparkSession, d: str) -> DataFrame:
    li = tables(spark, d)("lineitem")
    k = F.col("l_orderkey")
    return li.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
        F.when(F.col("l_linenumber") % 5 != 0, F.col("l_discount")).alias("l_discount"),
        F.when(k % 3 != 0, F.col("l_tax")).alias("l_tax"),
        F.when(k % 17 != 0, F.col("l_shipdate")).alias("l_shipdate"))


SQL_DIRTY = """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
       CASE WHEN l_linenumber % 5 <> 0 THEN l_discount END AS l_discount,
       CASE WHEN l_orderkey % 3 <> 0 THEN l_tax END AS l_tax,
       CASE WHEN l_orderkey % 17 <> 0 THEN l_shipdate END AS l_shipdate
FROM lineitem
"""


def _null_sql(what: str) -> str:
    parts = []
    for x in NULL_COLS:
        val = "COUNT(*) FILTER (WHERE {x} IS NULL)".format(x=x)
        if what == "n":
            parts.append(f"SELECT '{x}' AS column_name, {val} AS n_missing FROM d")
        else:
            parts.append(f"SELECT '{x}' AS column_name, {PCT(val, 'COUNT(*)')} AS pct_missing FROM d")
    return f"WITH d AS ({SQL_DIRTY})\n" + "\nUNION ALL\n".join(parts)


SPARK_TYPE_SQL = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
                  "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(typeof({c})) END")
LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("schema_profile", "\nUNION ALL\n".join(
    f"SELECT '{x}' AS column_name, (SELECT {SPARK_TYPE_SQL.format(c=x)} FROM lineitem LIMIT 1) AS data_type, "
    f"COUNT({x}) AS non_null FROM lineitem" for x in LINE_COLS))
def schema_profile(spark: SparkSession, d: str) -> DataFrame:
    """``df.info()`` - column, type and non-null count, in one pass (the
    types come from the schema, the counts from one aggregate)."""
    li = tables(spark, d)("lineitem").select(*LINE_COLS)
    one = li.agg(*[F.count(x).alias(f"n_{i}") for i, x in enumerate(LINE_COLS)])
    types = dict(li.dtypes)
    rows = [F.struct(F.lit(x).alias("column_name"), F.lit(types[x]).alias("data_type"), F.col(f"n_{i}").alias("non_null"))
            for i, x in enumerate(LINE_COLS)]
    return one.select(F.inline(F.array(*rows)))


PROFILE_COLS = ["l_discount", "l_tax"]


@register("profile_merged", "\nUNION ALL\n".join(f"""
SELECT '{x}' AS column_name, COUNT(*) AS n_rows, COUNT({x}) AS n, COUNT(*) - COUNT({x}) AS missing,
       {R(f'AVG({x})', 6)} AS mean, {R(f'STDDEV_SAMP({x})', 6)} AS sd, MIN({x}) AS low, MAX({x}) AS high
FROM ({SQL_DIRTY}) d""" for x in PROFILE_COLS))
def profile_merged(spark: SparkSession, d: str) -> DataFrame:
    """The profile of a table from the stored states of its
    files (here the exact part; the sketches are in the states)."""
    states = write_once(file_states(dirty_lines(spark, d), PROFILE_COLS))
    return merged_profile(states).select("column_name", "n_rows", "n", "missing", dec_round("mean", 6).alias("mean"),
                                         dec_round("sd", 6).alias("sd"), "low", "high")


@register("table_shape", f"""
SELECT COUNT(*) AS n_rows, {len(LINE_COLS)} AS n_columns FROM lineitem
""")
def table_shape(spark: SparkSession, d: str) -> DataFrame:
    """``df.shape``."""
    li = tables(spark, d)("lineitem")
    return li.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(li.columns)).alias("n_columns"))


@register("preview_head", """
SELECT * FROM orders ORDER BY o_orderkey LIMIT 5
""")
def preview_head(spark: SparkSession, d: str, n: int = 5) -> DataFrame:
    """``df.head()`` with an explicit order (a top-n, no full sort)."""
    return topk(tables(spark, d)("orders"), n, [F.col("o_orderkey").asc()])


@register("null_profile", _null_sql("n"))
def null_profile_q(spark: SparkSession, d: str) -> DataFrame:
    """Missing values per column, one pass, most missing first."""
    p = null_profile(dirty_lines(spark, d), NULL_COLS)
    return p.select("column_name", "n_missing").orderBy(F.desc("n_missing"), "column_name")


@register("null_share", _null_sql("pct"))
def null_share(spark: SparkSession, d: str) -> DataFrame:
    """Missing share per column in percent, rounded to 2."""
    return null_profile(dirty_lines(spark, d), NULL_COLS).select("column_name", "pct_missing")


def _score_text(score):
    """Score as text with injected dirt: 'tbd', padded, 'nan'."""
    n = F.col("l_linenumber")
    txt = score.cast("int").cast("string")
    return (F.when(n == 7, F.lit("tbd"))
             .when(n == 6, F.concat(F.lit(" "), txt, F.lit(" ")))
             .when(n == 5, F.lit("nan"))
             .otherwise(txt))


SQL_SCORE_TEXT = """CASE WHEN l_linenumber = 7 THEN 'tbd'
     WHEN l_linenumber = 6 THEN ' ' || CAST(CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS INTEGER) AS VARCHAR) || ' '
     WHEN l_linenumber = 5 THEN 'nan'
     ELSE CAST(CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS INTEGER) AS VARCHAR) END"""


def SQL_COERCE(expr: str) -> str:
    return f"(CASE WHEN isnan(TRY_CAST(trim({expr}) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim({expr}) AS DOUBLE) END)"


@register("coerce_numeric", f"""
SELECT l_orderkey, l_linenumber, {SQL_COERCE(SQL_SCORE_TEXT)} AS user_score FROM lineitem
""")
def coerce_numeric_q(spark: SparkSession, d: str) -> DataFrame:
    """``pd.to_numeric(errors='coerce')`` on a dirty score text."""
    li = tables(spark, d)("lineitem")
    score = li.l_discount.cast("decimal(18,2)") * 100
    return li.select("l_orderkey", "l_linenumber", coerce_numeric(_score_text(score)).alias("user_score"))


@register("coerce_date", """
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 11 = 0 THEN 'not a date'
              WHEN o_orderkey % 13 = 0 THEN '0020-06-14'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS s
  FROM orders)
SELECT o_orderkey,
       CASE WHEN CAST(TRY_STRPTIME(trim(s), '%Y-%m-%d') AS DATE) BETWEEN DATE '1677-09-22' AND DATE '2262-04-11'
            THEN CAST(TRY_STRPTIME(trim(s), '%Y-%m-%d') AS DATE) END AS order_date
FROM t
""")
def coerce_date_q(spark: SparkSession, d: str) -> DataFrame:
    """Date text -> date; bad text and dates outside the pandas
    range become NULL."""
    o = tables(spark, d)("orders")
    k = F.col("o_orderkey")
    s = (F.when(k % 11 == 0, F.lit("not a date")).when(k % 13 == 0, F.lit("0020-06-14"))
          .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return o.select("o_orderkey", coerce_date(s).alias("order_date"))


@register("midpoint_fill", """
WITH s AS (SELECT l_orderkey, MIN(l_shipdate) AS first_at, MAX(l_shipdate) AS last_at FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey,
       COALESCE(CASE WHEN o.o_orderkey % 3 <> 0 THEN o.o_orderdate END,
                make_timestamp(epoch_us(s.first_at) + (epoch_us(s.last_at) - epoch_us(s.first_at)) // 2)) AS mid_at
FROM orders o LEFT JOIN s ON o.o_orderkey = s.l_orderkey
""")
def midpoint_fill(spark: SparkSession, d: str) -> DataFrame:
    """Fill a missing middle date with first + (last - first) / 2 of
    the order's ship dates (per-order aggregate joined on the order key)."""
    t = tables(spark, d)
    s = t("lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_at"),
                                                F.max("l_shipdate").alias("last_at"))
    o = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")).alias("mid_at"))
    j = o.join(s, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.select("o_orderkey", F.coalesce("mid_at", midpoint("first_at", "last_at")).alias("mid_at"))


def games(spark: SparkSession, d: str) -> DataFrame:
    """The dirty games-like table (raw, before cleaning)."""
    li = tables(spark, d)("lineitem")
    k = F.col("l_orderkey")
    score = li.l_discount.cast("decimal(18,2)") * 100
    return li.select(
        F.when(k % 19 == 0, F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" "))).otherwise(F.col("l_returnflag")).alias("platform"),
        F.when(k % 23 != 0, F.upper("l_linestatus")).alias("genre"),
        F.when(k % 17 != 0, F.year("l_shipdate")).alias("year_of_release"),
        F.when(k % 5 != 0, F.col("l_discount")).alias("eu_sales"),
        _score_text(score).alias("user_score"),
        F.when(k % 4 != 0, F.lower("l_linestatus")).alias("rating"))


SQL_GAMES = f"""
SELECT CASE WHEN l_orderkey % 19 = 0 THEN ' ' || l_returnflag || ' ' ELSE l_returnflag END AS platform,
       CASE WHEN l_orderkey % 23 <> 0 THEN upper(l_linestatus) END AS genre,
       CASE WHEN l_orderkey % 17 <> 0 THEN CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) END AS year_of_release,
       CASE WHEN l_orderkey % 5 <> 0 THEN l_discount END AS eu_sales,
       {SQL_SCORE_TEXT} AS user_score,
       CASE WHEN l_orderkey % 4 <> 0 THEN lower(l_linestatus) END AS rating
FROM lineitem
"""


def clean_games(spark: SparkSession, d: str, step=lambda df, name: df) -> DataFrame:
    """M33 end to end, in the source's order of steps: coerce the score,
    drop rows missing key fields (F10), impute sales by (platform, year)
    mean (W6), fill the rating (C6), normalise text (C1, C2; H24: the fill
    value is upper-cased with the rest), drop full duplicates (U3). ``step``
    is told the rows after each step that may lose some."""
    g = step(games(spark, d), "source").withColumn("user_score", coerce_numeric("user_score"))
    g = step(drop_null(g, ["genre"]), "genre missing")
    g = step(drop_null(g, ["year_of_release"]), "year missing")
    g = fill_group_mean(g, "eu_sales", ["platform", "year_of_release"])
    g = g.withColumn("eu_sales", dec_round("eu_sales", 6))
    g = fill_const(g, {"rating": "no_rating"})
    g = (g.withColumn("genre", strip_unicode(F.lower("genre")))
          .withColumn("platform", strip_unicode("platform"))
          .withColumn("rating", F.upper(strip_unicode("rating"))))
    return step(g.dropDuplicates(), "duplicates")


SQL_CLEAN = f"""
WITH g AS (SELECT * REPLACE ({SQL_COERCE('user_score')} AS user_score) FROM ({SQL_GAMES}) x),
k AS (SELECT * FROM g WHERE genre IS NOT NULL AND year_of_release IS NOT NULL),
m AS (SELECT platform, year_of_release, AVG(eu_sales) AS mean_sales FROM k GROUP BY platform, year_of_release),
f AS (SELECT k.platform, k.genre, k.year_of_release,
             {R('COALESCE(k.eu_sales, m.mean_sales)', 6)} AS eu_sales, k.user_score,
             COALESCE(k.rating, 'no_rating') AS rating
      FROM k LEFT JOIN m ON k.platform = m.platform AND k.year_of_release = m.year_of_release)
SELECT DISTINCT trim(platform) AS platform, trim(lower(genre)) AS genre, year_of_release, eu_sales, user_score,
       upper(trim(rating)) AS rating
FROM f
"""


@register("clean_lines", SQL_CLEAN)
def clean_lines(spark: SparkSession, d: str) -> DataFrame:
    """The cleaned table."""
    return clean_games(spark, d)


@register("loss_report", f"""
SELECT (SELECT COUNT(*) FROM lineitem) AS rows_before, (SELECT COUNT(*) FROM ({SQL_CLEAN}) c) AS rows_after,
       (SELECT COUNT(*) FROM lineitem) - (SELECT COUNT(*) FROM ({SQL_CLEAN}) c) AS removed_rows,
       {PCT('(SELECT COUNT(*) FROM lineitem) - (SELECT COUNT(*) FROM (' + SQL_CLEAN + ') c)', '(SELECT COUNT(*) FROM lineitem)')} AS removed_pct
""")
def loss_report(spark: SparkSession, d: str) -> DataFrame:
    """Rows before and after cleaning, removed rows and percent - both
    counts computed, none hard-coded."""
    before = games(spark, d).agg(F.count(F.lit(1))).scalar()
    after = clean_games(spark, d).agg(F.count(F.lit(1))).scalar()
    return spark.range(1).select(
        before.alias("rows_before"), after.alias("rows_after"), (before - after).alias("removed_rows"),
        pct(before - after, before).alias("removed_pct"))


@register("loss_by_step", f"""
WITH g AS ({SQL_GAMES}),
counts AS (
  SELECT COUNT(*) AS n0, COUNT(*) FILTER (WHERE genre IS NOT NULL) AS n1,
         COUNT(*) FILTER (WHERE genre IS NOT NULL AND year_of_release IS NOT NULL) AS n2,
         (SELECT COUNT(*) FROM ({SQL_CLEAN}) c) AS n3
  FROM g),
steps AS (
  SELECT 1 AS step, 'genre missing' AS step_name, n0 AS rows_in, n1 AS rows_out FROM counts
  UNION ALL SELECT 2, 'year missing', n1, n2 FROM counts
  UNION ALL SELECT 3, 'duplicates', n2, n3 FROM counts)
SELECT step, step_name, rows_in, rows_out, {PCT('rows_in - rows_out', 'rows_in')} AS lost_pct FROM steps
""")
def loss_by_step(spark: SparkSession, d: str) -> DataFrame:
    """Rows before and after each cleaning step, and the share it
    loses, observed while the cleaned table is written."""
    steps = Steps()
    cleaned = clean_games(spark, d, steps)
    steps.run(cleaned, tables(spark, d)("lineitem").count())
    return steps.report()


@register("impute_group_mean", f"""
WITH d AS (
  SELECT l_orderkey, l_linenumber, l_returnflag,
         CASE WHEN l_orderkey % 17 <> 0 THEN CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) END AS ship_year,
         CASE WHEN l_orderkey % 5 <> 0 THEN l_discount END AS sales
  FROM lineitem),
m AS (SELECT l_returnflag, ship_year, AVG(sales) AS mean_sales FROM d GROUP BY l_returnflag, ship_year)
SELECT d.l_orderkey, d.l_linenumber, {R('COALESCE(d.sales, m.mean_sales)', 6)} AS sales_filled
FROM d LEFT JOIN m ON d.l_returnflag = m.l_returnflag AND d.ship_year = m.ship_year
""")
def impute_group_mean(spark: SparkSession, d: str) -> DataFrame:
    """Missing sales filled with the (platform, year) mean; a row with
    a missing year has no group and keeps its NULL."""
    li = tables(spark, d)("lineitem")
    k = F.col("l_orderkey")
    x = li.select("l_orderkey", "l_linenumber", "l_returnflag",
                  F.when(k % 17 != 0, F.year("l_shipdate")).alias("ship_year"),
                  F.when(k % 5 != 0, F.col("l_discount")).alias("sales"))
    f = fill_group_mean(x, "sales", ["l_returnflag", "ship_year"], "sales_filled")
    return f.select("l_orderkey", "l_linenumber", dec_round("sales_filled", 6).alias("sales_filled"))


@register("fill_const", """
SELECT upper(COALESCE(CASE WHEN l_orderkey % 4 <> 0 THEN lower(l_linestatus) END, 'no_rating')) AS rating, COUNT(*) AS n
FROM lineitem GROUP BY 1
""")
def fill_const_q(spark: SparkSession, d: str) -> DataFrame:
    """Missing rating -> 'no_rating', upper-cased afterwards; counts."""
    li = tables(spark, d)("lineitem")
    r = li.select(F.when(F.col("l_orderkey") % 4 != 0, F.lower("l_linestatus")).alias("rating"))
    r = fill_const(r, {"rating": "no_rating"}).withColumn("rating", F.upper("rating"))
    return value_counts(r, "rating")


@register("drop_dups", """
SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders
""")
def drop_dups(spark: SparkSession, d: str) -> DataFrame:
    """Drop full-row duplicates of a projection."""
    return tables(spark, d)("orders").select("o_custkey", "o_orderstatus", "o_orderpriority").dropDuplicates()


PRICE_LO, PRICE_HI = 920, 990


def _bucket_sql(case_sql: str, labels: list[str]) -> str:
    vals = ", ".join(f"('{lab}', {i + 1})" for i, lab in enumerate(labels))
    return f"""
WITH b AS (SELECT {case_sql} AS category FROM part WHERE p_retailprice BETWEEN {PRICE_LO} AND {PRICE_HI}),
c AS (SELECT category, COUNT(*) AS n FROM b WHERE category IS NOT NULL GROUP BY category),
labels AS (SELECT * FROM (VALUES {vals}) t(category, ord))
SELECT labels.category, COALESCE(c.n, 0) AS n FROM labels LEFT JOIN c ON labels.category = c.category
"""


def _bucket_counts(spark: SparkSession, d: str, expr, labels: list[str]) -> DataFrame:
    """Counts per category, empty categories reported as 0, in label order."""
    p = tables(spark, d)("part").where(F.col("p_retailprice").between(PRICE_LO, PRICE_HI))
    counts = p.select(expr.alias("category")).where(F.col("category").isNotNull()) \
              .groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    rows = [F.struct(F.lit(lab).alias("category"), F.lit(i + 1).alias("ord")) for i, lab in enumerate(labels)]
    dim = spark.range(1).select(F.inline(F.array(*rows)))
    return (dim.join(F.broadcast(counts), "category", "left")
               .select("category", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "ord")
               .orderBy("ord").drop("ord"))


LEFT_EDGES = [-1, 0, 10, 40, 50]


@register("bucket_left", _bucket_sql(
    "CASE WHEN p_size >= -1 AND p_size < 0 THEN 'no_rating' WHEN p_size >= 0 AND p_size < 10 THEN 'low' "
    "WHEN p_size >= 10 AND p_size < 40 THEN 'medium' WHEN p_size >= 40 AND p_size < 50 THEN 'high' END", SCORE_LABELS))
def bucket_left(spark: SparkSession, d: str) -> DataFrame:
    """Left-closed bins like the code: the top value matches
    no bin and is not counted (H3)."""
    return _bucket_counts(spark, d, bucketize("p_size", LEFT_EDGES, SCORE_LABELS, right=False), SCORE_LABELS)


@register("bucket_left_closed", _bucket_sql(
    "CASE WHEN p_size >= -1 AND p_size < 0 THEN 'no_rating' WHEN p_size >= 0 AND p_size < 10 THEN 'low' "
    "WHEN p_size >= 10 AND p_size < 40 THEN 'medium' WHEN p_size >= 40 AND p_size <= 50 THEN 'high' END", SCORE_LABELS))
def bucket_left_closed(spark: SparkSession, d: str) -> DataFrame:
    """M34 with the stated intent: the last bin includes its right edge."""
    return _bucket_counts(spark, d, bucketize("p_size", LEFT_EDGES, SCORE_LABELS, right=False, close_last=True),
                          SCORE_LABELS)


@register("bucket_right", _bucket_sql(
    "CASE WHEN p_size >= 0 AND p_size <= 10 THEN 'small' WHEN p_size > 10 AND p_size <= 30 THEN 'medium' "
    "WHEN p_size > 30 AND p_size <= (SELECT MAX(p_size) FROM part WHERE p_retailprice BETWEEN "
    f"{PRICE_LO} AND {PRICE_HI}) THEN 'large' END", SIZE_LABELS))
def bucket_right(spark: SparkSession, d: str) -> DataFrame:
    """Right-closed bins, lowest included, last edge = data maximum
    (a scalar subquery)."""
    p = tables(spark, d)("part").where(F.col("p_retailprice").between(PRICE_LO, PRICE_HI))
    top = p.agg(F.max("p_size")).scalar()
    expr = bucketize("p_size", [0, 10, 30, top], SIZE_LABELS, right=True, include_lowest=True)
    return _bucket_counts(spark, d, expr, SIZE_LABELS)


@register("top7_groups", """
SELECT p_brand, COUNT(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 7
""")
def top7_groups(spark: SparkSession, d: str, k: int = 7) -> DataFrame:
    """The seven most frequent values (tie-break: value, H19)."""
    return topk(value_counts(tables(spark, d)("part"), "p_brand"), k, [F.desc("n")], ["p_brand"])


@register("distinct_values", """
WITH v AS (
  SELECT DISTINCT 'p_type' AS column_name, CAST(p_type AS VARCHAR) AS value FROM part WHERE p_type IS NOT NULL
  UNION ALL
  SELECT DISTINCT 'o_orderpriority' AS column_name, CAST(o_orderpriority AS VARCHAR) AS value FROM orders WHERE o_orderpriority IS NOT NULL)
SELECT column_name, value, COUNT(*) OVER (PARTITION BY column_name) AS n_distinct FROM v
""")
def distinct_values_q(spark: SparkSession, d: str) -> DataFrame:
    """Sorted distinct values and their count per column."""
    t = tables(spark, d)
    a = distinct_values(t("part"), ["p_type"])
    b = distinct_values(t("orders"), ["o_orderpriority"])
    return a.unionByName(b).orderBy("column_name", "value")
