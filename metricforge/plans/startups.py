"""Start-up funding study (M23-M32) on the driver tables.

Mapping: company -> (customer, order priority) for the funding-term study;
funding round -> order, with the number of lines as rounds and total price
as money (orders without lines have no rounds and drop out, like the
``funding_rounds > 0`` filter); market -> order priority for the outlier
study, part name for the market-size classes, customer segment for the
pivot; funding types -> return flags; returns -> discounted line amounts by
ship year against line amounts by order year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricforge.functions.binning import bucketize, classify_size
from metricforge.functions.coerce import coerce_date, coerce_numeric, midpoint
from metricforge.functions.calendar import year_range
from metricforge.functions.numeric import dec_round, money, pct, rate, ratio_eps
from metricforge.operators.aggregates import topk, value_counts, wide_totals
from metricforge.operators.outliers import flag_outliers, outlier_share
from metricforge.operators.percentiles import with_quantiles
from metricforge.plans.common import MONEY, PCT, RATE, R, RATIO, register, tables
from metricforge.session import write_once
from metricforge.sources.files import normalize_headers
from metricforge.sources.layout import bucketed

# Fixed labels (ASCII output names).
TERM_GROUPS = ["single", "up_to_year", "over_year"]
SIZE_CLASSES = ["niche", "medium", "mass"]
EXCLUDED_SEGMENTS = ("HOUSEHOLD",)
MIN_ROUNDS_PER_YEAR = 50


def _labels(spark: SparkSession, labels: list[str], name: str) -> DataFrame:
    """Listed order of a fixed label set (O7): (label, ord)."""
    rows = [F.struct(F.lit(lab).alias(name), F.lit(i + 1).alias("ord")) for i, lab in enumerate(labels)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def funding_group(rounds, duration_days):
    """One round -> single; duration <= 365 days -> up to a year;
    otherwise (including a missing duration, H6) -> over a year."""
    r = F.col(rounds) if isinstance(rounds, str) else rounds
    dur = F.col(duration_days) if isinstance(duration_days, str) else duration_days
    return (F.when(r == 1, F.lit(TERM_GROUPS[0]))
             .when(dur <= 365, F.lit(TERM_GROUPS[1])).otherwise(F.lit(TERM_GROUPS[2])))


def companies(spark: SparkSession, d: str) -> DataFrame:
    o = tables(spark, d)("orders")
    return o.groupBy("o_custkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("funding_rounds"),
        F.sum(money("o_totalprice")).alias("funding_total"),
        F.to_date(F.min("o_orderdate")).alias("first_funding_at"),
        F.to_date(F.max("o_orderdate")).alias("last_funding_at"))


@register("term_groups", f"""
WITH c AS (
  SELECT o_custkey, o_orderpriority, COUNT(*) AS funding_rounds, SUM({MONEY('o_totalprice')}) AS funding_total,
         CAST(MIN(o_orderdate) AS DATE) AS first_funding_at, CAST(MAX(o_orderdate) AS DATE) AS last_funding_at
  FROM orders GROUP BY o_custkey, o_orderpriority),
g AS (
  SELECT CASE WHEN funding_rounds = 1 THEN 'single'
              WHEN DATE_DIFF('day', first_funding_at, last_funding_at) <= 365 THEN 'up_to_year'
              ELSE 'over_year' END AS funding_group, funding_total
  FROM c)
SELECT funding_group, COUNT(*) AS n_companies,
       {PCT('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS company_pct,
       {R('COALESCE(SUM(funding_total), 0)')} AS funding_total,
       {PCT('COALESCE(SUM(funding_total), 0)', 'SUM(COALESCE(SUM(funding_total), 0)) OVER ()')} AS funding_pct
FROM g GROUP BY funding_group
""")
def term_groups(spark: SparkSession, d: str) -> DataFrame:
    """Companies by funding term; share of companies and of
    money, in the listed label order. A missing duration with more than one
    round falls to the last branch (H6)."""
    c = companies(spark, d)
    grp = funding_group("funding_rounds", F.datediff("last_funding_at", "first_funding_at"))
    # pandas group sums: all-NULL money sums to 0.
    g = c.groupBy(grp.alias("funding_group")).agg(
        F.count(F.lit(1)).alias("n_companies"), F.coalesce(F.sum("funding_total"), F.lit(0)).alias("s"))
    n_all = g.agg(F.sum("n_companies")).scalar()
    s_all = g.agg(F.sum("s")).scalar()
    out = g.select("funding_group", "n_companies", pct("n_companies", n_all).alias("company_pct"),
                   dec_round("s", 2).alias("funding_total"), pct("s", s_all).alias("funding_pct"))
    order = _labels(spark, TERM_GROUPS, "funding_group")
    return out.join(F.broadcast(order), "funding_group").orderBy("ord").drop("ord")


def market_sizes(spark: SparkSession, d: str, low: int = 35, high: int = 120) -> DataFrame:
    """Companies per market and its class by the function and by the bins
    (H4: a market of exactly ``low`` companies differs between the rules);
    the last bin edge is the data maximum (P14), a scalar subquery."""
    counts = value_counts(tables(spark, d)("part"), "p_name", "company_count").withColumnRenamed("p_name", "market")
    top = counts.agg(F.max("company_count")).scalar()
    return counts.select(
        "market", "company_count",
        classify_size("company_count", low, high, SIZE_CLASSES).alias("segment_type"),
        bucketize("company_count", [0, low, high, top], SIZE_CLASSES, right=True, include_lowest=True).alias("size_group"))


SQL_MARKETS = """
WITH counts AS (SELECT p_name AS market, COUNT(*) AS company_count FROM part WHERE p_name IS NOT NULL GROUP BY p_name),
mx AS (SELECT MAX(company_count) AS top FROM counts)
SELECT market, company_count,
       CASE WHEN company_count < 35 THEN 'niche' WHEN company_count <= 120 THEN 'medium'
            WHEN company_count > 120 THEN 'mass' END AS segment_type,
       CASE WHEN company_count >= 0 AND company_count <= 35 THEN 'niche'
            WHEN company_count > 35 AND company_count <= 120 THEN 'medium'
            WHEN company_count > 120 AND company_count <= mx.top THEN 'mass' END AS size_group
FROM counts, mx
"""


@register("segment_classes", f"""
SELECT market, company_count, segment_type, size_group,
       CASE segment_type WHEN 'medium' THEN 'mid' WHEN 'niche' THEN 'niche' ELSE market END AS market_collapsed
FROM ({SQL_MARKETS}) m
""")
def segment_classes(spark: SparkSession, d: str, low: int = 35, high: int = 120) -> DataFrame:
    """Market-size classes by both rules and the
    collapsed market label (medium -> mid, niche -> niche)."""
    m = market_sizes(spark, d, low, high)
    collapsed = (F.when(F.col("segment_type") == "medium", F.lit("mid"))
                  .when(F.col("segment_type") == "niche", F.lit("niche")).otherwise(F.col("market")))
    return m.withColumn("market_collapsed", collapsed)


@register("segment_class_summary", f"""
WITH m AS ({SQL_MARKETS}),
labels AS (SELECT * FROM (VALUES ('niche', 1), ('medium', 2), ('mass', 3)) t(cls, ord)),
rules AS (SELECT * FROM (VALUES ('function'), ('bins')) r(rule))
SELECT rules.rule, labels.cls AS class,
       COALESCE((SELECT COUNT(*) FROM m WHERE (CASE rules.rule WHEN 'function' THEN m.segment_type ELSE m.size_group END) = labels.cls), 0) AS n_markets
FROM rules, labels
""")
def segment_class_summary(spark: SparkSession, d: str, low: int = 35, high: int = 120) -> DataFrame:
    """Markets per class under each rule, empty classes as 0."""
    m = market_sizes(spark, d, low, high)
    long = m.select(F.inline(F.array(
        F.struct(F.lit("function").alias("rule"), F.col("segment_type").alias("class")),
        F.struct(F.lit("bins").alias("rule"), F.col("size_group").alias("class")))))
    counts = long.groupBy("rule", "class").agg(F.count(F.lit(1)).alias("n"))
    grid = _labels(spark, SIZE_CLASSES, "class").select(
        F.explode(F.array(F.lit("function"), F.lit("bins"))).alias("rule"), "class")
    return (grid.join(counts, ["rule", "class"], "left")
                .select("rule", "class", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_markets")))


@register("market_collapsed_counts", f"""
WITH m AS ({SQL_MARKETS})
SELECT CASE m.segment_type WHEN 'medium' THEN 'mid' WHEN 'niche' THEN 'niche' ELSE p.p_name END AS market,
       COUNT(*) AS n_companies
FROM part p LEFT JOIN m ON p.p_name = m.market
WHERE p.p_name IS NOT NULL
GROUP BY 1
""")
def market_collapsed_counts(spark: SparkSession, d: str, low: int = 35, high: int = 120) -> DataFrame:
    """Companies per market label, with medium markets as 'mid'
    and niche markets as 'niche'. Every company has its market's label, and
    the market table already counts the companies."""
    m = segment_classes(spark, d, low, high)
    return (m.groupBy(F.col("market_collapsed").alias("market"))
            .agg(F.sum("company_count").cast("bigint").alias("n_companies")).orderBy(F.desc("n_companies"), "market"))


def mass_market_years(spark: SparkSession, d: str, low: int = 35, high: int = 40) -> DataFrame:
    """Line amounts per (year, collapsed market), the collapsed
    'mid' and 'niche' left out. Lines are summed per (part, year) before the
    part join; the market labels are one row per market."""
    t = tables(spark, d)
    labels = write_once(segment_classes(spark, d, low, high).where(~F.col("market_collapsed").isin("mid", "niche"))
                        .select("market", "market_collapsed"))
    orders = t("orders").where(F.col("o_orderdate").isNotNull()).select("o_orderkey", F.year("o_orderdate").alias("year"))
    lines = (t("lineitem").select("l_orderkey", "l_partkey", money("l_extendedprice").alias("amt"))
             .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy("l_partkey", "year").agg(F.sum("amt").alias("amt")))
    parts = t("part").select("p_partkey", F.col("p_name").alias("market"))
    return (lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(labels, "market")
            .groupBy("year", F.col("market_collapsed").alias("market")).agg(F.sum("amt").alias("amt")))


SQL_MASS_YEARS = f"""
SELECT YEAR(o_orderdate) AS year, p_name AS market, SUM({MONEY('l_extendedprice')}) AS amt
FROM lineitem, orders, part
WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey AND o_orderdate IS NOT NULL
  AND p_name IN (SELECT p_name FROM part GROUP BY p_name HAVING COUNT(*) > 40)
GROUP BY ALL
"""


@register("mass_market_pivot", f"SELECT year, market, {R('amt')} AS total FROM ({SQL_MASS_YEARS}) y")
def mass_market_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Year by mass market, in long form."""
    return mass_market_years(spark, d).select("year", "market", dec_round("amt", 2).alias("total")).orderBy("year", "market")


@register("mass_market_growing", f"""
SELECT market, {R('SUM(amt) FILTER (WHERE year = 1997)')} AS total_before, {R('SUM(amt) FILTER (WHERE year = 1998)')} AS total_after
FROM ({SQL_MASS_YEARS}) y GROUP BY market HAVING SUM(amt) FILTER (WHERE year = 1998) > SUM(amt) FILTER (WHERE year = 1997)
""")
def mass_market_growing(spark: SparkSession, d: str, before: int = 1997, after: int = 1998) -> DataFrame:
    """M31/F15 on the mass markets of M24."""
    return growing(mass_market_years(spark, d).withColumnRenamed("market", "segment"), before, after).withColumnRenamed(
        "segment", "market")


def order_rounds(spark: SparkSession, d: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """One row per order with lines: rounds = number of lines, round size =
    total / rounds, funding year. A year range cuts the orders in their scan."""
    t = tables(spark, d)
    lines = t("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("funding_rounds"))
    o = t("orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    if first is not None:
        o = o.where(year_range("o_orderdate", first, last))
    j = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.select("o_orderkey", F.col("o_orderpriority").alias("market"), "funding_rounds",
                    F.col("o_totalprice").alias("funding_total"),
                    (F.col("o_totalprice") / F.col("funding_rounds")).alias("round_size"),
                    F.year("o_orderdate").alias("funding_year"),
                    F.month("o_orderdate").alias("funding_month"))


def _with_market(spark: SparkSession, d: str) -> DataFrame:
    """Rounds of companies with a market: ``groupby('market').apply(...)``
    drops rows whose key is missing (H11). Read by the fences and by the
    rows they flag: the columns in use are written once, and neither reader
    shuffles the lines again."""
    return write_once(order_rounds(spark, d).where(F.col("market").isNotNull())
                      .select("o_orderkey", "market", "funding_rounds", "funding_total", "round_size", "funding_year"))


SQL_ROUNDS = """
SELECT o.o_orderkey, o.o_orderpriority AS market, l.funding_rounds, o.o_totalprice AS funding_total,
       o.o_totalprice / l.funding_rounds AS round_size,
       CAST(EXTRACT(YEAR FROM o.o_orderdate) AS INTEGER) AS funding_year,
       CAST(EXTRACT(MONTH FROM o.o_orderdate) AS INTEGER) AS funding_month
FROM orders o JOIN (SELECT l_orderkey, COUNT(*) AS funding_rounds FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey
"""


def _sql_flagged(k: float) -> str:
    return f"""
WITH r AS ({SQL_ROUNDS}),
f AS (SELECT market, QUANTILE_CONT(funding_total, 0.25) AS q1, QUANTILE_CONT(funding_total, 0.75) AS q3 FROM r GROUP BY market)
SELECT r.*, COALESCE(r.funding_total < f.q1 - {k} * (f.q3 - f.q1) OR r.funding_total > f.q3 + {k} * (f.q3 - f.q1), FALSE)
         AS is_outlier
FROM r JOIN f ON r.market = f.market
"""


@register("iqr_outlier_share", f"""
WITH g AS (SELECT market, COUNT(funding_total) AS n_rows, COUNT(*) FILTER (WHERE is_outlier) AS n_out
           FROM ({_sql_flagged(3.0)}) x GROUP BY market)
SELECT market, n_rows, CASE WHEN n_out > 0 THEN n_out END AS n_outliers,
       {R(RATIO('CASE WHEN n_out > 0 THEN n_out END', 'n_rows'), 4)} AS outlier_share
FROM g ORDER BY outlier_share DESC NULLS LAST, market LIMIT 5
""")
def iqr_outlier_share(spark: SparkSession, d: str, k: float = 3.0, top: int = 5) -> DataFrame:
    """Share of outlier companies per market (IQR of the
    total funding, k=3), top markets; a market without outliers has a NULL share (H8)."""
    s = outlier_share(_with_market(spark, d), ["market"], "funding_total", k)
    return topk(s, top, [F.desc_nulls_last("outlier_share")], ["market"])


@register("iqr_outlier_removed", f"""
SELECT market, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE NOT is_outlier) AS n_kept
FROM ({_sql_flagged(1.5)}) x GROUP BY market
""")
def iqr_outlier_removed(spark: SparkSession, d: str, k: float = 1.5) -> DataFrame:
    """Rows per market before and after removing outliers (k=1.5, H1)."""
    f = flag_outliers(_with_market(spark, d), ["market"], "funding_total", k)
    return f.groupBy("market").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("is_outlier")).alias("n_kept"))


def final_rounds(spark: SparkSession, d: str, k: float = 1.5, min_rounds: int = MIN_ROUNDS_PER_YEAR) -> DataFrame:
    """Clean rows (outliers removed) in years with at least ``min_rounds``
    rounds (F9 HAVING, F7 semi join on the year set)."""
    clean = flag_outliers(_with_market(spark, d), ["market"], "funding_total", k).where(~F.col("is_outlier"))
    # A row per year, written so that its size is known: the rows are not
    # shuffled on a few years.
    valid = write_once(clean.groupBy("funding_year").agg(F.sum("funding_rounds").alias("r"))
                       .where(F.col("r") >= min_rounds).select("funding_year"))
    return clean.join(valid, "funding_year", "left_semi")


SQL_FINAL = f"""
WITH clean AS (SELECT * FROM ({_sql_flagged(1.5)}) x WHERE NOT is_outlier),
valid AS (SELECT funding_year FROM clean GROUP BY funding_year HAVING SUM(funding_rounds) >= {MIN_ROUNDS_PER_YEAR})
SELECT * FROM clean WHERE funding_year IN (SELECT funding_year FROM valid)
"""


@register("active_years", f"""
SELECT funding_year, COUNT(*) AS n_rows, CAST(SUM(funding_rounds) AS BIGINT) AS rounds
FROM ({SQL_FINAL}) f GROUP BY funding_year
""")
def active_years(spark: SparkSession, d: str) -> DataFrame:
    """Rows and rounds per year after both filters."""
    return (final_rounds(spark, d).groupBy("funding_year")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("funding_rounds").cast("bigint").alias("rounds"))
            .orderBy("funding_year"))


@register("completeness_years", f"""
SELECT funding_year, COUNT(*) AS n_rows FROM ({SQL_ROUNDS}) r WHERE funding_year IS NOT NULL GROUP BY funding_year
""")
def completeness_years(spark: SparkSession, d: str) -> DataFrame:
    """Rows per year (period completeness)."""
    r = order_rounds(spark, d).where(F.col("funding_year").isNotNull())  # value_counts drops NULL
    return r.groupBy("funding_year").agg(F.count(F.lit(1)).alias("n_rows")).orderBy("funding_year")


@register("completeness_years_bucketed", f"""
SELECT funding_year, COUNT(*) AS n_rows FROM ({SQL_ROUNDS}) r WHERE funding_year IS NOT NULL GROUP BY funding_year
""")
def completeness_years_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The same on copies bucketed by the order key: the grouping
    of the lines and the join with the orders need no shuffle."""
    t = tables(spark, d)
    orders = bucketed(t("orders").where(F.col("o_orderdate").isNotNull()).select(
        "o_orderkey", F.year("o_orderdate").alias("funding_year")), "o_orderkey")
    lines = bucketed(t("lineitem").select("l_orderkey"), "l_orderkey")
    rounds = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("funding_rounds"))
    r = orders.join(rounds, F.col("o_orderkey") == F.col("l_orderkey"))
    return r.groupBy("funding_year").agg(F.count(F.lit(1)).alias("n_rows")).orderBy("funding_year")


@register("completeness_months", f"""
SELECT funding_month, COUNT(*) AS n_rows FROM ({SQL_ROUNDS}) r WHERE funding_year = 1998 GROUP BY funding_month
""")
def completeness_months(spark: SparkSession, d: str, year: int = 1998) -> DataFrame:
    """Rows per month of one year."""
    r = order_rounds(spark, d, year, year)
    return r.groupBy("funding_month").agg(F.count(F.lit(1)).alias("n_rows")).orderBy("funding_month")


@register("median_round_by_year", f"""
SELECT funding_year, {R('MEDIAN(round_size)', 4)} AS median_round, CAST(SUM(funding_rounds) AS BIGINT) AS rounds
FROM ({SQL_FINAL}) f GROUP BY funding_year
""")
def median_round_by_year(spark: SparkSession, d: str) -> DataFrame:
    """Median round size and rounds per year."""
    f = final_rounds(spark, d)
    g = f.groupBy("funding_year").agg(F.sum("funding_rounds").cast("bigint").alias("rounds"))
    g = with_quantiles(g, f, ["funding_year"], [("round_size", 0.5, "median_round")])
    return g.select("funding_year", dec_round("median_round", 4).alias("median_round"), "rounds").orderBy("funding_year")


@register("year_of_max", f"""
SELECT funding_year, median_round FROM (
  SELECT funding_year, {R('MEDIAN(round_size)', 4)} AS median_round FROM ({SQL_FINAL}) f GROUP BY funding_year)
ORDER BY median_round DESC, funding_year LIMIT 1
""")
def year_of_max(spark: SparkSession, d: str) -> DataFrame:
    """The year with the largest median round (first year on ties)."""
    m = median_round_by_year(spark, d)
    best = F.max_by(F.struct("funding_year", "median_round"),
                    F.struct(F.col("median_round"), -F.col("funding_year")))
    return m.agg(best.alias("b")).select("b.funding_year", "b.median_round")


def _segment_sums(spark: SparkSession, d: str, excluded=EXCLUDED_SEGMENTS) -> DataFrame:
    t = tables(spark, d)
    o = t("orders").select("o_custkey", F.year("o_orderdate").alias("year"), money("o_totalprice").alias("amt"))
    c = t("customer").where(~F.col("c_mktsegment").isin(*excluded)).select("c_custkey", "c_mktsegment")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"))


@register("pivot_year_group", f"""
SELECT YEAR(o_orderdate) AS year, c_mktsegment AS segment, {R(f"SUM({MONEY('o_totalprice')})")} AS total
FROM customer JOIN orders ON c_custkey = o_custkey
WHERE o_orderdate IS NOT NULL AND c_mktsegment NOT IN ({", ".join(f"'{x}'" for x in EXCLUDED_SEGMENTS)})
GROUP BY ALL
""")
def pivot_year_group(spark: SparkSession, d: str) -> DataFrame:
    """Year by segment total funding, excluded segments left out.
    Long form (year, segment, total), so every segment of the data is there
    and the schema does not depend on it."""
    j = _segment_sums(spark, d).where(F.col("year").isNotNull())  # pivot_table drops a missing index
    return (j.groupBy("year", F.col("c_mktsegment").alias("segment")).agg(dec_round(F.sum("amt"), 2).alias("total"))
            .orderBy("year", "segment"))


def growing(sums: DataFrame, before: int, after: int) -> DataFrame:
    """segments of ``sums(year, segment, amt)`` whose total grew between
    two years. A segment with no rows in either year has a NULL sum and drops
    out (H29)."""
    g = sums.groupBy("segment").agg(
        F.sum(F.when(F.col("year") == before, F.col("amt"))).alias("a"),
        F.sum(F.when(F.col("year") == after, F.col("amt"))).alias("b"))
    return g.where(F.col("b") > F.col("a")).select(
        "segment", dec_round("a", 2).alias("total_before"), dec_round("b", 2).alias("total_after"))


@register("growing_groups", f"""
WITH s AS (
  SELECT c.c_mktsegment AS segment,
         SUM(CASE WHEN EXTRACT(YEAR FROM o.o_orderdate) = 1997 THEN {MONEY('o.o_totalprice')} END) AS a,
         SUM(CASE WHEN EXTRACT(YEAR FROM o.o_orderdate) = 1998 THEN {MONEY('o.o_totalprice')} END) AS b
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_mktsegment NOT IN ({", ".join(f"'{s}'" for s in EXCLUDED_SEGMENTS)})
  GROUP BY 1)
SELECT segment, {R('a')} AS total_before, {R('b')} AS total_after FROM s WHERE b > a
""")
def growing_groups(spark: SparkSession, d: str, before: int = 1997, after: int = 1998) -> DataFrame:
    """Segments whose total grew between two years."""
    return growing(_segment_sums(spark, d).withColumnRenamed("c_mktsegment", "segment"), before, after)


SQL_RETURNS = f"""
WITH inv AS (
  SELECT CAST(EXTRACT(YEAR FROM o.o_orderdate) AS INTEGER) AS year, l.l_returnflag AS type,
         COALESCE(SUM({MONEY('l.l_extendedprice')}), 0) AS investments
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE o.o_orderdate IS NOT NULL AND l.l_returnflag IS NOT NULL GROUP BY 1, 2),
ret AS (
  SELECT CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) AS year, l_returnflag AS type,
         SUM({MONEY('l_extendedprice')} * (1 - {RATE('l_discount')})) AS returns
  FROM lineitem WHERE l_shipdate IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1, 2),
j AS (
  SELECT COALESCE(r.year, i.year) AS year, COALESCE(r.type, i.type) AS type, r.returns, i.investments,
         CAST(r.returns AS DOUBLE) / (CAST(i.investments AS DOUBLE) + 1e-6) AS ratio
  FROM ret r FULL OUTER JOIN inv i ON r.year = i.year AND r.type = i.type)
SELECT year, type, {R('returns')} AS returns, {R('investments')} AS investments,
       {R('CASE WHEN ratio <= 1 THEN ratio END', 6)} AS return_ratio
FROM j
"""
CHOSEN_TYPES = ("A", "N")


@register("return_ratio", SQL_RETURNS)
def return_ratio(spark: SparkSession, d: str, eps: float = 1e-6, returns_scale: float = 1.0,
                 types: tuple[str, ...] | None = None) -> DataFrame:
    """Returns / (investments + eps) per (year, type),
    aligned with a full outer join (H30); ratios above 1 become NULL.
    ``types`` keeps the chosen funding types, in the scan of the lines."""
    t = tables(spark, d)
    # pandas group sums drop missing years; funding types are columns (never missing).
    li = t("lineitem").where(F.col("l_returnflag").isNotNull() if types is None else F.col("l_returnflag").isin(*types))
    # Lines reduced per (order, type) before the order join.
    per_order = li.groupBy("l_orderkey", "l_returnflag").agg(F.sum(money("l_extendedprice")).alias("s"))
    orders = t("orders").where(F.col("o_orderdate").isNotNull()).select("o_orderkey", "o_orderdate")
    inv = (per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy(F.year("o_orderdate").alias("year"), F.col("l_returnflag").alias("type"))
             .agg(F.coalesce(F.sum("s"), F.lit(0)).alias("investments")))  # H10
    ret = (li.where(F.col("l_shipdate").isNotNull())
             .groupBy(F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("type"))
             .agg(F.sum(money("l_extendedprice") * (F.lit(1) - rate("l_discount"))).alias("returns")))
    j = ret.join(inv, ["year", "type"], "full_outer")
    # H9: the source divides returns (millions) by dollars without conversion;
    # ``returns_scale`` applies a unit factor to the returns side if wanted.
    r = ratio_eps(F.col("returns") * F.lit(returns_scale) if returns_scale != 1.0 else "returns", "investments", eps)
    return j.select("year", "type", dec_round("returns", 2).alias("returns"),
                    dec_round("investments", 2).alias("investments"),
                    dec_round(F.when(r <= 1, r), 6).alias("return_ratio"))


@register("return_ratio_chosen", f"SELECT * FROM ({SQL_RETURNS}) r WHERE type IN {CHOSEN_TYPES}")
def return_ratio_chosen(spark: SparkSession, d: str) -> DataFrame:
    """M32's last step: the ratio of the chosen funding types."""
    return return_ratio(spark, d, types=CHOSEN_TYPES)


def WIDE(x: str) -> str:
    return f"CAST({x} AS DECIMAL(28,9))"


TYPE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _wide_sql(src: str) -> str:
    sums = ", ".join(f"{R(f'COALESCE(SUM({WIDE(c)}), 0)')} AS {c}" for c in TYPE_COLS)
    return f"""
SELECT measure, value, RANK() OVER (ORDER BY value DESC NULLS LAST) AS rank
FROM (UNPIVOT (SELECT {sums} FROM {src}) ON {', '.join(TYPE_COLS)} INTO NAME measure VALUE value) u"""


@register("wide_sum_rank", _wide_sql("lineitem"))
def wide_sum_rank(spark: SparkSession, d: str) -> DataFrame:
    """Total per measure column, ranked."""
    return wide_totals(tables(spark, d)("lineitem"), TYPE_COLS, "sum")


@register("kept_type_totals", _wide_sql(f"lineitem SEMI JOIN ({SQL_FINAL}) f ON l_orderkey = f.o_orderkey"))
def kept_type_totals(spark: SparkSession, d: str) -> DataFrame:
    """The totals over the rows that M26 keeps (no outliers,
    years with enough rounds)."""
    kept = final_rounds(spark, d).select(F.col("o_orderkey").alias("l_orderkey"))
    return wide_totals(tables(spark, d)("lineitem").join(kept, "l_orderkey", "left_semi"), TYPE_COLS, "sum")


@register("wide_positive_rank", """
WITH t AS (SELECT COUNT(*) FILTER (WHERE l_quantity > 0) AS l_quantity, COUNT(*) FILTER (WHERE l_extendedprice > 0) AS l_extendedprice,
                  COUNT(*) FILTER (WHERE l_discount > 0) AS l_discount, COUNT(*) FILTER (WHERE l_tax > 0) AS l_tax FROM lineitem),
u AS (UNPIVOT t ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME measure VALUE value)
SELECT measure, value, RANK() OVER (ORDER BY value DESC NULLS LAST) AS rank FROM u
""")
def wide_positive_rank(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a positive value per measure column, ranked."""
    return wide_totals(tables(spark, d)("lineitem"), TYPE_COLS, "positive")


def raw_companies(spark: SparkSession, d: str) -> DataFrame:
    """The start-up export as it arrives: headers with trailing blanks, the
    amount as text with thousands separators (and junk), dates as text
    (junk and out-of-range values), missing categories. Built from orders,
    with first/last funding dates from the order's ship dates."""
    t = tables(spark, d)
    o = t("orders")
    k = F.col("o_orderkey")
    s = t("lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("f"), F.max("l_shipdate").alias("l"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    j = o.join(s, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.select(
        F.col("o_custkey").alias("name"),
        F.when(k % 9 != 0, F.col("o_orderpriority")).alias("market "),
        F.col("o_orderstatus").alias("status"),
        F.when(k % 13 == 0, F.lit("n/a")).otherwise(F.format_number(F.floor("o_totalprice"), 0)).alias("funding_total_usd "),
        F.when(k % 11 == 0, F.lit("0020-06-14")).when(k % 7 == 0, F.lit("bad")).otherwise(day("o_orderdate")).alias("founded_at"),
        day("f").alias("first_funding_at"), day("l").alias("last_funding_at"),
        F.when(k % 3 != 0, day("o_orderdate")).alias("mid_funding_at"))


DATE_COLS = ["founded_at", "first_funding_at", "mid_funding_at", "last_funding_at"]


def _sql_date(x: str) -> str:
    return (f"CASE WHEN CAST(TRY_STRPTIME(trim({x}), '%Y-%m-%d') AS DATE) BETWEEN DATE '1677-09-22' AND DATE '2262-04-11' "
            f"THEN CAST(TRY_STRPTIME(trim({x}), '%Y-%m-%d') AS DATE) END")


@register("clean_companies", f"""
WITH s AS (SELECT l_orderkey, MIN(l_shipdate) AS f, MAX(l_shipdate) AS l FROM lineitem GROUP BY l_orderkey),
raw AS (
  SELECT o.o_custkey AS name, CASE WHEN o.o_orderkey % 9 <> 0 THEN o.o_orderpriority END AS market,
         o.o_orderstatus AS status,
         CASE WHEN o.o_orderkey % 13 = 0 THEN 'n/a' ELSE format('{{:,}}', CAST(FLOOR(o.o_totalprice) AS BIGINT)) END AS funding_total_usd,
         CASE WHEN o.o_orderkey % 11 = 0 THEN '0020-06-14' WHEN o.o_orderkey % 7 = 0 THEN 'bad'
              ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS founded_at,
         strftime(s.f, '%Y-%m-%d') AS first_funding_at, strftime(s.l, '%Y-%m-%d') AS last_funding_at,
         CASE WHEN o.o_orderkey % 3 <> 0 THEN strftime(o.o_orderdate, '%Y-%m-%d') END AS mid_funding_at
  FROM orders o LEFT JOIN s ON o.o_orderkey = s.l_orderkey),
typed AS (
  SELECT name, COALESCE(market, 'unknown') AS market, status,
         (CASE WHEN isnan(TRY_CAST(trim(replace(funding_total_usd, ',', '')) AS DOUBLE)) THEN NULL
               ELSE TRY_CAST(trim(replace(funding_total_usd, ',', '')) AS DOUBLE) END) AS funding_total_usd,
         {_sql_date('founded_at')} AS founded_at, {_sql_date('first_funding_at')} AS first_funding_at,
         {_sql_date('mid_funding_at')} AS mid_funding_at, {_sql_date('last_funding_at')} AS last_funding_at
  FROM raw),
kept AS (SELECT DISTINCT * FROM typed)
SELECT name, market, status, funding_total_usd, founded_at, first_funding_at, last_funding_at,
       COALESCE(CAST(mid_funding_at AS TIMESTAMP),
                make_timestamp(epoch_us(CAST(first_funding_at AS TIMESTAMP))
                               + (epoch_us(CAST(last_funding_at AS TIMESTAMP)) - epoch_us(CAST(first_funding_at AS TIMESTAMP))) // 2))
         AS mid_funding_at
FROM kept WHERE funding_total_usd IS NOT NULL
""")
def clean_companies(spark: SparkSession, d: str) -> DataFrame:
    """M22 end to end, in the source's order: strip header blanks (P7, H25),
    remove thousands separators and coerce the amount (C3, C8), coerce the
    four date columns with the pandas range (C9, H17), fill missing
    categories with 'unknown' (C6), drop full duplicates (U3), drop rows
    without an amount (F10), fill the middle funding date with the midpoint
    of first and last (C7, C19)."""
    df = normalize_headers(raw_companies(spark, d), snake=False)
    df = df.withColumn("funding_total_usd", coerce_numeric("funding_total_usd", thousands=","))
    for x in DATE_COLS:
        df = df.withColumn(x, coerce_date(x))
    df = df.na.fill({"market": "unknown"})
    df = df.dropDuplicates()
    df = df.na.drop(subset=["funding_total_usd"])
    mid = F.coalesce(F.col("mid_funding_at").cast("timestamp_ntz"), midpoint("first_funding_at", "last_funding_at"))
    return df.select("name", "market", "status", "funding_total_usd", "founded_at", "first_funding_at",
                     "last_funding_at", mid.alias("mid_funding_at"))
