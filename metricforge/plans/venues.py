"""Venue-market study (M1-M8, A14-A25, A34-A36) on the driver tables.

Mapping: venue -> ``part`` (category -> type, name -> name, chain -> list
price of at least 950, seats -> size, rating -> list price), bill ->
customer balance with the centre district = ``NATION_0``, venue texts ->
``documents`` (+ ``labels``), amounts -> ``lineitem`` / ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricforge.functions.numeric import dec_round, money, ratio
from metricforge.functions.text import PY_WHITESPACE, contains_flag, normalize_text
from metricforge.operators.aggregates import (
    describe, duplicate_rows, duplicate_summary, mode_by_group, topk, value_counts, with_share,
)
from metricforge.operators.joins import join_null_safe
from metricforge.operators.outliers import box_stats as _box_stats
from metricforge.operators.outliers import histogram
from metricforge.operators.percentiles import with_quantiles
from metricforge.operators.phi import phi_matrix, phi_sql
from metricforge.operators.stats import category_codes, corr_long, cramers_v as _cramers_v
from metricforge.plans.common import MONEY, PCT, R, register, tables
from metricforge.session import shared_path, write_once
from metricforge.sources.files import read_csv
from metricforge.sources.sinks import write_csv

CHAIN_MIN_PRICE = 950
CENTRE = "NATION_0"
NEEDLE = "License"


SQL_WHITESPACE = " || ".join(f"chr({ord(ch)})" for ch in PY_WHITESPACE)


def SQL_NORM(expr: str) -> str:
    """SQL twin of ``functions.text.normalize_text`` (same whitespace set)."""
    return f"replace(trim(lower({expr}), {SQL_WHITESPACE}), '  ', ' ')"


@register("group_counts", """
SELECT p_type, COUNT(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type
""")
def group_counts(spark: SparkSession, d: str) -> DataFrame:
    """Venues per category, most frequent first."""
    return value_counts(tables(spark, d)("part"), "p_type").orderBy(F.desc("n"), "p_type")


@register("group_counts_in_group", """
SELECT p_type, COUNT(*) AS n FROM part WHERE p_brand = 'Brand#1' AND p_type IS NOT NULL GROUP BY p_type
""")
def group_counts_in_group(spark: SparkSession, d: str, brand: str = "Brand#1") -> DataFrame:
    """M2: categories inside one district."""
    p = tables(spark, d)("part").where(F.col("p_brand") == brand)
    return value_counts(p, "p_type").orderBy(F.desc("n"), "p_type")


@register("district_counts", """
SELECT n.n_name AS district, COUNT(*) AS n
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name
""")
def district_counts(spark: SparkSession, d: str) -> DataFrame:
    """M2: venues per district (counted per district key, then named)."""
    t = tables(spark, d)
    per = value_counts(t("customer"), "c_nationkey")
    nation = t("nation").select("n_nationkey", F.col("n_name").alias("district"))
    return (per.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
               .groupBy("district").agg(F.sum("n").cast("bigint").alias("n")).orderBy(F.desc("n"), "district"))


@register("chain_counts", f"""
SELECT CASE WHEN p_retailprice >= {CHAIN_MIN_PRICE} THEN 1 ELSE 0 END AS chain, COUNT(*) AS n
FROM part GROUP BY 1
""")
def chain_counts(spark: SparkSession, d: str) -> DataFrame:
    """M3: chain vs non-chain venue counts."""
    return value_counts(_chain(tables(spark, d)("part")), "chain").orderBy(F.desc("n"))


@register("share_pct", f"""
SELECT p_type, COUNT(*) AS n, {PCT('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct
FROM part WHERE p_type IS NOT NULL GROUP BY p_type
""")
def share_pct(spark: SparkSession, d: str) -> DataFrame:
    """``value_counts(normalize=True) * 100``."""
    return with_share(value_counts(tables(spark, d)("part"), "p_type"), "n", "pct")


@register("share_of_sum", f"""
SELECT o_orderpriority, {R('SUM(' + MONEY('o_totalprice') + ')')} AS total,
       {PCT('SUM(' + MONEY('o_totalprice') + ')', 'SUM(SUM(' + MONEY('o_totalprice') + ')) OVER ()')} AS pct
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority
""")
def share_of_sum(spark: SparkSession, d: str) -> DataFrame:
    """Share of a summed measure per group, in percent."""
    o = tables(spark, d)("orders").where(F.col("o_orderpriority").isNotNull())  # pandas groupby drops NULL keys
    g = o.groupBy("o_orderpriority").agg(F.sum(money("o_totalprice")).alias("s"))
    return with_share(g, "s", "pct").select("o_orderpriority", dec_round("s", 2).alias("total"), "pct")


def _chain(df):
    return df.withColumn("chain", F.when(F.col("p_retailprice") >= CHAIN_MIN_PRICE, 1).otherwise(0))


@register("chain_share", f"""
SELECT p_type, COUNT(*) AS n, CAST(SUM(chain) AS BIGINT) AS chain_count, {R('AVG(chain)', 6)} AS chain_share
FROM (SELECT *, CASE WHEN p_retailprice >= {CHAIN_MIN_PRICE} THEN 1 ELSE 0 END AS chain FROM part) p
WHERE p_type IS NOT NULL GROUP BY p_type
""")
def chain_share(spark: SparkSession, d: str) -> DataFrame:
    """Chain count and share (mean of a 0/1 flag) per category."""
    p = _chain(tables(spark, d)("part")).where(F.col("p_type").isNotNull())
    return (p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.sum("chain").cast("bigint").alias("chain_count"),
                                    dec_round(F.avg("chain"), 6).alias("chain_share"))
             .orderBy(F.desc("chain_share"), "p_type"))


@register("median_by_group", f"""
SELECT p_type, COUNT(p_size) AS n, {R('MEDIAN(p_size)', 4)} AS median_size,
       {R('MEDIAN(p_retailprice)', 4)} AS median_price
FROM part WHERE p_type IS NOT NULL GROUP BY p_type
""")
def median_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Median seats (and rating) per category."""
    p = tables(spark, d)("part").where(F.col("p_type").isNotNull())
    g = p.groupBy("p_type").agg(F.count("p_size").alias("n"))
    g = with_quantiles(g, p, ["p_type"], [("p_size", 0.5, "median_size"), ("p_retailprice", 0.5, "median_price")])
    return (g.select("p_type", "n", dec_round("median_size", 4).alias("median_size"),
                     dec_round("median_price", 4).alias("median_price"))
             .orderBy(F.desc("median_size"), "p_type"))


@register("mean_by_group", f"""
SELECT l_returnflag, COUNT(l_discount) AS n, {R('AVG(l_discount)', 6)} AS mean_discount
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
""")
def mean_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Mean rating per category, sorted descending."""
    li = tables(spark, d)("lineitem").where(F.col("l_returnflag").isNotNull())
    return (li.groupBy("l_returnflag").agg(F.count("l_discount").alias("n"),
                                           dec_round(F.avg("l_discount"), 6).alias("mean_discount"))
              .orderBy(F.desc("mean_discount")))


DESCRIBE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(cols):
    parts = []
    for x in cols:
        parts.append(f"""
SELECT '{x}' AS column_name, COUNT({x}) AS count, {R(f'AVG({x})', 4)} AS mean, {R(f'STDDEV_SAMP({x})', 4)} AS std,
       {R(f'MIN({x})', 4)} AS min, {R(f'QUANTILE_CONT({x}, 0.25)', 4)} AS p25, {R(f'QUANTILE_CONT({x}, 0.5)', 4)} AS p50,
       {R(f'QUANTILE_CONT({x}, 0.75)', 4)} AS p75, {R(f'MAX({x})', 4)} AS max
FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


@register("describe_numeric", _describe_sql(DESCRIBE_COLS))
def describe_numeric(spark: SparkSession, d: str) -> DataFrame:
    """Exact eight-number summary, one pass over the table."""
    return describe(tables(spark, d)("lineitem"), DESCRIBE_COLS)


@register("histogram_50", f"""
WITH mm AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CAST(CASE WHEN mm.hi - mm.lo = 0 THEN 0
                       ELSE LEAST(FLOOR((l.l_extendedprice - mm.lo) / (mm.hi - mm.lo) * 50.0), 49) END AS INTEGER) AS bin
      FROM lineitem l, mm WHERE l.l_extendedprice IS NOT NULL),
c AS (SELECT bin, COUNT(*) AS n FROM b GROUP BY bin),
bins AS (SELECT CAST(r.range AS INTEGER) AS bin, mm.lo, mm.hi FROM range(0, 50) r, mm)
SELECT bins.bin, {R('bins.lo + bins.bin * ((bins.hi - bins.lo) / 50.0)', 4)} AS bin_low,
       {R('bins.lo + (bins.bin + 1) * ((bins.hi - bins.lo) / 50.0)', 4)} AS bin_high,
       COALESCE(c.n, 0) AS n
FROM bins LEFT JOIN c ON bins.bin = c.bin
""")
def histogram_50(spark: SparkSession, d: str, bins: int = 50) -> DataFrame:
    """50 equal-width bins of the amount, empty bins included."""
    return histogram(tables(spark, d)("lineitem"), "l_extendedprice", bins)


@register("box_stats", f"""
WITH f AS (
  SELECT o_orderpriority, QUANTILE_CONT(o_totalprice, 0.25) AS q1, QUANTILE_CONT(o_totalprice, 0.75) AS q3,
         MEDIAN(o_totalprice) AS median, COUNT(o_totalprice) AS n
  FROM orders GROUP BY o_orderpriority),
g AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM f)
SELECT g.o_orderpriority, g.n, {R('g.q1', 4)} AS q1, {R('g.median', 4)} AS median, {R('g.q3', 4)} AS q3,
       {R('g.lower_fence', 4)} AS lower_fence, {R('g.upper_fence', 4)} AS upper_fence,
       {R('MIN(CASE WHEN o.o_totalprice BETWEEN g.lower_fence AND g.upper_fence THEN o.o_totalprice END)', 4)} AS whisker_low,
       {R('MAX(CASE WHEN o.o_totalprice BETWEEN g.lower_fence AND g.upper_fence THEN o.o_totalprice END)', 4)} AS whisker_high,
       COUNT(*) FILTER (WHERE o.o_totalprice IS NOT NULL AND NOT (o.o_totalprice BETWEEN g.lower_fence AND g.upper_fence)) AS n_outliers
FROM orders o JOIN g ON o.o_orderpriority = g.o_orderpriority
GROUP BY g.o_orderpriority, g.n, g.q1, g.median, g.q3, g.lower_fence, g.upper_fence
""")
def box_stats(spark: SparkSession, d: str) -> DataFrame:
    """Box-plot statistics of the amount per group."""
    return _box_stats(tables(spark, d)("orders"), ["o_orderpriority"], "o_totalprice", 1.5)


# The seven columns of the study: codes, 0/1 flags, numbers, and a price class
# whose missing value is -1.
CORR_COLS = ["type_code", "brand_code", "price_code", "chain", "large", "p_size", "p_retailprice"]


def _corr_sql():
    pairs = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            expr = (f"COVAR_SAMP(CASE WHEN {both} THEN CAST({a} AS DOUBLE) END, CASE WHEN {both} THEN CAST({b} AS DOUBLE) END)"
                    f" / NULLIF(STDDEV_SAMP(CASE WHEN {both} THEN CAST({a} AS DOUBLE) END)"
                    f" * STDDEV_SAMP(CASE WHEN {both} THEN CAST({b} AS DOUBLE) END), 0)")
            pairs.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {R(expr, 6)} AS corr FROM coded")
    return f"""
WITH p AS (SELECT *, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS cat,
                  CASE WHEN p_partkey % 11 <> 0 THEN CAST(FLOOR(p_retailprice / 250) AS VARCHAR) END AS price_class,
                  CASE WHEN p_retailprice >= {CHAIN_MIN_PRICE} THEN 1 ELSE 0 END AS chain,
                  CASE WHEN p_size >= 25 THEN 1 ELSE 0 END AS large
           FROM part),
coded AS (
  SELECT *, CASE WHEN cat IS NULL THEN -1 ELSE DENSE_RANK() OVER (PARTITION BY cat IS NULL ORDER BY cat) - 1 END AS type_code,
         CASE WHEN price_class IS NULL THEN -1
              ELSE DENSE_RANK() OVER (PARTITION BY price_class IS NULL ORDER BY price_class) - 1 END AS price_code,
         CASE WHEN p_brand IS NULL THEN -1 ELSE DENSE_RANK() OVER (PARTITION BY p_brand IS NULL ORDER BY p_brand) - 1 END AS brand_code
  FROM p)
""" + "\nUNION ALL\n".join(pairs)


@register("corr_matrix", _corr_sql())
def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Alphabetical codes (missing category -> -1, H12) and the
    pairwise Pearson matrix in long form."""
    p = _chain(tables(spark, d)("part")).withColumns({
        "cat": F.when(F.col("p_partkey") % 13 != 0, F.col("p_type")),
        "price_class": F.when(F.col("p_partkey") % 11 != 0, F.floor(F.col("p_retailprice") / 250).cast("string")),
        "large": F.when(F.col("p_size") >= 25, 1).otherwise(0)})
    p = category_codes(p, {"cat": "type_code", "p_brand": "brand_code", "price_class": "price_code"})
    return corr_long(p, CORR_COLS)


PHI_COLS = ["cat", "p_brand", "price_class", "p_size", "p_retailprice", "chain"]
PHI_NUMBERS = ["p_size", "p_retailprice"]


@register("phi_matrix", phi_sql(f"""
  SELECT CASE WHEN p_partkey % 13 <> 0 THEN p_type END AS cat, p_brand, p_size, p_retailprice,
         CASE WHEN p_partkey % 11 <> 0 THEN CAST(CAST(FLOOR(p_retailprice / 250) AS BIGINT) AS VARCHAR) END AS price_class,
         CASE WHEN p_retailprice >= {CHAIN_MIN_PRICE} THEN 1 ELSE 0 END AS chain
  FROM part""", PHI_COLS, PHI_NUMBERS))
def phi_matrix_q(spark: SparkSession, d: str) -> DataFrame:
    """Correlation of all pairs of columns, numbers and categories
    alike, missing values left out pair by pair."""
    p = _chain(tables(spark, d)("part")).withColumns({
        "cat": F.when(F.col("p_partkey") % 13 != 0, F.col("p_type")),
        "price_class": F.when(F.col("p_partkey") % 11 != 0, F.floor(F.col("p_retailprice") / 250).cast("string"))})
    return phi_matrix(p, PHI_COLS, PHI_NUMBERS)


@register("top15_names", f"""
WITH g AS (SELECT p_name, COUNT(*) AS count_places, {R('AVG(p_retailprice)')} AS avg_price FROM part
           WHERE p_name IS NOT NULL GROUP BY p_name),
m AS (SELECT p_name, p_type, ROW_NUMBER() OVER (PARTITION BY p_name ORDER BY COUNT(*) DESC, p_type) AS rn
      FROM part WHERE p_type IS NOT NULL GROUP BY p_name, p_type)
SELECT g.p_name, g.count_places, g.avg_price, m.p_type AS category
FROM g LEFT JOIN m ON g.p_name = m.p_name AND m.rn = 1
ORDER BY g.count_places DESC, g.p_name
LIMIT 15
""")
def top15_names(spark: SparkSession, d: str, k: int = 15, chain_only: bool = False) -> DataFrame:
    """Top names by venue count with mean rating and modal
    category (ties -> smallest). All venues with the name count (H20);
    ``chain_only`` restricts to chain venues."""
    p = tables(spark, d)("part").where(F.col("p_name").isNotNull())  # pandas groupby drops NULL keys (H11)
    if chain_only:
        p = _chain(p).where(F.col("chain") == 1)
    g = p.groupBy("p_name").agg(F.count(F.lit(1)).alias("count_places"),
                                dec_round(F.avg("p_retailprice"), 2).alias("avg_price"))
    # The mode of k names only: k rows, bounded by the argument.
    top = write_once(topk(g, k, [F.desc("count_places")], ["p_name"]))
    m = mode_by_group(p.join(F.broadcast(top.select("p_name")), "p_name"), ["p_name"], "p_type", "category")
    return topk(top.join(m, "p_name", "left"), k, [F.desc("count_places")], ["p_name"])


@register("center_vs_other", f"""
SELECT CASE WHEN n.n_name = '{CENTRE}' THEN 'center' ELSE 'other' END AS district_group,
       COUNT(c.c_acctbal) AS n, {R('AVG(c.c_acctbal)')} AS mean_bill, {R('MEDIAN(c.c_acctbal)', 4)} AS median_bill
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1
""")
def center_vs_other(spark: SparkSession, d: str, centre: str = CENTRE) -> DataFrame:
    """Boolean district flag mapped to a label; mean and median
    bill per label."""
    t = tables(spark, d)
    nation = t("nation").select("n_nationkey", (F.col("n_name") == centre).alias("is_center"))
    j = t("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    label = F.when(F.col("is_center"), F.lit("center")).otherwise(F.lit("other"))
    j = j.withColumn("district_group", label)
    g = j.groupBy("district_group").agg(F.count("c_acctbal").alias("n"),
                                        dec_round(F.avg("c_acctbal"), 2).alias("mean_bill"))
    g = with_quantiles(g, j, ["district_group"], [("c_acctbal", 0.5, "median_bill")])
    return g.withColumn("median_bill", dec_round("median_bill", 4))


@register("bill_by_district", f"""
SELECT n.n_name AS district, COUNT(c.c_acctbal) AS n, {R('AVG(c.c_acctbal)')} AS mean_bill
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name
""")
def bill_by_district(spark: SparkSession, d: str) -> DataFrame:
    """M8: mean bill per district, highest first (sum and count per district
    key, then named)."""
    t = tables(spark, d)
    per = t("customer").groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("s"), F.count("c_acctbal").alias("n"))
    nation = t("nation").select("n_nationkey", F.col("n_name").alias("district"))
    g = (per.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("district").agg(F.sum("n").cast("bigint").alias("n"), F.sum("s").alias("s")))
    return g.select("district", "n", dec_round(ratio("s", "n"), 2).alias("mean_bill")).orderBy(F.desc("mean_bill"))


@register("contains_flag", f"""
SELECT doc_id, COALESCE(contains(text, '{NEEDLE}'), FALSE) AS has_license FROM documents
""")
def contains_flag_q(spark: SparkSession, d: str, needle: str = NEEDLE) -> DataFrame:
    """Literal substring test over whole texts, NULL -> False."""
    return tables(spark, d)("documents").select("doc_id", contains_flag("text", needle).alias("has_license"))


def _text_key(col):
    """Shuffle key for whole-text grouping: a 256-bit digest of the text
    instead of the text itself (texts run to tens of kilobytes)."""
    return F.sha2(col, 256)


@register("dup_full", """
WITH g AS (SELECT COUNT(*) AS n FROM documents GROUP BY text, lang, source, n_chars)
SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_distinct, CAST(SUM(n - 1) AS BIGINT) AS n_duplicates,
       COUNT(*) FILTER (WHERE n > 1) AS n_dup_groups
FROM g
""")
def dup_full(spark: SparkSession, d: str) -> DataFrame:
    """Full-row duplicates (all columns but the surrogate key)."""
    docs = tables(spark, d)("documents").withColumn("text_key", _text_key(F.col("text")))
    return duplicate_summary(docs, ["text_key", "lang", "source", "n_chars"])


@register("dup_subset", f"""
WITH g AS (SELECT COUNT(*) AS n FROM documents GROUP BY {SQL_NORM('text')})
SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_distinct, CAST(SUM(n - 1) AS BIGINT) AS n_duplicates,
       COUNT(*) FILTER (WHERE n > 1) AS n_dup_groups
FROM g
""")
def dup_subset(spark: SparkSession, d: str) -> DataFrame:
    """Duplicates on a key subset (the normalised text)."""
    docs = tables(spark, d)("documents").withColumn("text_key", _text_key(normalize_text("text")))
    return duplicate_summary(docs, ["text_key"])


@register("dup_rows", f"""
WITH k AS (SELECT doc_id, {SQL_NORM('text')} AS t FROM documents),
g AS (SELECT t, COUNT(*) AS group_size FROM k GROUP BY t HAVING COUNT(*) > 1)
SELECT k.doc_id, g.group_size FROM k JOIN g ON k.t IS NOT DISTINCT FROM g.t
""")
def dup_rows(spark: SparkSession, d: str) -> DataFrame:
    """every row of a duplicate group (``keep=False``)."""
    docs = tables(spark, d)("documents").select("doc_id", _text_key(normalize_text("text")).alias("text_key"))
    return duplicate_rows(docs, ["text_key"]).select("doc_id", "group_size")


@register("normalize_text", f"""
SELECT doc_id, {SQL_NORM('text')} AS text_norm FROM documents
""")
def normalize_text_q(spark: SparkSession, d: str) -> DataFrame:
    """Lower case, Unicode strip, one pass of double space -> single,
    over whole texts."""
    return tables(spark, d)("documents").select("doc_id", normalize_text("text").alias("text_norm"))


@register("csv_ingest", """
SELECT d.doc_id, d.lang, d.source, md5(d.text) AS text_md5, l.quality, l.toxic
FROM (SELECT doc_id, lang, source, NULLIF(text, '') AS text FROM documents) d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def csv_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Two CSV exports (commas and semicolons; whole texts with
    line ends, separators and quotes inside) read with declared schemas and
    left-merged. The exports are staged from the tables; an empty field is
    missing, as in pandas."""
    t = tables(spark, d)
    docs, labels = shared_path(spark, "documents-csv"), shared_path(spark, "labels-csv")
    write_csv(t("documents").select("doc_id", "text", "lang", "source"), docs)
    write_csv(t("labels").select("doc_id", "quality", "toxic"), labels, sep=";")
    left = read_csv(spark, docs, "doc_id bigint, text string, lang string, source string")
    right = read_csv(spark, labels, "doc_id bigint, quality int, toxic int", sep=";")
    left = left.select("doc_id", "lang", "source", F.md5(F.when(F.col("text") != "", F.col("text"))).alias("text_md5"))
    return left.join(right, "doc_id", "left").select("doc_id", "lang", "source", "text_md5", "quality", "toxic")


@register("clean_documents", f"""
WITH k AS (SELECT d.doc_id, d.lang, d.source, {SQL_NORM('d.text')} AS t, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
g AS (SELECT t, COUNT(*) AS n FROM k GROUP BY t)
SELECT k.doc_id, k.lang, k.source, COALESCE(k.quality, -1) AS quality, COALESCE(k.toxic, -1) AS toxic,
       CAST(length(k.t) AS BIGINT) AS text_len, g.n > 1 AS is_duplicate,
       COALESCE(contains(k.t, lower('{NEEDLE}')), FALSE) AS has_license
FROM k JOIN g ON k.t IS NOT DISTINCT FROM g.t
""")
def clean_documents(spark: SparkSession, d: str) -> DataFrame:
    """M1 end to end: left merge with the label table (J6), normalise text,
    fill missing labels, duplicate audit flag, substring flag."""
    t = tables(spark, d)
    # The text is normalised once, straight after the scan; only its digest,
    # length and flag go on, and the merged rows are written for both readers.
    text = t("documents").select("doc_id", "lang", "source", normalize_text("text").alias("t"))
    text = text.select("doc_id", "lang", "source", _text_key(F.col("t")).alias("text_key"),
                       F.length("t").cast("bigint").alias("text_len"),
                       contains_flag("t", NEEDLE.lower()).alias("has_license"))
    docs = write_once(text.join(t("labels"), "doc_id", "left"))
    sizes = docs.groupBy("text_key").agg(F.count(F.lit(1)).alias("__n"))
    return join_null_safe(docs, sizes, ["text_key"]).select(
        "doc_id", "lang", "source",
        F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic"),
        "text_len", (F.col("__n") > 1).alias("is_duplicate"), "has_license")


@register("cramers_v", """
WITH cells AS (SELECT o_orderstatus AS a, o_orderpriority AS b, COUNT(*) AS o FROM orders
               WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1, 2),
ra AS (SELECT a, SUM(o) AS ra FROM cells GROUP BY a),
rb AS (SELECT b, SUM(o) AS rb FROM cells GROUP BY b),
tot AS (SELECT SUM(o) AS n, COUNT(DISTINCT a) AS ka, COUNT(DISTINCT b) AS kb FROM cells),
grid AS (SELECT ra.a, rb.b, ra.ra, rb.rb FROM ra, rb),
chi AS (SELECT SUM((COALESCE(c.o, 0) - g.ra * g.rb / t.n) * (COALESCE(c.o, 0) - g.ra * g.rb / t.n) / (g.ra * g.rb / t.n)) AS chi2
        FROM grid g LEFT JOIN cells c ON g.a = c.a AND g.b = c.b, tot t)
SELECT """ + R("chi.chi2", 6) + """ AS chi2, CAST((t.ka - 1) * (t.kb - 1) AS BIGINT) AS dof, CAST(t.n AS BIGINT) AS n,
       """ + R("SQRT((chi.chi2 / t.n) / NULLIF(LEAST(t.ka, t.kb) - 1, 0))", 6) + """ AS cramers_v
FROM chi, tot t
""")
def cramers_v(spark: SparkSession, d: str) -> DataFrame:
    """A36 (re-aimed): association of two categorical columns."""
    return _cramers_v(tables(spark, d)("orders"), "o_orderstatus", "o_orderpriority")
