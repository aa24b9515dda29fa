"""Talk dashboard (M36: A37, A38, A39, O8, F16, F17, J13) on the driver
tables. The source is a BI dashboard described in prose; its charts are
re-expressed as parameterised queries.

Mapping: country -> region, conference -> nation, speaker -> customer
(occupation -> market segment), talk -> order (views -> total price,
tag -> order priority, date -> order date), talk topic -> part name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metricforge.functions.calendar import month_start
from metricforge.functions.numeric import dec_round, money, ratio
from metricforge.operators.aggregates import topk
from metricforge.operators.distinct_cube import build_cube, count_cube, numbered, roll_up
from metricforge.operators.heavy import top_values
from metricforge.plans.common import MONEY, R, RATIO, register, tables
from metricforge.session import write_once
from metricforge.sources.layout import lookup, sorted_copy

CARD_KEY = 7
FILTER_COUNTRY, FILTER_TAG = "ASIA", "1-URGENT"
FILTER_FROM, FILTER_TO = "1996-01-01", "1996-12-31"


def geo(spark: SparkSession, d: str) -> DataFrame:
    """Conference (nation) with its country (region)."""
    t = tables(spark, d)
    return (t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", F.col("n_name").alias("conference"), F.col("r_name").alias("country")))


def talks(spark: SparkSession, d: str) -> DataFrame:
    """Talks with speaker, conference and country (dimension joins on a
    small nation/region chain; the speaker join is on the customer key)."""
    t = tables(spark, d)
    spk = t("customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("occupation"))
    o = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    return (o.join(spk, F.col("o_custkey") == F.col("c_custkey"))
             .join(geo(spark, d), F.col("c_nationkey") == F.col("n_nationkey")))


SQL_TALKS = """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderpriority, o.o_orderdate,
       c.c_mktsegment AS occupation, n.n_name AS conference, r.r_name AS country
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


@register("rollup_country_conf", f"""
SELECT country, conference, GROUPING_ID(country, conference) AS gid,
       COUNT(*) AS n_talks, COUNT(DISTINCT o_custkey) AS n_speakers,
       {R(RATIO('SUM(' + MONEY('o_totalprice') + ')', 'COUNT(*)'))} AS avg_views,
       MAX(o_totalprice) AS max_views, {R('SUM(' + MONEY('o_totalprice') + ')')} AS total_views
FROM ({SQL_TALKS}) t
GROUP BY ROLLUP (country, conference)
""")
def rollup_country_conf(spark: SparkSession, d: str) -> DataFrame:
    """Country -> conference drill-down with subtotals (ROLLUP).

    Talks are reduced to one row per (country, conference, speaker) before
    the rollup: the rollup's row expansion then runs on speakers, not talks,
    and the speaker count becomes a plain row count (a speaker belongs to
    one conference)."""
    t = tables(spark, d)
    # Talks reduced per speaker before the speaker and geography joins.
    per_spk = t("orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("s"), F.max("o_totalprice").alias("mx"))
    per = (per_spk.join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
                  .join(geo(spark, d), F.col("c_nationkey") == F.col("n_nationkey")))
    g = per.rollup("country", "conference").agg(
        F.grouping_id().alias("gid"), F.sum("n").alias("n_talks"), F.count(F.lit(1)).alias("n_speakers"),
        F.sum("s").alias("s"), F.max("mx").alias("max_views"))
    return g.select("country", "conference", "gid", "n_talks", "n_speakers",
                    dec_round(ratio("s", "n_talks"), 2).alias("avg_views"), "max_views",
                    dec_round("s", 2).alias("total_views"))


@register("dashboard_counters", """
SELECT (SELECT COUNT(DISTINCT n_name) FROM nation) AS n_conferences,
       (SELECT COUNT(*) FROM orders) AS n_talks,
       (SELECT COUNT(DISTINCT o_custkey) FROM orders) AS n_speakers,
       (SELECT COUNT(DISTINCT o_orderpriority) FROM orders) AS n_tags
""")
def dashboard_counters(spark: SparkSession, d: str) -> DataFrame:
    """Top-level counters. Each distinct count is its own two-phase
    aggregate (scalar subquery) instead of several DISTINCTs in one
    aggregate, which would expand every row once per distinct column."""
    t = tables(spark, d)
    o = t("orders")
    # COUNT(DISTINCT x) ignores NULL: filter before the distinct.
    distinct_count = lambda df, c: df.where(F.col(c).isNotNull()).select(c).distinct().agg(F.count(F.lit(1))).scalar()
    # All conferences, also those without talks.
    n_conf = distinct_count(t("nation"), "n_name")
    n_talks = o.agg(F.count(F.lit(1))).scalar()
    n_spk = distinct_count(o, "o_custkey")
    n_tags = distinct_count(o, "o_orderpriority")
    return spark.range(1).select(n_conf.alias("n_conferences"), n_talks.alias("n_talks"),
                                 n_spk.alias("n_speakers"), n_tags.alias("n_tags"))


@register("dashboard_topn", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def dashboard_topn(spark: SparkSession, d: str, k: int = 10) -> DataFrame:
    """Top talks by a measure (tie-break: key)."""
    o = tables(spark, d)("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return topk(o, k, [F.desc_nulls_last("o_totalprice")], ["o_orderkey"])


@register("dashboard_top_tags", """
SELECT p.p_name AS tag, COUNT(*) AS n_talks
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_name ORDER BY n_talks DESC, tag LIMIT 20
""")
def dashboard_top_tags(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    """The twenty most used tags. Lines are counted per part key first
    (map-side), then named, so the part join sees one row per part."""
    t = tables(spark, d)
    per_part = t("lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    g = (per_part.join(t("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
                 .groupBy(F.col("p_name").alias("tag")).agg(F.sum("n").cast("bigint").alias("n_talks")))
    return topk(g, k, [F.desc("n_talks")], ["tag"])


@register("dashboard_filtered", f"""
SELECT o_orderkey, conference, o_orderpriority, o_totalprice
FROM ({SQL_TALKS}) t
WHERE country = '{FILTER_COUNTRY}' AND o_orderpriority = '{FILTER_TAG}'
  AND o_orderdate >= TIMESTAMP '{FILTER_FROM} 00:00:00' AND o_orderdate < TIMESTAMP '{FILTER_TO} 00:00:00' + INTERVAL 1 DAY
""")
def dashboard_filtered(spark: SparkSession, d: str, country: str | None = FILTER_COUNTRY,
                       conference: str | None = None, tag: str | None = FILTER_TAG,
                       date_from: str | None = FILTER_FROM, date_to: str | None = FILTER_TO) -> DataFrame:
    """F16: the dashboard selectors; every argument is optional (None = no
    filter). Date bounds are ranges on the raw column (pushed to the scan)."""
    x = talks(spark, d)
    if country is not None:
        x = x.where(F.col("country") == country)
    if conference is not None:
        x = x.where(F.col("conference") == conference)
    if tag is not None:
        x = x.where(F.col("o_orderpriority") == tag)
    if date_from is not None:
        x = x.where(F.col("o_orderdate") >= F.lit(f"{date_from} 00:00:00").cast("timestamp_ntz"))
    if date_to is not None:
        x = x.where(F.col("o_orderdate") < F.date_add(F.lit(date_to).cast("date"), 1).cast("timestamp_ntz"))
    return x.select("o_orderkey", "conference", "o_orderpriority", "o_totalprice")


@register("dashboard_card", f"""
SELECT o.o_orderkey, o.o_totalprice, o.o_orderpriority, c.c_name AS speaker, c.c_mktsegment AS occupation,
       n.n_name AS conference
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderkey = {CARD_KEY}
""")
def dashboard_card(spark: SparkSession, d: str, key: int = CARD_KEY) -> DataFrame:
    """one talk by key with its speaker and conference (left joins)."""
    t = tables(spark, d)
    o = t("orders").where(F.col("o_orderkey") == key)
    c = t("customer").select("c_custkey", F.col("c_name").alias("speaker"),
                             F.col("c_mktsegment").alias("occupation"), "c_nationkey")
    n = t("nation").select("n_nationkey", F.col("n_name").alias("conference"))
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return j.select("o_orderkey", "o_totalprice", "o_orderpriority", "speaker", "occupation", "conference")


@register("dashboard_card_sorted", f"""
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey = {CARD_KEY}
""")
def dashboard_card_sorted(spark: SparkSession, d: str, key: int = CARD_KEY) -> DataFrame:
    """the talk of a card from a copy sorted by key: one row group of the
    whole table is read."""
    path = sorted_copy(tables(spark, d)("orders"), "o_orderkey", bloom=["o_custkey"])
    return lookup(spark, path, "o_orderkey", key).select("o_orderkey", "o_totalprice", "o_orderpriority")


@register("conference_talks", """
SELECT n.n_name AS conference, COUNT(t.o_orderkey) AS n_talks
FROM nation n LEFT JOIN (SELECT o.o_orderkey, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) t
  ON n.n_nationkey = t.c_nationkey
GROUP BY n.n_name
""")
def conference_talks(spark: SparkSession, d: str) -> DataFrame:
    """Every conference with its number of talks, conferences without
    talks kept with 0. Talks are counted per conference key first, then
    left-joined to the conference list."""
    t = tables(spark, d)
    per = (t("orders").join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
           .groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")))
    j = t("nation").join(per, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return (j.groupBy(F.col("n_name").alias("conference"))
             .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_talks")))


CUBE_DIMS = ["country", "conference", "tag", "month"]
CUBE_LEVELS = [[x for i, x in enumerate(CUBE_DIMS) if not n >> (3 - i) & 1] for n in range(16)]


def talk_cube(spark: SparkSession, d: str) -> DataFrame:
    """The dashboard's cube: a cell for each (country, conference, tag, month)
    with its talks, views and the bitmaps of its speakers. Speakers are
    numbered by conference; written once, it answers every selection."""
    t = tables(spark, d)
    speakers = (t("customer").select("c_custkey", "c_nationkey").join(geo(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))
                .select("country", "conference", "c_custkey"))
    speakers = numbered(speakers, ["country", "conference", "c_custkey"], "speaker_no")
    o = t("orders").select("o_custkey", F.col("o_orderpriority").alias("tag"), month_start("o_orderdate").alias("month"),
                           money("o_totalprice").alias("views"))
    facts = o.join(speakers, F.col("o_custkey") == F.col("c_custkey"))
    return write_once(build_cube(facts, CUBE_DIMS, "speaker_no", {"n_talks": F.lit(1), "views": F.col("views")}))


SQL_CUBE_TALKS = f"""
SELECT country, conference, o_orderpriority AS tag, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month, o_custkey,
       {MONEY('o_totalprice')} AS views
FROM ({SQL_TALKS}) t
"""


@register("dashboard_cube", f"""
SELECT country, conference, tag, month, GROUPING_ID(country, conference, tag, month) AS gid,
       COUNT(DISTINCT o_custkey) AS n_speakers, COUNT(*) AS n_talks, {R('SUM(views)')} AS total_views
FROM ({SQL_CUBE_TALKS}) c GROUP BY CUBE (country, conference, tag, month)
""")
def dashboard_cube(spark: SparkSession, d: str) -> DataFrame:
    """Distinct speakers, talks and views at all sixteen levels of
    (country, conference, tag, month), from the cube's bitmaps."""
    out = roll_up(talk_cube(spark, d), CUBE_DIMS, CUBE_LEVELS, ["n_talks", "views"], "n_speakers")
    return out.select(*CUBE_DIMS, "gid", "n_speakers", "n_talks", dec_round("views", 2).alias("total_views"))


@register("dashboard_selected", f"""
SELECT conference, COUNT(DISTINCT o_custkey) AS n_speakers, COUNT(*) AS n_talks
FROM ({SQL_CUBE_TALKS}) c
WHERE country = '{FILTER_COUNTRY}' AND tag <> '{FILTER_TAG}' AND month BETWEEN DATE '{FILTER_FROM}' AND DATE '{FILTER_TO}'
GROUP BY conference
""")
def dashboard_selected(spark: SparkSession, d: str, country: str = FILTER_COUNTRY, tag: str = FILTER_TAG,
                       first: str = FILTER_FROM, last: str = FILTER_TO) -> DataFrame:
    """The counters of any selection by conference, from the cube:
    here one country, all tags but one, the months of a window."""
    chosen = ((F.col("country") == country) & (F.col("tag") != tag)
              & F.col("month").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return count_cube(talk_cube(spark, d), ["conference"], ["n_talks"], "n_speakers", chosen)


@register("top_tags_exact", """
SELECT l_partkey AS part, COUNT(*) AS n_talks FROM lineitem GROUP BY l_partkey ORDER BY n_talks DESC, part LIMIT 20
""")
def top_tags_exact(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    """The parts with most lines, none far ahead: bucket totals bound
    little, and nearly all parts are counted."""
    lines = tables(spark, d)("lineitem").select(F.col("l_partkey").alias("part"))
    return top_values(lines, "part", k, "n_talks")


@register("top_words", """
SELECT word, COUNT(*) AS n
FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) w
GROUP BY word ORDER BY n DESC, word LIMIT 20
""")
def top_words(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    """The most frequent words of all texts, of very many: only
    the words of a few buckets are counted one by one."""
    words = tables(spark, d)("documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("word"))
    return top_values(words, "word", k)


@register("dashboard_top_by_sum", f"""
SELECT occupation, {R('SUM(' + MONEY('o_totalprice') + ')')} AS total_views,
       RANK() OVER (ORDER BY SUM({MONEY('o_totalprice')}) DESC) AS rank
FROM (SELECT o.o_totalprice, c.c_mktsegment AS occupation
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) t
GROUP BY occupation
""")
def dashboard_top_by_sum(spark: SparkSession, d: str) -> DataFrame:
    """Occupations ranked by a summed measure. The rank window runs on
    the grouped rows (one per occupation)."""
    t = tables(spark, d)
    per_spk = t("orders").groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("s"))
    j = per_spk.join(t("customer").select("c_custkey", F.col("c_mktsegment").alias("occupation")),
                     F.col("o_custkey") == F.col("c_custkey"))
    g = j.groupBy("occupation").agg(F.sum("s").alias("s"))
    return g.select("occupation", dec_round("s", 2).alias("total_views"),
                    F.rank().over(W.orderBy(F.desc("s"))).cast("bigint").alias("rank"))
