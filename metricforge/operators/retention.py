"""Day-N retention.

Inputs are reduced first: activity to distinct (user, day) pairs, new users
to distinct (first_date, user) pairs (U1). That bounds the self-join: a
user with a million events contributes one row per active day, so a hot
user is no longer a hot key. The join is an equality on the user plus a
residual ``day >= first_date``; the day cut (``< max_day + 1``) is part of
the join condition, so only pairs inside the window are produced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metricforge.functions.numeric import dec_round, ratio


def day_pairs(df: DataFrame, user: str, ts: str, day: str = "log_date") -> DataFrame:
    """Distinct (user, day) activity pairs."""
    return df.select(F.col(user).alias("user_id"), F.to_date(F.col(ts)).alias(day)).distinct()


def first_dates(pairs: DataFrame, day: str = "log_date") -> DataFrame:
    """First activity day per user (the source table carries it as a column)."""
    return pairs.groupBy("user_id").agg(F.min(day).alias("first_date"))


def retention(new_users: DataFrame, active: DataFrame, max_day: int = 7,
              cohort: bool = False, period: str = "day", scale: int = 2) -> DataFrame:
    """``new_users(user_id, first_date)``, ``active(user_id, log_date)`` ->
    (cohort?, day_no, users, share).

    ``period="month"``: both dates are month starts and the offset counts
    months (the cohort view when repeat activity within a week is rare).
    Rate = users at offset d / running maximum of users over offsets <= d
    (H21, the code's base). The window runs on at most
    (cohorts x (max_day + 1)) grouped rows."""
    n = new_users.select("user_id", "first_date").distinct().alias("n")
    a = active.select("user_id", "log_date").distinct().alias("a")
    first, log = F.col("n.first_date"), F.col("a.log_date")
    if period == "day":
        upper = F.date_add(first, max_day + 1)
        offset = F.datediff(log, first)
    elif period == "month":
        upper = F.add_months(first, max_day + 1)
        offset = F.months_between(log, first).cast("int")
    else:
        raise ValueError(period)
    cond = (F.col("n.user_id") == F.col("a.user_id")) & (log >= first) & (log < upper)
    j = n.join(a, cond, "inner").select(
        F.col("n.user_id").alias("user_id"), first.alias("first_date"),
        offset.alias("day_no"))
    keys = ["day_no"]
    if cohort:
        j = j.withColumn("cohort", F.trunc("first_date", "MM"))
        keys = ["cohort", "day_no"]
    g = j.groupBy(*keys).agg(F.countDistinct("user_id").alias("users"))
    w = W.partitionBy("cohort") if cohort else W.partitionBy()
    w = w.orderBy("day_no")
    return g.withColumn(
        "share",
        dec_round(ratio(F.col("users"), F.max("users").over(w)), scale))


def retention_from_activity(activity: DataFrame, user: str, day: str, max_day: int = 7,
                            first_from=None, first_to=None, log_from=None, log_to=None,
                            cohort: bool = False, period: str = "day", scale: int = 2) -> DataFrame:
    """Day-N (or month-N) retention when the first day is the user's first
    activity (the driver data carries no first-visit column).

    One aggregate per user collects the sorted set of active days, combined
    map-side, so a user with millions of events ships one small array per
    task and the array is bounded by the number of distinct days. The first
    day is the array's head, and exploding the array gives (user, first, day)
    rows without the self-join, its extra shuffles, or a second pass for
    first dates. Each user has one first day, so counting rows per offset
    counts distinct users. Windows are inclusive; a bound left as None is
    open."""
    per_user = (activity.select(F.col(user).alias("user_id"), F.col(day).alias("d"))
                .where(F.col("d").isNotNull())
                .groupBy("user_id").agg(F.array_sort(F.collect_set("d")).alias("days")))
    x = per_user.select("user_id", F.col("days")[0].alias("first_date"), F.explode("days").alias("log_date"))
    if first_from is not None:
        x = x.where(F.col("first_date") >= F.lit(first_from).cast("date"))
    if first_to is not None:
        x = x.where(F.col("first_date") <= F.lit(first_to).cast("date"))
    if log_from is not None:
        x = x.where(F.col("log_date") >= F.lit(log_from).cast("date"))
    if log_to is not None:
        x = x.where(F.col("log_date") <= F.lit(log_to).cast("date"))
    if period == "day":
        offset = F.datediff("log_date", "first_date")
    elif period == "month":
        offset = F.months_between("log_date", "first_date").cast("int")
    else:
        raise ValueError(period)
    x = x.withColumn("day_no", offset).where(F.col("day_no") <= max_day)
    keys = ["day_no"]
    if cohort:
        x = x.withColumn("cohort", F.trunc("first_date", "MM"))
        keys = ["cohort", "day_no"]
    g = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("users"))
    w = (W.partitionBy("cohort") if cohort else W.partitionBy()).orderBy("day_no")
    return g.withColumn(
        "share",
        dec_round(ratio(F.col("users"), F.max("users").over(w)), scale))
