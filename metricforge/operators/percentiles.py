"""Exact percentiles and percentile trimming.

``quantiles`` computes exact ``percentile_cont`` / ``percentile_disc``
values without holding any group in one task and without moving the column:

Columns of few distinct values (an estimate, one aggregate for all columns)
are counted by value, and the ranks are running counts over at most as many
rows per group: one scan, nothing written. The estimate decides the way, not
the result. All other columns:

1. a mergeable rank sketch for each group (built map-side, merged in two
   levels, bounded in size) gives a bracket of values around each target
   rank;
2. one scan counts: values inside a bracket by value, all values between two
   brackets as one row. This is a few hundredths of the distinct values. It is
   written; where no group has more than ``GROUP_ROWS`` of these rows, ranks
   are running counts as above;
3. else the counts are range-partitioned by (keys, value), so a hot group is split
   over many partitions by value range, and written once, with the partition
   id, since it is read twice;
4. per (partition, key) totals -> running offsets (a window over at most
   partitions x groups rows), which locate the one or two blocks holding
   each target rank; running counts inside them give each value its rank
   interval [start, end];
5. keep only the rows whose interval holds a target rank and interpolate.

A sketch is an estimate, so the counts are checked: should a target rank lie
outside its bracket, the same steps run over the counts of all values.

The built-in ``percentile`` merges the full value -> count map of a group
in one task, so its memory grows with the group; no metric uses it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metricforge.operators.joins import join_null_safe
from metricforge.session import write_once


#: Size of a rank sketch, how far (in ranks, as a share) a bracket reaches to
#: both sides of its target, and first-level sketches of one group.
SKETCH_SIZE = 1000
REACH = 0.01
SKETCHES = 256
#: Distinct values (estimated) up to which a column is counted by value.
FEW = 4096
#: Counts of a group up to which one task runs over them.
GROUP_ROWS = 1 << 20


def _long(df: DataFrame, values: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys..., "__m", "__v"): the columns unpivoted, without NULLs."""
    return df.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(v).alias("__m"), F.col(v).cast("double").alias("__v")) for v in values]))).where(
        F.col("__v").isNotNull())


def _ranged(counts: DataFrame, gk: Sequence[str]) -> DataFrame:
    """Counts range-partitioned by (keys, value), with the partition id. The
    id is read twice downstream (offsets, running counts) and range bounds
    come from sampling, so the rows are written once."""
    return write_once(counts.repartitionByRange(*gk, "__v").withColumn("__pid", F.spark_partition_id()))


def ranged_counts(df: DataFrame, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., "__m", "__v", "__c", "__pid"): all distinct values with their
    counts (map-side combined), in ranges of (keys, column, value)."""
    gk = [*keys, "__m"]
    return _ranged(_long(df, values, keys).groupBy(*gk, "__v").agg(F.count(F.lit(1)).alias("__c")), gk)


def _brackets(long: DataFrame, gk: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys..., "__b"): for each probability, values that are likely to have
    its rank between them (none: open)."""
    sketch = F.kll_sketch_agg_double("__v", F.lit(SKETCH_SIZE))
    some = long.groupBy(*gk, F.pmod(F.spark_partition_id(), F.lit(SKETCHES)).alias("__s")).agg(sketch.alias("__k"))
    one = some.groupBy(*gk).agg(F.kll_merge_agg_double("__k").alias("__k"))
    # In a small group a bracket has to be open: it would be less than a rank.
    wide = F.kll_sketch_get_n_double("__k") * F.lit(REACH) > 3
    at = lambda rank: F.when(wide, F.kll_sketch_get_quantile_double("__k", F.lit(rank))) if 0 < rank < 1 else (
        F.lit(None).cast("double"))
    ends = [F.struct(at(float(p) - REACH).alias("lo"), at(float(p) + REACH).alias("hi")) for p in probs]
    return write_once(one.select(*gk, F.array(*ends).alias("__b")))


def bracketed_counts(df: DataFrame, values: Sequence[str], probs: Sequence[float],
                     keys: Sequence[str] = ()) -> tuple[DataFrame, int] | None:
    """Counts that are exact by value only inside the brackets of ``probs``;
    all values between two brackets are one row, under the least of them. And
    the rows of the largest group. None if a target rank lies outside its
    bracket."""
    gk = [*keys, "__m"]
    long = _long(df, values, keys).where(~F.isnan("__v"))
    brackets = _brackets(long, gk, probs)
    rows = join_null_safe(_long(df, values, keys), brackets, gk, "left")
    v = F.col("__v")
    # A group of NaN values alone has no sketch and keeps all its values.
    ends = [(F.col("__b")[i]["lo"], F.col("__b")[i]["hi"]) for i in range(len(probs))]
    inside = reduce(Column.__or__, ((lo.isNull() | (v >= lo)) & (hi.isNull() | (v <= hi)) for lo, hi in ends))
    passed = sum((F.coalesce((v > hi).cast("int"), F.lit(0)) for _, hi in ends), F.lit(0))
    rows = rows.select(*gk, v, F.when(inside, v).alias("__in"), F.when(~inside, passed).alias("__gap"))
    counts = (rows.groupBy(*gk, "__in", "__gap").agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__v"))
              .select(*gk, "__v", "__c", F.col("__in").isNotNull().alias("__exact")))
    counts = write_once(counts)
    # Ranks before, and up to the end of, each bracket.
    told = join_null_safe(counts, brackets, gk)
    sums = []
    for i in range(len(probs)):
        lo, hi = F.col("__b")[i]["lo"], F.col("__b")[i]["hi"]
        sums += [F.sum(F.when(lo.isNotNull() & (v < lo), F.col("__c")).otherwise(0)).alias(f"before{i}"),
                 F.sum(F.when(hi.isNotNull() & (v > hi), F.col("__c")).otherwise(0)).alias(f"after{i}")]
    n, miss = F.col("__n"), F.lit(False)
    for i, p in enumerate(probs):
        first = F.least(F.floor((n - 1) * F.lit(float(p))) + 1, F.greatest(F.ceil(n * F.lit(float(p))), F.lit(1)))
        last = F.ceil((n - 1) * F.lit(float(p))) + 1
        miss = miss | (first <= F.col(f"before{i}")) | (last > n - F.col(f"after{i}"))
    sums = told.groupBy(*gk).agg(F.sum("__c").cast("double").alias("__n"), F.count(F.lit(1)).alias("__rows"), *sums)
    seen = sums.agg(F.coalesce(F.max(miss), F.lit(False)).alias("miss"), F.max("__rows").alias("rows")).first()
    return None if seen["miss"] else (counts.drop("__exact"), seen["rows"] or 0)


def quantiles_long(df: DataFrame, values: Sequence[str], probs: Sequence, keys: Sequence[str] = (),
                   kind: str = "cont") -> DataFrame:
    """Exact quantiles of several columns in one distributed pass ->
    (keys..., "__m" (column name), q0, q1, ...).

    ``cont``: linear interpolation between the values at 0-based positions
    floor(p (n-1)) and ceil(p (n-1)) (``PERCENTILE_CONT``); ``disc``: the
    value at 1-based rank max(1, ceil(p n)) (``PERCENTILE_DISC``). NULL
    values are ignored; a group without values is absent (callers left-join).
    ``probs`` items may be ``(p, kind)`` pairs to mix both kinds in one pass.
    """
    keys, values = list(keys), list(dict.fromkeys(values))
    probs = [p if isinstance(p, tuple) else (p, kind) for p in probs]
    seen = df.agg(*[F.approx_count_distinct(F.col(x).cast("double")).alias(f"c{i}") for i, x in enumerate(values)]).first()
    few = [x for i, x in enumerate(values) if seen[i] <= FEW]
    many = [x for x in values if x not in few]
    parts = [f(df, columns, probs, keys) for f, columns in ((_of_few, few), (_of_many, many)) if columns]
    return reduce(DataFrame.unionByName, parts)


def _ranks(n: Column, p: float, kind: str) -> tuple[Column, Column, Column]:
    """1-based target ranks (lower, upper) and the 0-based position between
    them among ``n`` values."""
    if kind == "cont":
        pos = (n - 1).cast("double") * F.lit(float(p))
        return (F.floor(pos) + 1).cast("bigint"), (F.ceil(pos) + 1).cast("bigint"), pos
    if kind == "disc":
        rank = F.greatest(F.ceil(n.cast("double") * F.lit(float(p))), F.lit(1)).cast("bigint")
        return rank, rank, F.lit(0.0)
    raise ValueError(kind)


def _between(vl: Column, vh: Column, pos: Column, lo: Column, hi: Column) -> Column:
    # Same interpolation as Spark's exact percentile: (hi - pos) * vl + (pos - lo) * vh.
    return F.when((lo == hi) | (vl == vh), vl).otherwise(((hi - 1) - pos) * vl + (pos - (lo - 1)) * vh)


def _of_few(df: DataFrame, values: Sequence[str], probs: Sequence, keys: Sequence[str]) -> DataFrame:
    """``quantiles_long`` by counting every value; a group has few."""
    gk = [*keys, "__m"]
    return _picked(_long(df, values, keys).groupBy(*gk, "__v").agg(F.count(F.lit(1)).alias("__c")), gk, probs)


def _picked(counts: DataFrame, gk: Sequence[str], probs: Sequence) -> DataFrame:
    """The quantiles of ``counts(gk..., __v, __c)`` by running counts over a
    group's rows."""
    group = W.partitionBy(*gk)
    upto = group.orderBy("__v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = counts.withColumns({"__n": F.sum("__c").over(group), "__end": F.sum("__c").over(upto)})
    aggs = []
    for i, (p, kind) in enumerate(probs):
        lo, hi, _ = _ranks(F.col("__n"), p, kind)
        for name, rank in (("vl", lo), ("vh", hi)):
            held = (rank > F.col("__end") - F.col("__c")) & (rank <= F.col("__end"))
            aggs.append(F.max(F.when(held, F.col("__v"))).alias(f"{name}{i}"))
    per = ranked.groupBy(*gk).agg(F.max("__n").alias("__n"), *aggs)
    outs = []
    for i, (p, kind) in enumerate(probs):
        lo, hi, pos = _ranks(F.col("__n"), p, kind)
        outs.append(_between(F.col(f"vl{i}"), F.col(f"vh{i}"), pos, lo, hi).alias(f"q{i}"))
    return per.select(*gk, *outs)


def _of_many(df: DataFrame, values: Sequence[str], probs: Sequence, keys: Sequence[str]) -> DataFrame:
    """``quantiles_long`` by sketch, brackets and ranges."""
    gk = [*keys, "__m"]
    found = bracketed_counts(df, values, sorted({p for p, _ in probs}), keys)
    if found and found[1] <= GROUP_ROWS:
        return _picked(found[0], gk, probs)
    ranged = _ranged(found[0], gk) if found else ranged_counts(df, values, keys)
    # Per (partition, group) block: row count, rows before it in the group
    # (offset) and the group size. At most partitions x groups rows.
    totals = ranged.groupBy("__pid", *gk).agg(F.sum("__c").alias("__t"))
    before = W.partitionBy(*gk).orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)
    blocks = (totals.withColumn("__off", F.coalesce(F.sum("__t").over(before), F.lit(0)))
                    .withColumn("__n", F.sum("__t").over(W.partitionBy(*gk))))
    targets = []
    for i, (p, kind) in enumerate(probs):
        lo, hi, pos = _ranks(F.col("__n"), p, kind)
        targets.append(F.struct(F.lit(i).alias("i"), lo.alias("lo"), hi.alias("hi"), pos.alias("pos")))
    first, last = F.col("__off") + 1, F.col("__off") + F.col("__t")
    # The target ranks of each group fall into at most two blocks per
    # probability: only those blocks are read again.
    tgt = (blocks.select("__pid", *gk, "__off", F.explode(F.array(*targets)).alias("t"))
                 .where(F.col("t.lo").between(first, last) | F.col("t.hi").between(first, last))
                 .select("__pid", *gk, "__off", "t.i", "t.lo", "t.hi", "t.pos"))
    wanted = join_null_safe(ranged, tgt.select("__pid", *gk), ["__pid", *gk], "left_semi")
    inside = W.partitionBy("__pid", *gk).orderBy("__v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = join_null_safe(wanted.withColumn("__cum", F.sum("__c").over(inside)), tgt, ["__pid", *gk])
    end = F.col("__off") + F.col("__cum")
    start = end - F.col("__c") + 1
    in_lo = (F.col("lo") >= start) & (F.col("lo") <= end)
    in_hi = (F.col("hi") >= start) & (F.col("hi") <= end)
    hits = ranked.where(in_lo | in_hi)
    # At most two hit rows per (group, probability): one aggregate picks the
    # values at the two ranks, then the interpolation is a projection.
    aggs = []
    for i in range(len(probs)):
        mine = F.col("i") == i
        aggs += [F.max(F.when(mine & in_lo, F.col("__v"))).alias(f"vl{i}"),
                 F.max(F.when(mine & in_hi, F.col("__v"))).alias(f"vh{i}"),
                 F.max(F.when(mine, F.col("pos"))).alias(f"pos{i}"),
                 F.max(F.when(mine, F.col("lo"))).alias(f"lo{i}"),
                 F.max(F.when(mine, F.col("hi"))).alias(f"hi{i}")]
    per = hits.groupBy(*gk).agg(*aggs)
    outs = []
    for i in range(len(probs)):
        vl, vh, pos, lo, hi = (F.col(f"{x}{i}") for x in ("vl", "vh", "pos", "lo", "hi"))
        outs.append(_between(vl, vh, pos, lo, hi).alias(f"q{i}"))
    return per.select(*gk, *outs)


def quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (),
              kind: str = "cont", names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles of one column per group -> (keys..., names...)."""
    names = list(names or [f"q{i}" for i in range(len(probs))])
    q = quantiles_long(df, [value], probs, keys, kind)
    return q.select(*keys, *[F.col(f"q{i}").alias(nm) for i, nm in enumerate(names)])


def with_quantiles(grouped: DataFrame, src: DataFrame, keys: Sequence[str], specs) -> DataFrame:
    """Attach exact quantiles of ``src`` to a grouped frame (one row per
    key). ``specs``: (value, p, name[, kind]); all columns of one kind share
    one distributed pass. Keys match null-safely."""
    keys = list(keys)
    by_kind: dict[str, list] = {}
    for sp in specs:
        kind = sp[3] if len(sp) > 3 else "cont"
        by_kind.setdefault(kind, []).append(sp[:3])
    out = grouped
    for kind, items in by_kind.items():
        values = sorted({v for v, _, _ in items})
        probs = sorted({p for _, p, _ in items})
        q = quantiles_long(src, values, probs, keys, kind)
        wide = q.groupBy(*keys).agg(*[
            F.max(F.when(F.col("__m") == v, F.col(f"q{probs.index(p)}"))).alias(n) for v, p, n in items])
        out = join_null_safe(out, wide, keys, "left") if keys else out.withColumns(_one_row(wide))
    return out


def _one_row(row: DataFrame) -> dict[str, Column]:
    """The columns of a frame with one row as literals: a few numbers, which
    then reach the scans as filters, and which no reader works out again."""
    found = row.first()
    return {c: F.lit(found[c]).cast("double") for c in row.columns}


def quantile_scalars(df: DataFrame, value: str, probs: Sequence[float], kind: str = "cont") -> list[Column]:
    """Global exact quantiles as literals (NULL without values)."""
    names = [f"q{i}" for i in range(len(probs))]
    one = _one_row(quantiles(df, value, probs, (), kind).agg(*[F.max(n).alias(n) for n in names]))
    return [one[n] for n in names]


@dataclass(frozen=True)
class Limit:
    """One trimming rule: ``column < limit`` (``upper``) or ``column > limit``
    with the limit a percentile over the reference table."""
    column: str
    p: float
    kind: str = "cont"          # "cont" | "disc"
    upper: bool = True          # keep values strictly below (True) / above (False)
    keep_null: bool = True      # F4: NULL passes the guard
    name: str | None = None

    @property
    def alias(self) -> str:
        return self.name or f"{self.column}_{'hi' if self.upper else 'lo'}_limit"


def trim_condition(rules: Sequence[Limit], limits: dict | None = None) -> Column:
    """Null-preserving guards; ``limits`` maps a rule alias to a Column
    (scalar subquery), default: a column of that name."""
    lim = (lambda r: limits[r.alias]) if limits else (lambda r: F.col(r.alias))
    cond = None
    grouped: dict[str, list[Limit]] = {}
    for r in rules:
        grouped.setdefault(r.column, []).append(r)
    for col, rs in grouped.items():
        inner = None
        for r in rs:
            t = (F.col(col) < lim(r)) if r.upper else (F.col(col) > lim(r))
            inner = t if inner is None else inner & t
        if all(r.keep_null for r in rs):
            inner = inner | F.col(col).isNull()
        cond = inner if cond is None else cond & inner
    return cond


def limit_scalars(ref: DataFrame, rules: Sequence[Limit]) -> dict:
    """Each limit as a literal. All limits share one distributed quantile
    pass over ``ref`` (columns unpivoted, both kinds together), pivoted into
    one row."""
    values = sorted({r.column for r in rules})
    probs = sorted({(r.p, r.kind) for r in rules})
    q = quantiles_long(ref, values, probs, ())
    row = q.agg(*[F.max(F.when(F.col("__m") == r.column, F.col(f"q{probs.index((r.p, r.kind))}"))).alias(r.alias)
                  for r in rules])
    return _one_row(row)


def trim_percentile(df: DataFrame, rules: Sequence[Limit], ref: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` inside all limits; limits come from ``ref`` (default:
    ``df`` itself, H7: all rows before any other filter). Strict comparisons,
    NULL passes where ``keep_null``."""
    lims = limit_scalars(ref if ref is not None else df, rules)
    return df.where(trim_condition(rules, lims))
