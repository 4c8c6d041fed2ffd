"""Projections, filters, joins, aggregations, windows, sorts and set operations.

All functions are lazy DataFrame transformations.  Global statistics (min,
max, counts) are computed as one-row aggregates and attached with a
broadcast of that single row, never with an un-partitioned window, so no
step funnels a whole table through one task.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df``.

    The right side is a single row by construction, so broadcasting it is
    bounded regardless of data size.
    """
    return df.crossJoin(F.broadcast(one_row))


# ---------------------------------------------------------------- P: rows

def project(df: DataFrame, cols) -> DataFrame:
    return df.select(*[_c(c) for c in cols])


def drop_cols(df: DataFrame, cols) -> DataFrame:
    return df.drop(*cols)


def where_all(df: DataFrame, conds: dict) -> DataFrame:
    """Equality predicates combined with AND (nulls never match)."""
    pred = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in conds.items()])
    return df.filter(pred)


def contains(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Rows whose ``col`` matches the regular expression; null is false."""
    return df.filter(F.coalesce(F.col(col).rlike(pattern), F.lit(False)))


def drop_null(df: DataFrame, cols) -> DataFrame:
    return df.dropna(subset=list(cols))


def cast_cols(df: DataFrame, types: dict) -> DataFrame:
    """Late cast; unparsable values become null (``try_cast``)."""
    return df.select(*[F.expr(f"try_cast(`{c}` AS {types[c]})").alias(c) if c in types
                       else F.col(c) for c in df.columns])


def label_sign(df: DataFrame, col: str, order=None, by=None, horizon: int = 0,
               name: str = "label") -> DataFrame:
    """1 if ``col >= 0`` else 0 (null gives 0).

    ``horizon=0`` labels each row by its own value (the original behaviour);
    ``horizon=1`` labels it by the next row's value within ``by`` ordered by
    ``order``.
    """
    v = F.col(col)
    if horizon:
        w = Window.partitionBy(*(by or [])).orderBy(order)
        v = F.lead(col, horizon).over(w)
    return df.withColumn(name, F.when(v >= 0, 1).otherwise(0))


def slice_rows(df: DataFrame, order, start: int, end: int, by=None) -> DataFrame:
    """Positional slice ``[start, end)`` in ``order`` (ties broken by ``order``'s
    trailing columns; pass a unique key last).  With ``by`` the slice is per
    group; WindowGroupLimit pushes ``rn <= end`` before the shuffle."""
    w = Window.partitionBy(*(by or [])).orderBy(*[_c(o) for o in order])
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter((F.col("_rn") > start) & (F.col("_rn") <= end)).drop("_rn"))


def derive(df: DataFrame, exprs: dict) -> DataFrame:
    return df.select("*", *[_c(e).alias(n) for n, e in exprs.items()])


def haversine_km(lat1, lon1, lat2, lon2, radius: float = 6371.0) -> Column:
    """Great-circle length in km between two coordinates (degrees)."""
    la1, lo1, la2, lo2 = (F.radians(_c(x)) for x in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    return F.lit(2 * radius) * F.asin(F.sqrt(a))


def haversine(df: DataFrame, lat1, lon1, lat2, lon2, name: str = "km") -> DataFrame:
    return df.withColumn(name, haversine_km(lat1, lon1, lat2, lon2))


def widen(df: DataFrame, key, name: str, value: str, names=None, fill=0) -> DataFrame:
    """Long -> wide with missing cells filled (explicit ``names`` avoids a
    separate distinct job and fixes the column order)."""
    g = df.groupBy(*([key] if isinstance(key, str) else key))
    p = g.pivot(name, names) if names is not None else g.pivot(name)
    return p.agg(F.first(value)).fillna(fill)


# ---------------------------------------------------------------- J: joins

def join_series(a: DataFrame, b: DataFrame, on="ts", how="left") -> DataFrame:
    return a.join(b, on, how)


def asof_calendar(df: DataFrame, ts: str, cols, weekday: str = "FRI",
                  series=None) -> DataFrame:
    """Weekly calendar (every ``weekday``) with the last observation at or
    before each calendar day (``asfreq('W-FRI', method='pad')``).

    Observations are first reduced to the latest one per (series, week end)
    with ``max_by`` -- a partial aggregate, so a hot series does not funnel
    raw rows into one task.  The forward fill then runs over the calendar
    (one row per week and series), whose size is bounded by the time span.
    """
    series = list(series or [])
    day = F.to_date(F.col(ts))
    week_end = F.next_day(F.date_sub(day, 1), weekday)
    red = (df.withColumn("_wk", week_end)
           .groupBy(*series, "_wk")
           .agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ts))).alias(c)
                  for c in cols]))
    bounds = df.groupBy(*series).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    cal = bounds.select(*series, F.explode(F.expr(
        f"sequence(next_day(date_sub(_lo, 1), '{weekday}'), _hi, interval 7 days)"))
        .alias("_wk"))
    w = (Window.partitionBy(*series).orderBy("_wk")
         .rowsBetween(Window.unboundedPreceding, 0))
    out = cal.join(red, series + ["_wk"], "left")
    return out.select(*series, F.col("_wk").alias("day"),
                      *[F.last(c, ignorenulls=True).over(w).alias(c) for c in cols])


def pairs(df: DataFrame, key: str, within=None) -> DataFrame:
    """Unordered pairs ``a < b`` of ``key`` values (within groups ``within``).

    Emits O(n^2) rows per group: callers must bound the group size first
    (e.g. distinct values under a filter).  Text and clustering operators
    use factorised forms instead of this.
    """
    within = list(within or [])
    a = df.select(*within, F.col(key).alias("a"))
    b = df.select(*within, F.col(key).alias("b"))
    return a.join(b, within).filter(F.col("a") < F.col("b")) if within else \
        a.join(b, F.col("a") < F.col("b"))


def param_grid(spark: SparkSession, grid: dict) -> DataFrame:
    """Cartesian product of small parameter lists (bounded by the lists)."""
    frames = [spark.createDataFrame([(v,) for v in vals], [name]) for name, vals in grid.items()]
    return reduce(lambda x, y: x.crossJoin(y), frames)


def keep_in(df: DataFrame, col: str, words: DataFrame, word_col: str = "word") -> DataFrame:
    """Rows whose value is among the words; Spark broadcasts these if they are few."""
    return df.join(words.select(F.col(word_col).alias(col)).distinct(), col, "left_semi")


def drop_in(df: DataFrame, col: str, words: DataFrame, word_col: str = "word") -> DataFrame:
    """Rows whose value is not among the words."""
    return df.join(words.select(F.col(word_col).alias(col)).distinct(), col, "left_anti")


def every_combination(*lists: DataFrame) -> DataFrame:
    """Cartesian product of the distinct rows of small tables."""
    return reduce(lambda x, y: x.crossJoin(y), [t.distinct() for t in lists])


def score_sum(tokens: DataFrame, scores: DataFrame, on: str, by, score: str = "score",
              name: str = "score") -> DataFrame:
    """Look up a score per term and sum it per ``by`` group."""
    return (tokens.join(scores.select(on, score), on)
            .groupBy(*by).agg(F.sum(score).alias(name)))


def align(pred: DataFrame, truth: DataFrame, key) -> DataFrame:
    return pred.join(truth, key)


# ---------------------------------------------------------------- A: aggregates

def stacked_value_counts(df: DataFrame, cols, type_filters=None, limit=None,
                         name: str = "value") -> DataFrame:
    """Value counts over several columns stacked into one (nulls excluded).

    ``type_filters``: optional list of ``(type_col, type_value)`` aligned with
    ``cols``; a column contributes only rows whose type matches.  The union is
    narrow, so the count runs as partial (map-side) + final aggregation.
    """
    # one pass: every row contributes an array of its (type-matching) values
    vals = []
    for i, c in enumerate(cols):
        v = F.col(c)
        if type_filters:
            tc, tv = type_filters[i]
            v = F.when(F.col(tc) == F.lit(tv), v)
        vals.append(v)
    stacked = df.select(F.explode(F.array(*vals)).alias(name)).dropna()
    out = stacked.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    out = out.orderBy(F.desc("n"), F.asc(name))
    return out.limit(limit) if limit else out


def count_by(df: DataFrame, cols, name: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def scaled_counts(df: DataFrame, cols, scale: float = 30.0, scaling: bool = True,
                  default: float = 5.0) -> DataFrame:
    """Count per key, then min-max scale the counts to ``0..scale``.

    Equal counts (max == min) give size 0 instead of a division by zero.
    """
    counts = count_by(df, cols)
    if not scaling:
        return counts.withColumn("size", F.lit(float(default)))
    mm = counts.agg(F.min("n").alias("_mn"), F.max("n").alias("_mx"))
    out = attach_row(counts, mm)
    size = F.coalesce((F.col("n") - F.col("_mn")) / F.expr("nullif(_mx - _mn, 0)")
                      * F.lit(float(scale)), F.lit(0.0))
    return out.withColumn("size", size).drop("_mn", "_mx")


def histogram(df: DataFrame, col: str, bins: int = 10, edges=None) -> DataFrame:
    """Equal-width histogram over [min, max] (last bin closed), or explicit
    ascending ``edges`` (left-closed bins, last closed).  Returns
    ``(bin, lo, hi, n)`` including empty bins."""
    spark = df.sparkSession
    x = F.col(col).cast("double")
    if edges is None:
        mm = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
        width = (F.col("_hi") - F.col("_lo")) / bins
        b = F.least(F.floor((x - F.col("_lo")) / F.expr("nullif(_hi - _lo, 0)") * bins) + 1,
                    F.lit(bins))
        b = F.coalesce(b, F.lit(1)).cast("int")
        counts = (attach_row(df.filter(x.isNotNull()), mm).select(b.alias("bin"))
                  .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
        grid = (spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
                .crossJoin(mm))
        return (grid.join(counts, "bin", "left")
                .select("bin",
                        (F.col("_lo") + (F.col("bin") - 1) * width).alias("lo"),
                        (F.col("_lo") + F.col("bin") * width).alias("hi"),
                        F.coalesce(F.col("n"), F.lit(0)).alias("n")))
    edges = [float(e) for e in edges]
    nb = len(edges) - 1
    cond = None
    for i in range(nb):
        inside = (x >= edges[i]) & ((x < edges[i + 1]) if i < nb - 1 else (x <= edges[i + 1]))
        cond = F.when(inside, i + 1) if cond is None else cond.when(inside, i + 1)
    counts = (df.select(cond.alias("bin")).dropna().groupBy("bin")
              .agg(F.count(F.lit(1)).alias("n")))
    grid = spark.createDataFrame([(i + 1, edges[i], edges[i + 1]) for i in range(nb)],
                                 "bin int, lo double, hi double")
    return (grid.join(counts, "bin", "left")
            .select("bin", "lo", "hi", F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def _exact_quantiles(df: DataFrame, cols, qs) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas / R type 7) per column.

    Values are first reduced to (column, value, multiplicity) by a partial
    aggregate; the rank walk then runs per column over distinct values.
    """
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v")) for c in cols]))
        .alias("s")).select("s.*").dropna()
    vc = stacked.groupBy("col", "v").agg(F.count(F.lit(1)).alias("m"))
    w = Window.partitionBy("col").orderBy("v")
    cum = vc.select("col", "v", (F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, 0))
                                 ).alias("hi_rank"), "m")
    cum = cum.withColumn("lo_rank", F.col("hi_rank") - F.col("m"))  # ranks lo_rank..hi_rank-1
    tot = vc.groupBy("col").agg(F.sum("m").alias("n"))
    qdf = df.sparkSession.createDataFrame([(float(q),) for q in qs], "q double")
    target = (tot.crossJoin(F.broadcast(qdf))
              .withColumn("h", F.col("q") * (F.col("n") - 1))
              .withColumn("k0", F.floor("h")).withColumn("k1", F.ceil("h")))

    def value_at(k):
        return (target.alias("t").join(cum.alias("c"), (F.col("t.col") == F.col("c.col"))
                                       & (F.col(f"t.{k}") >= F.col("c.lo_rank"))
                                       & (F.col(f"t.{k}") < F.col("c.hi_rank")))
                .select(F.col("t.col").alias("col"), F.col("t.q").alias("q"),
                        F.col("t.h").alias("h"), F.col(f"t.{k}").alias(k),
                        F.col("c.v").alias(f"v_{k}")))
    a = value_at("k0")
    b = value_at("k1").select("col", "q", "v_k1")
    return (a.join(b, ["col", "q"])
            .select("col", "q", (F.col("v_k0") + (F.col("h") - F.col("k0"))
                                 * (F.col("v_k1") - F.col("v_k0"))).alias("value")))


def describe(df: DataFrame, cols, exact: bool = True) -> DataFrame:
    """Long summary ``(col, stat, value)``: count, mean, std (sample), min,
    25%, 50%, 75%, max.  ``exact=False`` uses ``percentile_approx``."""
    stats = []
    for c in cols:
        x = F.col(c).cast("double")
        stats += [F.count(x).cast("double").alias(f"{c}|count"), F.avg(x).alias(f"{c}|mean"),
                  F.stddev_samp(x).alias(f"{c}|std"), F.min(x).alias(f"{c}|min"),
                  F.max(x).alias(f"{c}|max")]
        if not exact:
            pa = F.percentile_approx(x, [0.25, 0.5, 0.75], 100000)
            stats += [pa[0].alias(f"{c}|25%"), pa[1].alias(f"{c}|50%"), pa[2].alias(f"{c}|75%")]
    row = df.agg(*stats)
    names = row.columns
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(n.split("|")[0]).alias("col"), F.lit(n.split("|")[1]).alias("stat"),
                 F.col(f"`{n}`").cast("double").alias("value")) for n in names])).alias("s")
    ).select("s.*")
    if exact:
        q = _exact_quantiles(df, cols, [0.25, 0.5, 0.75]).select(
            "col", F.concat((F.col("q") * 100).cast("int").cast("string"), F.lit("%")).alias("stat"),
            "value")
        long = long.unionByName(q)
    return long


def corr_matrix(df: DataFrame, cols, kind: str = "corr") -> DataFrame:
    """Long correlation / sample-covariance matrix ``(i, j, value)`` from one
    pass of partial aggregates (diagonal included)."""
    fn = {"corr": F.corr, "cov": F.covar_samp}[kind]
    aggs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            if i == j:
                e = F.lit(1.0) if kind == "corr" else F.var_samp(a)
                if kind == "corr":
                    e = F.when(F.stddev_samp(a) > 0, F.lit(1.0))
            else:
                e = fn(a, b)
            aggs.append(e.alias(f"{a}|{b}"))
    row = df.agg(*aggs)
    items = []
    for n in row.columns:
        a, b = n.split("|")
        items.append(F.struct(F.lit(a).alias("i"), F.lit(b).alias("j"),
                              F.col(f"`{n}`").alias("value")))
        if a != b:
            items.append(F.struct(F.lit(b).alias("i"), F.lit(a).alias("j"),
                                  F.col(f"`{n}`").alias("value")))
    return row.select(F.explode(F.array(*items)).alias("s")).select("s.*")


def class_profile(df: DataFrame, cls: str, cols) -> DataFrame:
    """Per-class count, means and pairwise correlations of ``cols`` (long)."""
    aggs = [F.count(F.lit(1)).cast("double").alias("n|")]
    aggs += [F.avg(c).alias(f"mean|{c}") for c in cols]
    aggs += [F.corr(a, b).alias(f"corr|{a}*{b}") for a, b in combinations(cols, 2)]
    row = df.groupBy(cls).agg(*aggs)
    items = [F.struct(F.lit(n.split("|")[0]).alias("stat"), F.lit(n.split("|")[1]).alias("cols"),
                      F.col(f"`{n}`").cast("double").alias("value"))
             for n in row.columns if n != cls]
    return row.select(cls, F.explode(F.array(*items)).alias("s")).select(cls, "s.*")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long cross-tabulation ``(a, b, n)``; ``widen`` gives the wide form."""
    return count_by(df, [a, b])


def fold_summary(scores: DataFrame, by, score: str = "score") -> DataFrame:
    """Mean, population std and standard error (std / sqrt(n)) of scores."""
    return scores.groupBy(*by).agg(
        F.count(score).alias("n"), F.avg(score).alias("mean"),
        F.stddev_pop(score).alias("std"),
        (F.stddev_pop(score) / F.sqrt(F.count(score))).alias("std_err"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "cols", F.lit(len(df.columns)).cast("bigint"))


def distinct_count(df: DataFrame, col: str, by=None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.countDistinct(col).alias("n_distinct"))


def max_size(df: DataFrame, array_col: str) -> DataFrame:
    return df.agg(F.max(F.size(array_col)).alias("max_size"))


def confusion_matrix(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per-class precision, recall, F1, support plus a weighted-average row
    (class = -1).  Undefined ratios are 0, as in the usual report."""
    cm = confusion_matrix(df, y, p)
    tp = cm.filter(F.col("y") == F.col("p")).select(F.col("y").alias("cls"),
                                                     F.col("n").alias("tp"))
    sup = cm.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    pred = cm.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    t = (sup.join(pred, "cls", "full").join(tp, "cls", "left")
         .fillna(0, ["support", "predicted", "tp"]))
    prec = F.coalesce(F.col("tp") / F.expr("nullif(predicted, 0)"), F.lit(0.0))
    rec = F.coalesce(F.col("tp") / F.expr("nullif(support, 0)"), F.lit(0.0))
    t = t.select("cls", prec.alias("precision"), rec.alias("recall"), "support")
    f1 = F.coalesce(2 * F.col("precision") * F.col("recall")
                    / F.expr("nullif(precision + recall, 0)"), F.lit(0.0))
    t = t.withColumn("f1", f1)
    tot = t.agg(
        F.lit(-1).cast(t.schema["cls"].dataType).alias("cls"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("precision"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("recall"),
        F.sum("support").alias("support"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1"))
    return t.unionByName(tot)


def batched_accuracy(df: DataFrame, y: str, p: str, key: str, batch: int = 2000) -> DataFrame:
    """Accuracy per batch of ``batch`` consecutive rows in the order of ``key``
    (unique), and their mean.

    Row positions come from ``dense_index``, so no step needs a single ordered
    partition.
    """
    rows = dense_index(df.select(F.col(key).alias("_key"), y, p), "_key", "_at")
    per = (rows.groupBy(F.floor(F.col("_at") / batch).alias("batch"))
           .agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("acc")))
    return per.agg(F.count(F.lit(1)).alias("batches"), F.avg("acc").alias("mean_acc"))


# ---------------------------------------------------------------- W: windows

def _sw(series, order):
    return Window.partitionBy(*series).orderBy(order)


def lag_cols(df: DataFrame, series, order: str, cols, k: int = 1) -> DataFrame:
    w = _sw(series, order)
    return df.select("*", *[F.lag(c, k).over(w).alias(f"{c}_lag{k}") for c in cols])


def log_return(df: DataFrame, series, order: str, x: str, name="log_return") -> DataFrame:
    w = _sw(series, order)
    return df.withColumn(name, F.ln(F.try_divide(F.col(x), F.lag(x, 1).over(w))))


def seasonal_diff(df: DataFrame, series, order: str, x: str, period: int = 12,
                  name: str = "diff") -> DataFrame:
    w = _sw(series, order)
    return df.withColumn(name, F.col(x) - F.lag(x, period).over(w))


def look_back(df: DataFrame, series, order: str, x: str, k: int) -> DataFrame:
    """Supervised frame: features = previous ``k`` values, target = value."""
    w = _sw(series, order).rowsBetween(-k, -1)
    out = df.select(*series, order, F.collect_list(x).over(w).alias("features"),
                    F.col(x).alias("y"))
    return out.filter(F.size("features") == k)


def inverse_seasonal(df: DataFrame, series, pos: str, x: str, period: int = 12,
                     name: str = "level") -> DataFrame:
    """Undo a seasonal difference: running sum within each phase
    (``pos % period``), seeded by the first ``period`` original values which
    the caller puts in ``x`` at the first positions."""
    w = (Window.partitionBy(*series, F.col(pos) % period).orderBy(pos)
         .rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(name, F.sum(x).over(w))


def inverse_log_return(df: DataFrame, series, pos: str, r: str, v0: str,
                       name: str = "level") -> DataFrame:
    """``v0 * exp(cumulative sum of r)``."""
    w = _sw(series, pos).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.col(v0) * F.exp(F.sum(r).over(w)))


def knee(df: DataFrame, k: str, height: str, by=None) -> DataFrame:
    """Second difference ``h[k] - 2 h[k-1] + h[k-2]`` per row."""
    w = Window.partitionBy(*(by or [])).orderBy(k)
    return df.withColumn("d2", F.col(height) - 2 * F.lag(height, 1).over(w)
                         + F.lag(height, 2).over(w))


def top_n_in_order(df: DataFrame, by, score: str, pos: str, n: int) -> DataFrame:
    """Keep the ``n`` best rows per group by score (ties: lower ``pos``).

    ``row_number() <= n`` is planned as a WindowGroupLimit, i.e. a per-task
    top-n before the shuffle, so a huge group never moves whole.
    """
    w = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(pos))
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
            .drop("_rn"))


def centered_ma(df: DataFrame, series, order: str, x: str, period: int = 12,
                name: str = "trend") -> DataFrame:
    """2 x period centred moving average (even period), null at the ends."""
    w = _sw(series, order)
    h = period // 2
    if period % 2 == 0:
        a = F.avg(x).over(w.rowsBetween(-h, h - 1))
        b = F.avg(x).over(w.rowsBetween(-h + 1, h))
        ok = (F.count(x).over(w.rowsBetween(-h, h)) == period + 1)
        val = F.when(ok, (a + b) / 2)
    else:
        ok = F.count(x).over(w.rowsBetween(-h, h)) == period
        val = F.when(ok, F.avg(x).over(w.rowsBetween(-h, h)))
    return df.withColumn(name, val)


# ---------------------------------------------------------------- O: sorts, sets

def top(df: DataFrame, score: str, n: int, tie=None, ascending: bool = False) -> DataFrame:
    """Best ``n`` rows (TakeOrderedAndProject: per-task top-n, then merge)."""
    order = [F.asc(score) if ascending else F.desc(score)] + [F.asc(t) for t in (tie or [])]
    return df.orderBy(*order).limit(n)


def rank_models(*scores: DataFrame, ascending: bool = False) -> DataFrame:
    """Union of ``(model, score)`` frames with a dense rank."""
    u = reduce(DataFrame.unionByName, scores)
    o = F.asc("score") if ascending else F.desc("score")
    return u.withColumn("rank", F.rank().over(Window.orderBy(o)))


def concat(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def intersect_keys(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.intersect, dfs)


def distinct_keys(df: DataFrame, cols) -> DataFrame:
    return df.select(*cols).distinct()



def dense_index(df: DataFrame, order, name: str = "idx") -> DataFrame:
    """0-based position of every row in the order of ``order`` (a unique
    ordering), without funnelling the table through one task: the table is
    range-partitioned and sorted (boundaries fixed by a checkpoint), each
    partition numbers its rows, and partition offsets come from a tiny
    per-partition count table."""
    from tessera.session import cut_lineage
    order = [order] if isinstance(order, str) else list(order)
    # materialise first: range boundaries come from a sample of the input
    s = cut_lineage(cut_lineage(df).repartitionByRange(*order)
                    .withColumn("_pid", F.spark_partition_id()))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_pid", (F.sum("_c").over(Window.orderBy("_pid")) - F.col("_c"))
                         .alias("_off"))  # one row per partition
    rn = F.row_number().over(Window.partitionBy("_pid").orderBy(*order))
    return (s.withColumn("_rn", rn).join(F.broadcast(offs), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_rn") - 1).cast("bigint"))
            .drop("_pid", "_rn", "_off"))
