"""Registered queries for rows, joins, aggregates, windows, sorts (P/J/A/W/O)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import relational as R
from tessera.plans.catalog import query
from tessera.plans.views_sql import with_views
from tessera.sources import tables as T


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ------------------------------------------------------------------ A1..A15

@query("A1_stacked_value_counts", with_views(["actor_events"], """
SELECT value, count(*) AS n FROM (
  SELECT actor1_type AS value FROM actor_events
  UNION ALL SELECT actor2_type FROM actor_events) t
WHERE value IS NOT NULL GROUP BY value ORDER BY n DESC, value"""))
def a1(spark, sf):
    return R.stacked_value_counts(T.actor_events(spark, sf), ["actor1_type", "actor2_type"])


@query("A2_typed_value_counts_top20", with_views(["actor_events"], """
SELECT value, count(*) AS n FROM (
  SELECT actor1_country AS value FROM actor_events WHERE actor1_type = 'BUILDING'
  UNION ALL SELECT actor2_country FROM actor_events WHERE actor2_type = 'N') t
WHERE value IS NOT NULL GROUP BY value ORDER BY n DESC, value LIMIT 20"""))
def a2(spark, sf):
    return R.stacked_value_counts(
        T.actor_events(spark, sf), ["actor1_country", "actor2_country"],
        type_filters=[("actor1_type", "BUILDING"), ("actor2_type", "N")], limit=20)


@query("A3_count_by_coordinates", with_views(["actor_events"], """
SELECT lat1, long1, lat2, long2, count(*) AS n FROM actor_events GROUP BY 1, 2, 3, 4"""))
def a3(spark, sf):
    return R.count_by(T.actor_events(spark, sf), ["lat1", "long1", "lat2", "long2"])


@query("A4_scaled_counts", with_views(["actor_events"], """
WITH c AS (SELECT long1, lat1, quad_class, count(*) AS n FROM actor_events GROUP BY 1, 2, 3),
mm AS (SELECT min(n) AS mn, max(n) AS mx FROM c)
SELECT long1, lat1, quad_class, n,
       round(coalesce((n - mn) / nullif(mx - mn, 0) * 30.0, 0.0), 6) AS size
FROM c, mm"""))
def a4(spark, sf):
    out = R.scaled_counts(T.actor_events(spark, sf), ["long1", "lat1", "quad_class"])
    return out.withColumn("size", r6("size"))


@query("A5_histogram_equal_width", """
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CAST(coalesce(least(floor((l_extendedprice - lo) / nullif(hi - lo, 0) * 10) + 1,
                                 10), 1) AS INTEGER) AS bin
      FROM lineitem, mm WHERE l_extendedprice IS NOT NULL),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
g AS (SELECT CAST(i AS INTEGER) AS bin FROM range(1, 11) t(i))
SELECT g.bin, round(lo + (g.bin - 1) * (hi - lo) / 10, 6) AS lo,
       round(lo + g.bin * (hi - lo) / 10, 6) AS hi, coalesce(c.n, 0) AS n
FROM g CROSS JOIN mm LEFT JOIN c ON g.bin = c.bin""")
def a5(spark, sf):
    h = R.histogram(T.table(spark, sf, "lineitem"), "l_extendedprice", bins=10)
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


@query("A5_histogram_edges", """
WITH b AS (SELECT CASE WHEN l_quantity >= 0 AND l_quantity < 10 THEN 1
                       WHEN l_quantity >= 10 AND l_quantity < 20 THEN 2
                       WHEN l_quantity >= 20 AND l_quantity < 30 THEN 3
                       WHEN l_quantity >= 30 AND l_quantity < 40 THEN 4
                       WHEN l_quantity >= 40 AND l_quantity <= 50 THEN 5 END AS bin
           FROM lineitem),
c AS (SELECT bin, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY bin),
g AS (SELECT * FROM (VALUES (1, 0.0, 10.0), (2, 10.0, 20.0), (3, 20.0, 30.0),
                            (4, 30.0, 40.0), (5, 40.0, 50.0)) t(bin, lo, hi))
SELECT CAST(g.bin AS INTEGER) AS bin, CAST(g.lo AS DOUBLE) AS lo, CAST(g.hi AS DOUBLE) AS hi,
       coalesce(c.n, 0) AS n
FROM g LEFT JOIN c ON g.bin = c.bin""")
def a5b(spark, sf):
    return R.histogram(T.table(spark, sf, "lineitem"), "l_quantity",
                       edges=[0, 10, 20, 30, 40, 50])


_DESC_COLS = ["f1", "f3", "f4", "f5"]


def _describe_sql():
    parts = []
    for c in _DESC_COLS:
        for stat, e in [("count", f"CAST(count({c}) AS DOUBLE)"), ("mean", f"CAST(sum(CAST({c} AS DECIMAL(38,12))) AS DOUBLE) / count({c})"),
                        ("std", f"stddev_samp({c})"), ("min", f"min({c})"),
                        ("max", f"max({c})"), ("25%", f"quantile_cont({c}, 0.25)"),
                        ("50%", f"quantile_cont({c}, 0.5)"), ("75%", f"quantile_cont({c}, 0.75)")]:
            parts.append(f"SELECT '{c}' AS col, '{stat}' AS stat, round({e}, 6) AS value "
                         f"FROM numeric6")
    return with_views(["numeric6"], "\nUNION ALL ".join(parts))


@query("A6_describe_exact", _describe_sql)
def a6(spark, sf):
    d = R.describe(T.numeric6(spark, sf), _DESC_COLS, exact=True)
    return d.withColumn("value", r6("value"))


_CORR_COLS = ["f1", "f2", "f3", "f4", "f5", "f6"]


def _corr_sql(kind):
    parts = []
    for a in _CORR_COLS:
        for b in _CORR_COLS:
            if a == b:
                e = ("CASE WHEN stddev_samp(%s) > 0 THEN 1.0 END" % a) if kind == "corr" \
                    else f"var_samp({a})"
            else:
                e = f"corr({a}, {b})" if kind == "corr" else f"covar_samp({a}, {b})"
            parts.append(f"SELECT '{a}' AS i, '{b}' AS j, round({e}, 6) AS value FROM numeric6")
    return with_views(["numeric6"], "\nUNION ALL ".join(parts))


@query("A7_corr_matrix", lambda: _corr_sql("corr"))
def a7(spark, sf):
    return R.corr_matrix(T.numeric6(spark, sf), _CORR_COLS, "corr").withColumn(
        "value", r6("value"))


@query("A7_cov_matrix", lambda: _corr_sql("cov"))
def a7b(spark, sf):
    return R.corr_matrix(T.numeric6(spark, sf), _CORR_COLS, "cov").withColumn(
        "value", r6("value"))


_PROF = ["root_code", "goldstein", "actor1_country"]


def _profile_sql():
    parts = ["SELECT quad_class, 'n' AS stat, '' AS cols, CAST(count(*) AS DOUBLE) AS value "
             "FROM actor_events GROUP BY quad_class"]
    for c in _PROF:
        parts.append(f"SELECT quad_class, 'mean', '{c}', round(avg({c}), 6) FROM actor_events "
                     f"GROUP BY quad_class")
    for i, a in enumerate(_PROF):
        for b in _PROF[i + 1:]:
            parts.append(f"SELECT quad_class, 'corr', '{a}*{b}', round(corr({a}, {b}), 6) "
                         f"FROM actor_events GROUP BY quad_class")
    return with_views(["actor_events"], "\nUNION ALL ".join(parts))


@query("A8_class_profile", _profile_sql)
def a8(spark, sf):
    return R.class_profile(T.actor_events(spark, sf), "quad_class", _PROF).withColumn(
        "value", r6("value"))


@query("A8_crosstab", with_views(["actor_events"], """
SELECT root_code, quad_class, count(*) AS n FROM actor_events GROUP BY 1, 2"""))
def a8b(spark, sf):
    return R.crosstab(T.actor_events(spark, sf), "root_code", "quad_class")


@query("A9_fold_summary", """
WITH s AS (SELECT c.c_mktsegment AS model, o.o_orderkey % 5 AS fold,
                  avg(o.o_totalprice) AS score
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)
SELECT model, count(score) AS n, round(avg(score), 6) AS mean,
       round(stddev_pop(score), 6) AS std,
       round(stddev_pop(score) / sqrt(count(score)), 6) AS std_err
FROM s GROUP BY model""")
def a9(spark, sf):
    o = T.table(spark, sf, "orders")
    c = T.table(spark, sf, "customer")
    scores = (o.join(c, o.o_custkey == c.c_custkey)
              .groupBy(F.col("c_mktsegment").alias("model"),
                       (F.col("o_orderkey") % 5).alias("fold"))
              .agg(F.avg("o_totalprice").alias("score")))
    out = R.fold_summary(scores, ["model"])
    return out.select("model", "n", *[r6(c).alias(c) for c in ("mean", "std", "std_err")])


@query("A10_shape", "SELECT count(*) AS rows, CAST(11 AS BIGINT) AS cols FROM lineitem")
def a10(spark, sf):
    return R.shape(T.table(spark, sf, "lineitem"))


@query("A10_distinct_labels", "SELECT count(DISTINCT label) AS n_distinct FROM embeddings")
def a10b(spark, sf):
    return R.distinct_count(T.table(spark, sf, "embeddings"), "label")


_PRED = "CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END"


@query("A12_confusion_matrix", with_views(["doc_class"], f"""
SELECT quality AS y, {_PRED} AS p, count(*) AS n FROM doc_class GROUP BY 1, 2"""))
def a12(spark, sf):
    d = T.doc_class(spark, sf).withColumn("pred", F.expr(_PRED))
    return R.confusion_matrix(d, "quality", "pred")


@query("A13_classification_report", with_views(["doc_class"], f"""
WITH cm AS (SELECT quality AS y, {_PRED} AS p, count(*) AS n FROM doc_class GROUP BY 1, 2),
sup AS (SELECT y AS cls, sum(n) AS support FROM cm GROUP BY 1),
pr AS (SELECT p AS cls, sum(n) AS predicted FROM cm GROUP BY 1),
tp AS (SELECT y AS cls, n AS tp FROM cm WHERE y = p),
t AS (SELECT coalesce(sup.cls, pr.cls) AS cls, coalesce(support, 0) AS support,
             coalesce(predicted, 0) AS predicted FROM sup FULL JOIN pr ON sup.cls = pr.cls),
m AS (SELECT t.cls, coalesce(tp.tp / nullif(predicted, 0), 0.0) AS precision,
             coalesce(tp.tp / nullif(support, 0), 0.0) AS recall, support
      FROM t LEFT JOIN tp ON t.cls = tp.cls),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM m)
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall,
       CAST(support AS BIGINT) AS support, round(f1, 6) AS f1 FROM f
UNION ALL
SELECT -1, round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), CAST(sum(support) AS BIGINT),
       round(sum(f1 * support) / sum(support), 6) FROM f"""))
def a13(spark, sf):
    d = T.doc_class(spark, sf).withColumn("pred", F.expr(_PRED))
    rep = R.classification_report(d, "quality", "pred")
    return rep.select("cls", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      F.col("support").cast("bigint").alias("support"), r6("f1").alias("f1"))


@query("A15_batched_accuracy", with_views(["doc_class"], f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM doc_class),
b AS (SELECT pos // 100 AS batch,
             avg(CASE WHEN quality = {_PRED} THEN 1.0 ELSE 0.0 END) AS acc
      FROM r GROUP BY 1)
SELECT count(*) AS batches, round(avg(acc), 6) AS mean_acc FROM b"""))
def a15(spark, sf):
    d = T.doc_class(spark, sf).withColumn("pred", F.expr(_PRED))
    out = R.batched_accuracy(d, "quality", "pred", "doc_id", batch=100)
    return out.select("batches", r6("mean_acc").alias("mean_acc"))


# ------------------------------------------------------------------ P1..P11

@query("P1_project", "SELECT event_id, user_id, value FROM events")
def p1(spark, sf):
    return R.project(T.table(spark, sf, "events"), ["event_id", "user_id", "value"])


@query("P2_drop_column", "SELECT event_id, ts, user_id, event_type, value FROM events")
def p2(spark, sf):
    return R.drop_cols(T.table(spark, sf, "events"), ["props"])


@query("P3_equality_filter", with_views(["actor_events"], """
SELECT order_id, line_no, actor1_country, actor2_country FROM actor_events
WHERE actor1_type = 'BUILDING' AND quad_class = 2"""))
def p3(spark, sf):
    d = R.where_all(T.actor_events(spark, sf), {"actor1_type": "BUILDING", "quad_class": 2})
    return d.select("order_id", "line_no", "actor1_country", "actor2_country")


@query("P4_regex_contains", """
SELECT doc_id, lang FROM documents WHERE coalesce(regexp_matches(text, 'Licen[sc]e'), false)""")
def p4(spark, sf):
    return R.contains(T.table(spark, sf, "documents"), "text", "Licen[sc]e").select(
        "doc_id", "lang")


@query("P5_drop_null", with_views(["actor_events"], """
SELECT order_id, line_no, actor2_type FROM actor_events WHERE actor2_type IS NOT NULL"""))
def p5(spark, sf):
    d = T.actor_events(spark, sf).select("order_id", "line_no", "actor2_type")
    return R.drop_null(d, ["actor2_type"])


@query("P6_late_cast", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       TRY_CAST(event_type AS INTEGER) AS event_type FROM events""")
def p6(spark, sf):
    e = T.table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "event_type")
    return R.cast_cols(e, {"k": "int", "event_type": "int"})


@query("P7_label_sign", with_views(["daily"], """
WITH r AS (SELECT day, ln(x / lag(x) OVER (ORDER BY day)) AS log_return FROM daily)
SELECT day, round(log_return, 6) AS log_return,
       CASE WHEN log_return >= 0 THEN 1 ELSE 0 END AS label FROM r"""))
def p7(spark, sf):
    # daily is one row per calendar day (bounded by the time span), so the
    # ordered window over it is small at any data size.
    d = R.log_return(T.daily(spark, sf).select("day", "x"), [], "day", "x")
    d = R.label_sign(d, "log_return")
    return d.select("day", r6("log_return").alias("log_return"), "label")


@query("P8_first_orders_per_customer", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) t WHERE rn <= 3""")
def p8(spark, sf):
    o = T.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return R.slice_rows(o, ["o_orderdate", "o_orderkey"], 0, 3, by=["o_custkey"])


@query("P9_arithmetic", """
SELECT l_orderkey, l_linenumber, l_partkey,
       round(l_extendedprice * (1 - l_discount), 6) AS net,
       round(ln(l_extendedprice), 6) AS ln_price, round(exp(l_discount), 6) AS exp_disc,
       round(sqrt(l_quantity), 6) AS sqrt_qty, round(pow(l_tax, 2), 6) AS tax_sq
FROM lineitem""")
def p9(spark, sf):
    li = T.table(spark, sf, "lineitem")
    return R.derive(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                              "l_discount", "l_quantity", "l_tax"), {
        "net": r6(F.col("l_extendedprice") * (1 - F.col("l_discount"))),
        "ln_price": r6(F.ln("l_extendedprice")), "exp_disc": r6(F.exp("l_discount")),
        "sqrt_qty": r6(F.sqrt("l_quantity")), "tax_sq": r6(F.pow("l_tax", 2)),
    }).drop("l_extendedprice", "l_discount", "l_quantity", "l_tax")


@query("P10_haversine", with_views(["actor_events"], """
SELECT lat1, long1, lat2, long2,
       round(2 * 6371.0 * asin(sqrt(pow(sin((radians(lat2) - radians(lat1)) / 2), 2)
         + cos(radians(lat1)) * cos(radians(lat2))
           * pow(sin((radians(long2) - radians(long1)) / 2), 2))), 6) AS km
FROM (SELECT DISTINCT lat1, long1, lat2, long2 FROM actor_events) t"""))
def p10(spark, sf):
    d = T.actor_events(spark, sf).select("lat1", "long1", "lat2", "long2").distinct()
    return R.haversine(d, "lat1", "long1", "lat2", "long2").withColumn("km", r6("km"))


@query("P11_widen_fill", with_views(["actor_events"], """
SELECT root_code,
       CAST(sum(CASE WHEN quad_class = 1 THEN 1 ELSE 0 END) AS BIGINT) AS q1,
       CAST(sum(CASE WHEN quad_class = 2 THEN 1 ELSE 0 END) AS BIGINT) AS q2,
       CAST(sum(CASE WHEN quad_class = 3 THEN 1 ELSE 0 END) AS BIGINT) AS q3,
       CAST(sum(CASE WHEN quad_class = 4 THEN 1 ELSE 0 END) AS BIGINT) AS q4
FROM actor_events GROUP BY root_code"""))
def p11(spark, sf):
    ct = R.crosstab(T.actor_events(spark, sf), "root_code", "quad_class")
    w = R.widen(ct, "root_code", "quad_class", "n", names=[1, 2, 3, 4], fill=0)
    return w.select("root_code", *[F.col(str(i)).cast("bigint").alias(f"q{i}")
                                   for i in range(1, 5)])


# ------------------------------------------------------------------ J1..J9

@query("J1_join_series", """
WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1),
b AS (SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS shipped FROM lineitem GROUP BY 1)
SELECT a.day, a.orders, b.shipped FROM a LEFT JOIN b ON a.day = b.day""")
def j1(spark, sf):
    a = (T.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day"))
         .agg(F.count(F.lit(1)).alias("orders")))
    b = (T.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day"))
         .agg(F.sum("l_quantity").alias("shipped")))
    return R.join_series(a, b, on="day", how="left")


@query("J2_asof_fridays", with_views(["daily"], """
WITH b AS (SELECT min(day) AS lo, max(day) AS hi FROM daily),
cal AS (SELECT CAST(gs AS DATE) AS day
        FROM b, unnest(generate_series(CAST(lo + CAST((5 - dayofweek(lo) + 7) % 7 AS INTEGER) AS TIMESTAMP),
                                       CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) t(gs)),
xs AS (SELECT day, x FROM daily WHERE x IS NOT NULL),
ys AS (SELECT day, y FROM daily WHERE y IS NOT NULL)
SELECT cal.day, xs.x, ys.y FROM cal
ASOF LEFT JOIN xs ON cal.day >= xs.day
ASOF LEFT JOIN ys ON cal.day >= ys.day"""))
def j2(spark, sf):
    return R.asof_calendar(T.daily(spark, sf), "day", ["x", "y"], "FRI")


@query("J3_pairs_within_order", """
WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
SELECT a.l_linenumber AS a, b.l_linenumber AS b, count(*) AS n
FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber
GROUP BY 1, 2""")
def j3(spark, sf):
    # an order holds at most 7 line numbers, so each group yields <= 21 pairs
    lines = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return (R.pairs(lines, "l_linenumber", within=["l_orderkey"])
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------ W1..W9

@query("W1_lags", with_views(["monthly"], """
SELECT series_id, pos, lag(x, 1) OVER w AS x_lag1, lag(x, 12) OVER w AS x_lag12
FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY pos)"""))
def w1(spark, sf):
    m = T.monthly(spark, sf)
    d = R.lag_cols(R.lag_cols(m, ["series_id"], "pos", ["x"], 1), ["series_id"], "pos", ["x"], 12)
    return d.select("series_id", "pos", "x_lag1", "x_lag12")


@query("W2_log_return", with_views(["monthly"], """
SELECT series_id, pos,
       round(ln((x + 1) / (lag(x, 1) OVER (PARTITION BY series_id ORDER BY pos) + 1)), 6)
         AS log_return FROM monthly"""))
def w2(spark, sf):
    m = T.monthly(spark, sf).withColumn("x1", F.col("x") + 1)
    d = R.log_return(m, ["series_id"], "pos", "x1")
    return d.select("series_id", "pos", r6("log_return").alias("log_return"))


@query("W3_seasonal_diff", with_views(["monthly"], """
SELECT series_id, pos, x - lag(x, 12) OVER (PARTITION BY series_id ORDER BY pos) AS diff
FROM monthly"""))
def w3(spark, sf):
    return R.seasonal_diff(T.monthly(spark, sf), ["series_id"], "pos", "x", 12).select(
        "series_id", "pos", "diff")


@query("W4_look_back", with_views(["monthly"], """
SELECT * FROM (
  SELECT series_id, pos,
         lag(x, 4) OVER w AS x_1, lag(x, 3) OVER w AS x_2, lag(x, 2) OVER w AS x_3,
         lag(x, 1) OVER w AS x_4, x AS y
  FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY pos)) t
WHERE x_1 IS NOT NULL"""))
def w4(spark, sf):
    d = R.look_back(T.monthly(spark, sf), ["series_id"], "pos", "x", 4)
    return d.select("series_id", "pos", *[F.col("features")[i].alias(f"x_{i + 1}")
                                          for i in range(4)], "y")


@query("W5_inverse_seasonal", with_views(["monthly"], """
WITH d AS (SELECT series_id, pos,
                  CASE WHEN pos < 12 THEN x
                       ELSE x - lag(x, 12) OVER (PARTITION BY series_id ORDER BY pos) END AS v
           FROM monthly)
SELECT series_id, pos,
       sum(v) OVER (PARTITION BY series_id, pos % 12 ORDER BY pos
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level
FROM d"""))
def w5(spark, sf):
    m = R.seasonal_diff(T.monthly(spark, sf), ["series_id"], "pos", "x", 12)
    m = m.withColumn("v", F.when(F.col("pos") < 12, F.col("x")).otherwise(F.col("diff")))
    return R.inverse_seasonal(m, ["series_id"], "pos", "v", 12).select(
        "series_id", "pos", "level")


@query("W6_inverse_log_return", with_views(["monthly"], """
WITH r AS (SELECT series_id, pos, x,
                  coalesce(ln((x + 1) / (lag(x) OVER (PARTITION BY series_id ORDER BY pos) + 1)),
                           0.0) AS r,
                  first_value(x + 1) OVER (PARTITION BY series_id ORDER BY pos) AS v0
           FROM monthly)
SELECT series_id, pos,
       round(v0 * exp(sum(r) OVER (PARTITION BY series_id ORDER BY pos
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) - 1, 6)
         AS level
FROM r"""))
def w6(spark, sf):
    m = T.monthly(spark, sf).withColumn("x1", F.col("x") + 1)
    m = R.log_return(m, ["series_id"], "pos", "x1", "r").fillna(0.0, ["r"])
    w = Window.partitionBy("series_id").orderBy("pos")
    m = m.withColumn("v0", F.first("x1").over(w))
    d = R.inverse_log_return(m, ["series_id"], "pos", "r", "v0")
    return d.select("series_id", "pos", r6(F.col("level") - 1).alias("level"))


@query("W7_second_difference_argmax", with_views(["monthly"], """
WITH d AS (SELECT series_id, pos,
                  x - 2 * lag(x, 1) OVER w + lag(x, 2) OVER w AS d2
           FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY pos))
SELECT series_id, d2 AS best_d2, pos AS best_pos FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY d2 DESC, pos) AS rn
  FROM d WHERE d2 IS NOT NULL) t WHERE rn = 1"""))
def w7(spark, sf):
    d = R.knee(T.monthly(spark, sf), "pos", "x", by=["series_id"]).filter(
        F.col("d2").isNotNull())
    # first position on ties: maximise (d2, -pos)
    return d.groupBy("series_id").agg(
        F.max("d2").alias("best_d2"),
        F.max_by("pos", F.struct(F.col("d2"), -F.col("pos"))).alias("best_pos"))


@query("W9_centered_ma", with_views(["monthly"], """
SELECT series_id, pos,
       round(CASE WHEN count(x) OVER (PARTITION BY series_id ORDER BY pos
                                      ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
             THEN (avg(x) OVER (PARTITION BY series_id ORDER BY pos
                               ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
                 + avg(x) OVER (PARTITION BY series_id ORDER BY pos
                               ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2 END, 6) AS trend
FROM monthly"""))
def w9(spark, sf):
    d = R.centered_ma(T.monthly(spark, sf), ["series_id"], "pos", "x", 12)
    return d.select("series_id", "pos", r6("trend").alias("trend"))


# ------------------------------------------------------------------ O1..O5

@query("O1_top_customers", """
SELECT o_custkey, round(sum(o_totalprice), 6) AS spend FROM orders GROUP BY 1
ORDER BY spend DESC, o_custkey LIMIT 10""")
def o1(spark, sf):
    s = (T.table(spark, sf, "orders").groupBy("o_custkey")
         .agg(r6(F.sum("o_totalprice")).alias("spend")))
    return R.top(s, "spend", 10, tie=["o_custkey"])


@query("O3_concat", """
SELECT 'customer' AS kind, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 2
UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2""")
def o3(spark, sf):
    c = (T.table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation"))
         .agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("customer")))
    s = (T.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation"))
         .agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("supplier")))
    return R.concat(c, s).select("kind", "nation", "n")


@query("O4_intersect_keys", """
SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1995
INTERSECT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996
INTERSECT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997""")
def o4(spark, sf):
    o = T.table(spark, sf, "orders")
    ys = [o.filter(F.year("o_orderdate") == y).select("o_custkey") for y in (1995, 1996, 1997)]
    return R.intersect_keys(*ys)


@query("O5_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def o5(spark, sf):
    return R.distinct_keys(T.table(spark, sf, "events"), ["user_id", "event_type"])


# ------------------------------------------------------------ entries of their own

@query("J5_every_combination", """
WITH g AS (SELECT * FROM (SELECT DISTINCT o_orderpriority FROM orders), (SELECT DISTINCT o_orderstatus FROM orders),
                         (SELECT DISTINCT c_mktsegment FROM customer)),
n AS (SELECT o_orderpriority, o_orderstatus, c_mktsegment, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
SELECT g.o_orderpriority, g.o_orderstatus, g.c_mktsegment, coalesce(n, 0) AS n FROM g LEFT JOIN n
ON g.o_orderpriority = n.o_orderpriority AND g.o_orderstatus = n.o_orderstatus AND g.c_mktsegment = n.c_mktsegment""")
def j5(spark, sf):
    o, c = T.table(spark, sf, "orders"), T.table(spark, sf, "customer")
    keys = ["o_orderpriority", "o_orderstatus", "c_mktsegment"]
    grid = R.every_combination(o.select(keys[0]), o.select(keys[1]), c.select(keys[2]))
    n = o.join(c, o.o_custkey == c.c_custkey).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(n, keys, "left").fillna(0, ["n"])


@query("J7_membership", """
SELECT 'in' AS side, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL SELECT 'out', count(*), round(sum(o_totalprice), 2) FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey = o_custkey)""")
def j7(spark, sf):
    o = T.table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = T.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    agg = [F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")]
    sides = [R.keep_in(o, "o_custkey", c, "c_custkey").agg(*agg).withColumn("side", F.lit("in")),
             R.drop_in(o, "o_custkey", c, "c_custkey").agg(*agg).withColumn("side", F.lit("out"))]
    return sides[0].unionByName(sides[1]).select("side", "n", "total")


@query("J8_score_per_order", """
SELECT l_orderkey, round(sum(p_retailprice), 4) AS score FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def j8(spark, sf):
    lines = T.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    scores = T.table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("score"))
    return R.score_sum(lines, scores, "p_partkey", ["l_orderkey"]).withColumn("score", F.round("score", 4))


@query("J9_align_predictions", with_views(["doc_class"], f"""
SELECT doc_id, {_PRED} AS p, quality AS y, {_PRED} = quality AS hit FROM doc_class"""))
def j9(spark, sf):
    docs = T.table(spark, sf, "documents").select("doc_id", F.expr(_PRED).alias("p"))
    truth = T.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    return R.align(docs, truth, "doc_id").select("doc_id", "p", "y", (F.col("p") == F.col("y")).alias("hit"))


@query("W8_top_lines_in_order", """
WITH t AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS r FROM lineitem)
SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ' ' ORDER BY l_linenumber) AS lines FROM t WHERE r <= 3 GROUP BY 1""")
def w8(spark, sf):
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    best = R.top_n_in_order(li, ["l_orderkey"], "l_extendedprice", "l_linenumber", 3)
    return best.groupBy("l_orderkey").agg(F.concat_ws(" ", F.transform(
        F.array_sort(F.collect_list("l_linenumber")), lambda x: x.cast("string"))).alias("lines"))
