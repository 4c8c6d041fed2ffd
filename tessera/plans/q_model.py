"""Registered queries: dimensionality reduction (D*) and supervised models (M*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import reduce as D
from tessera.operators import relational as R
from tessera.operators import supervised as M
from tessera.plans.catalog import query
from tessera.plans.q_cluster import VECS
from tessera.plans.views_sql import with_views
from tessera.sources import tables as T


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


NUM = ["f1", "f2", "f3", "f4", "f5", "f6"]


# ------------------------------------------------------------------ D

@query("D1_eigen_covariance")
def d1(spark, sf):
    return D.eigen(T.numeric6(spark, sf), NUM, "cov")


@query("D1_eigen_correlation")
def d1b(spark, sf):
    return D.eigen(T.numeric6(spark, sf), NUM, "corr")


@query("D2_pca_scores")
def d2(spark, sf):
    _, scores = D.pca(T.numeric6(spark, sf), NUM, 2, whiten=True)
    return scores


@query("D3_pca_compare")
def d3(spark, sf):
    return D.pca_compare(T.numeric6(spark, sf), NUM)


@query("D4_kaiser")
def d4(spark, sf):
    return D.kaiser(D.eigen(T.numeric6(spark, sf), NUM, "corr"))


@query("D5_loading_checks")
def d5(spark, sf):
    return D.loading_checks(D.eigen(T.numeric6(spark, sf), NUM, "corr"))


@query("D6_truncated_svd")
def d6(spark, sf):
    comps, _ = D.truncated_svd(T.numeric6(spark, sf), NUM, 3)
    return comps


# ------------------------------------------------------------------ M

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("M1_one_hot", "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS c_mktsegment_{s}" for s in SEGMENTS)
    + " FROM customer")
def m1(spark, sf):
    return M.one_hot(T.table(spark, sf, "customer"), ["c_mktsegment"],
                     {"c_mktsegment": SEGMENTS}, keep=["c_custkey"])


@query("M2_hash_split", """
SELECT CASE WHEN (o_orderkey * 7919 + 0) % 100 < 70 THEN 'train' ELSE 'test' END AS split,
       count(*) AS n FROM orders GROUP BY 1""")
def m2(spark, sf):
    s = M.hash_split(T.table(spark, sf, "orders"), "o_orderkey", 0.7, 0)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("M2_chronological_split", """
WITH r AS (SELECT o_orderkey, o_orderdate, o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rk,
                  count(*) OVER () AS n FROM orders)
SELECT CASE WHEN rk < floor(n * 0.8 + 1e-9) THEN 'train' ELSE 'test' END AS split, count(*) AS n, min(o_orderdate) AS first,
       max(o_orderdate) AS last, round(avg(o_totalprice), 6) AS mean FROM r GROUP BY 1""")
def m2c(spark, sf):
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    s = M.chronological_split(o, ["o_orderdate", "o_orderkey"])
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first"),
                                  F.max("o_orderdate").alias("last"), r6(F.avg("o_totalprice")).alias("mean"))


@query("M4_time_splits", with_views(["daily"], """
WITH r AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS rk,
                  count(*) OVER () AS n FROM daily),
b AS (SELECT CAST(floor(rk * 6 / n) AS INTEGER) AS blk FROM r),
f AS (SELECT CAST(i AS INTEGER) AS fold FROM range(0, 5) t(i))
SELECT fold, CASE WHEN blk <= fold THEN 'train' ELSE 'test' END AS role, count(*) AS rows
FROM b, f WHERE blk <= fold + 1 GROUP BY 1, 2"""))
def m4(spark, sf):
    # one row per calendar day: the ordered window is over a bounded table
    return M.time_splits(T.daily(spark, sf), "day", 5)


KNN = """
WITH p AS (SELECT a.id AS qid, b.id AS bid, b.label, list_distance(a.vec, b.vec) AS d
           FROM vecs a JOIN vecs b ON a.id <> b.id),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, bid) AS rk
                      FROM p) r WHERE rk <= 4),
z AS (SELECT qid, min(d) AS md FROM nb GROUP BY 1),
v AS (SELECT nb.qid, nb.label,
             round(sum(CASE WHEN z.md = 0 THEN CASE WHEN nb.d = 0 THEN 1.0 ELSE 0.0 END
                            ELSE 1.0 / nb.d END), 9) AS votes
      FROM nb JOIN z ON nb.qid = z.qid GROUP BY 1, 2),
best AS (SELECT qid, label AS pred, votes FROM (
           SELECT *, row_number() OVER (PARTITION BY qid ORDER BY votes DESC, label) AS r2
           FROM v) x WHERE r2 = 1)
"""


def _knn(spark, sf):
    v = T.vectors(spark, sf)
    nb = M.knn_join(v, v, 4)
    return v, M.knn_classify(nb, "label")


@query("J6_nearest_neighbours", with_views([], """
SELECT qid, bid, round(d, 6) AS d, label, CAST(rk AS INTEGER) AS rank FROM (
  SELECT a.id AS qid, b.id AS bid, b.label, list_distance(a.vec, b.vec) AS d,
         row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id) AS rk
  FROM vecs a JOIN vecs b ON a.id <> b.id) t WHERE rk <= 10""", [VECS]))
def j6(spark, sf):
    v = T.vectors(spark, sf)
    return M.knn_join(v, v, 10).withColumn("d", r6("d"))


@query("M6_knn_classify", with_views([], KNN + "SELECT qid, pred, round(votes, 6) AS votes FROM best",
                                     [VECS]))
def m6(spark, sf):
    _, pred = _knn(spark, sf)
    return pred.withColumn("votes", r6("votes"))


@query("M16_knn_accuracy", with_views([], KNN + """
SELECT round(avg(CASE WHEN b.pred = v.label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM best b JOIN vecs v ON b.qid = v.id""", [VECS]))
def m16(spark, sf):
    v, pred = _knn(spark, sf)
    j = pred.join(v.select(F.col("id").alias("qid"), "label"), "qid")
    return M.score(j, "label", "pred", "accuracy").select(r6("accuracy").alias("accuracy"))


@query("M16_naive_forecast_error", with_views(["monthly"], """
WITH f AS (SELECT x AS y, lag(x, 1) OVER (PARTITION BY series_id ORDER BY pos) AS p FROM monthly)
SELECT round(avg(pow(y - p, 2)), 6) AS mse, round(sqrt(avg(pow(y - p, 2))), 6) AS rmse
FROM f WHERE p IS NOT NULL"""))
def m16b(spark, sf):
    m = R.lag_cols(T.monthly(spark, sf), ["series_id"], "pos", ["x"], 1).dropna(
        subset=["x_lag1"])
    a = M.score(m, "x", "x_lag1", "mse")
    b = M.score(m, "x", "x_lag1", "rmse")
    return a.crossJoin(b).select(r6("mse").alias("mse"), r6("rmse").alias("rmse"))


@query("M18_min_max_roundtrip", with_views(["numeric6"], """
SELECT round((f2 - min(f2) OVER ()) / (max(f2) OVER () - min(f2) OVER ()), 6) AS f2_scaled,
       round(f2, 6) AS f2_back FROM numeric6"""))
def m18(spark, sf):
    n = T.numeric6(spark, sf).select("f2")
    scaled, mm = M.min_max(n, ["f2"])
    back = M.inverse_min_max(scaled.withColumn("f2_scaled", F.col("f2")), mm, ["f2"])
    return back.select(r6("f2_scaled").alias("f2_scaled"), r6("f2").alias("f2_back"))


def _doc_features(spark, sf):
    d = T.doc_class(spark, sf)
    d = d.withColumn("len", F.ln(F.col("n_chars") + 1)).withColumn(
        "words", F.size(F.split("text", r"\s+")).cast("double"))
    oh = M.one_hot(d, ["lang"], {"lang": ["de", "en", "es", "fr"]},
                   keep=["doc_id", "len", "words", "quality", "toxic"])
    return M.hash_split(oh, "doc_id", 0.7, 0)


FEATS = ["len", "words", "lang_de", "lang_en", "lang_es", "lang_fr"]


@query("M17_model_comparison")
def m17(spark, sf):
    d = _doc_features(spark, sf)
    train = d.filter("split = 'train'")
    test = d.filter("split = 'test'")
    scores = []
    for name, kind, params in [
            ("logistic_l2", "logistic", {"regParam": 0.01}),
            ("logistic_elasticnet", "logistic", {"regParam": 0.01, "elasticNetParam": 0.5}),
            ("linear_svc_hinge", "linear_svc", {"regParam": 0.01}),
            ("random_forest_gini", "random_forest", {"numTrees": 20, "maxDepth": 5, "seed": 1}),
            ("random_forest_entropy", "random_forest",
             {"numTrees": 20, "maxDepth": 5, "impurity": "entropy", "seed": 1}),
            ("gbt", "gbt", {"maxIter": 10, "stepSize": 0.1, "seed": 1}),
            ("mlp", "mlp", {"layers": [len(FEATS), 12, 2], "seed": 1, "maxIter": 50})]:
        _, pred = M.fit_predict(train, test, FEATS, "quality", kind, **params)
        acc = M.score(pred.withColumn("prediction", F.col("prediction").cast("int")),
                      "quality", "prediction", "accuracy")
        scores.append(acc.select(F.lit(name).alias("model"), F.col("accuracy").alias("score")))
    return R.rank_models(*scores)


# ------------------------------------------------------------------ more M

@query("M3_stratified_splits", """
WITH x AS (SELECT o.o_orderkey, o.o_orderstatus, s.split,
                  ((o.o_orderkey * 7919 + s.split * 15485863 + 0) % 1000003) / 1000003.0 AS h
           FROM orders o CROSS JOIN (SELECT CAST(i AS INTEGER) AS split FROM range(0, 5) t(i)) s),
n AS (SELECT o_orderstatus, ceil(count(*) * 0.2) AS target FROM orders GROUP BY 1),
r AS (SELECT x.*, n.target, row_number() OVER (PARTITION BY x.split, x.o_orderstatus
                                               ORDER BY x.h, x.o_orderkey) AS rk
      FROM x JOIN n ON x.o_orderstatus = n.o_orderstatus)
SELECT split, o_orderstatus, CASE WHEN rk <= target THEN 'test' ELSE 'train' END AS role,
       count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM r GROUP BY 1, 2, 3""")
def m3(spark, sf):
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    s = M.stratified_splits(o, "o_orderkey", "o_orderstatus", 5, 0.2)
    return s.groupBy("split", "o_orderstatus", "role").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


LOOKBACK = ("lb", """
SELECT * FROM (
  SELECT series_id * 1000 + pos AS id,
         lag(x, 4) OVER w AS x_1, lag(x, 3) OVER w AS x_2, lag(x, 2) OVER w AS x_3,
         lag(x, 1) OVER w AS x_4, x AS y
  FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY pos)) t WHERE x_1 IS NOT NULL""")


def _lookback(spark, sf):
    d = R.look_back(T.monthly(spark, sf), ["series_id"], "pos", "x", 4)
    return d.select((F.col("series_id") * 1000 + F.col("pos")).alias("id"),
                    F.col("features").alias("vec"), "y")


@query("M7_knn_regress", with_views(["monthly"], """
WITH p AS (SELECT a.id AS qid, b.id AS bid, b.y,
                  abs(a.x_1 - b.x_1) + abs(a.x_2 - b.x_2) + abs(a.x_3 - b.x_3)
                  + abs(a.x_4 - b.x_4) AS d
           FROM lb a JOIN lb b ON a.id <> b.id),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, bid) AS rk
                      FROM p) r WHERE rk <= 2),
z AS (SELECT qid, min(d) AS md FROM nb GROUP BY 1)
SELECT nb.qid, round(sum(CASE WHEN z.md = 0 THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END
                              ELSE 1.0 / d END * y)
               / sum(CASE WHEN z.md = 0 THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END
                          ELSE 1.0 / d END), 6) AS pred
FROM nb JOIN z ON nb.qid = z.qid GROUP BY nb.qid""", [LOOKBACK]))
def m7(spark, sf):
    d = _lookback(spark, sf)
    nb = M.knn_join(d, d, 2, "manhattan")
    return M.knn_regress(nb, "y").withColumn("pred", r6("pred"))


@query("M8_bagged_knn_regress")
def m8(spark, sf):
    d = R.look_back(T.monthly(spark, sf), ["series_id"], "pos", "x", 4)
    d = d.select((F.col("series_id") * 1000 + F.col("pos")).alias("id"),
                 *[F.col("features")[i].alias(f"x_{i + 1}") for i in range(4)], "y")
    d = M.hash_split(d, "id", 0.7)
    pred = M.bagged_knn_regress(d.filter("split = 'train'"), d.filter("split = 'test'"),
                                ["x_1", "x_2", "x_3", "x_4"], "y", k=2, bags=5)
    j = pred.join(d.select(F.col("id").alias("qid"), "y"), "qid")
    return M.score(j, "y", "pred", "rmse")


@query("M5_grid_search_cv")
def m5(spark, sf):
    d = _doc_features(spark, sf).withColumnRenamed("doc_id", "id")
    res = M.grid_search(d, FEATS, "quality", "logistic", {"regParam": [0.001, 0.01, 0.1]},
                        folds=3)
    return R.fold_summary(res, ["params"])


@query("M10_rbf_features_linear_svc")
def m10(spark, sf):
    d = _doc_features(spark, sf)
    z = M.kernel_features(d, FEATS, "rbf", dim=40, gamma=0.5, seed=1,
                          keep=["doc_id", "quality", "split"])
    zc = [f"z{k}" for k in range(40)]
    _, pred = M.fit_predict(z.filter("split = 'train'"), z.filter("split = 'test'"), zc,
                            "quality", "linear_svc", regParam=0.01)
    return M.score(pred.withColumn("prediction", F.col("prediction").cast("int")),
                   "quality", "prediction", "accuracy")


@query("M12_forest_forecast")
def m12(spark, sf):
    d = R.look_back(T.monthly(spark, sf), ["series_id"], "pos", "x", 4)
    d = d.select("series_id", "pos", *[F.col("features")[i].alias(f"x_{i + 1}")
                                       for i in range(4)], "y")
    cut = d.agg(F.max("pos").alias("_m")).select((F.col("_m") * 0.8).alias("_c"))
    d = R.attach_row(d, cut)
    train, test = d.filter(F.col("pos") <= F.col("_c")), d.filter(F.col("pos") > F.col("_c"))
    _, pred = M.fit_predict(train, test, ["x_1", "x_2", "x_3", "x_4"], "y", "rf_regressor",
                            numTrees=20, maxDepth=5, seed=1)
    return M.score(pred, "y", "prediction", "rmse")


@query("D7_factor_analysis_varimax")
def d7(spark, sf):
    loadings, _ = D.factor_analysis(T.numeric6(spark, sf), NUM, 3)
    return loadings


@query("M15_lookback_regressors")
def m15(spark, sf):
    d = R.look_back(T.monthly(spark, sf), ["series_id"], "pos", "x", 4)
    d = d.select("series_id", "pos", *[F.col("features")[i].alias(f"x_{i + 1}")
                                       for i in range(4)], "y")
    cut = d.agg(F.max("pos").alias("_m")).select((F.col("_m") * 0.8).alias("_c"))
    d = R.attach_row(d, cut)
    train, test = d.filter(F.col("pos") <= F.col("_c")), d.filter(F.col("pos") > F.col("_c"))
    feats = ["x_1", "x_2", "x_3", "x_4"]
    scores = []
    for name, kind, params in [("huber_linear", "linear_regression", {"loss": "huber"}),
                               ("gbt_regressor", "gbt_regressor", {"maxIter": 20, "seed": 1})]:
        _, pred = M.fit_predict(train, test, feats, "y", kind, **params)
        scores.append(M.score(pred, "y", "prediction", "rmse").select(
            F.lit(name).alias("model"), F.col("rmse").alias("score")))
    return R.rank_models(*scores, ascending=True)


@query("M9_linear_loss_grid")
def m9(spark, sf):
    d = _doc_features(spark, sf)
    return M.linear_grid(d.filter("split = 'train'"), d.filter("split = 'test'"), FEATS,
                         "quality")
