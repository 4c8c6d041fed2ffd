"""Supervised learning helpers and model evaluation (M1--M18).

Splits are deterministic arithmetic on keys (no global row numbers); the
k-nearest-neighbour join visits cells of nearby rows (``neighbours``).
Model fitting uses Spark ML estimators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.neighbours import k_nearest
from tessera.operators.relational import attach_row


def one_hot(df: DataFrame, cols, values: dict | None = None, keep=()) -> DataFrame:
    """M1: indicator column ``<col>_<value>`` per category.  ``values`` fixes
    the categories (fit on the training set); otherwise they are the
    distinct values -- a small categorical domain -- of ``df``."""
    values = dict(values or {})
    exprs = []
    for c in cols:
        vals = values.get(c)
        if vals is None:
            vals = sorted(r[0] for r in df.select(c).distinct().dropna().collect())
        exprs += [(F.col(c) == F.lit(v)).cast("int").alias(f"{c}_{v}") for v in vals]
    return df.select(*keep, *exprs)


def hash_split(df: DataFrame, key: str, frac: float = 0.7, seed: int = 0,
               name: str = "split") -> DataFrame:
    """M2: reproducible random split from key arithmetic:
    ``(key * 7919 + seed) % 100 < frac * 100`` -> 'train' else 'test'."""
    b = (F.col(key) * 7919 + seed) % 100
    return df.withColumn(name, F.when(b < int(round(frac * 100)), "train").otherwise("test"))


def chronological_split(df: DataFrame, order, frac: float = 0.8, name: str = "split") -> DataFrame:
    """M2: the first ``frac`` of the rows in the unique ``order`` are 'train', the
    rest 'test', by range partitioning and partition offsets."""
    from tessera.operators.relational import dense_index
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    first = F.col("_r") < F.floor(F.col("_n") * F.lit(frac) + 1e-9)
    return attach_row(dense_index(df, order, "_r"), total).withColumn(
        name, F.when(first, "train").otherwise("test")).drop("_r", "_n")


def time_splits(df: DataFrame, ts: str, n_splits: int = 5) -> DataFrame:
    """M4: expanding-window splits.  Rows are ranked by time into
    ``n_splits + 1`` equal blocks; fold f trains on blocks <= f and tests on
    block f + 1.  Returns ``(fold, role, rows)`` counts per fold."""
    from tessera.operators.relational import dense_index
    total = df.agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_lo"))
    # rank by time through a range-partitioned sort; the block follows from it
    r = dense_index(df.select(ts), ts, "_r")
    r = attach_row(r, total).withColumn(
        "_b", F.floor(F.col("_r") * (n_splits + 1) / F.col("_n")).cast("int"))
    spark = df.sparkSession
    folds = F.broadcast(spark.range(0, n_splits).select(F.col("id").cast("int").alias("fold")))
    j = r.crossJoin(folds).withColumn(
        "role", F.when(F.col("_b") <= F.col("fold"), "train")
        .when(F.col("_b") == F.col("fold") + 1, "test"))
    return j.filter(F.col("role").isNotNull()).groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("rows"))


def knn_join(queries: DataFrame, base: DataFrame, k: int, metric: str = "euclidean",
             qid="id", bid="id", vec="vec", exclude_self: bool = True) -> DataFrame:
    """Exact k nearest neighbours ``(qid, bid, d, rank)``, ties by the base
    id; by pivot cells (``neighbours.k_nearest``)."""
    return k_nearest(queries, base, k, metric, qid, bid, vec, exclude_self)


def knn_classify(neigh: DataFrame, label: str = "label", weights: str = "distance") -> DataFrame:
    """M6: vote of the neighbours (``weights='distance'``: weight 1/d, and
    if some neighbours are at distance 0 only those vote).  Ties go to the
    smallest label."""
    if weights == "distance":
        zero = F.min("d").over(Window.partitionBy("qid")) == 0
        wgt = F.when(zero, (F.col("d") == 0).cast("double")).otherwise(1.0 / F.col("d"))
    else:
        wgt = F.lit(1.0)
    v = (neigh.withColumn("_w", wgt).groupBy("qid", label).agg(F.sum("_w").alias("votes")))
    v = v.withColumn("votes", F.round("votes", 9))
    w = Window.partitionBy("qid").orderBy(F.desc("votes"), F.asc(label))
    return (v.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
            .select("qid", F.col(label).alias("pred"), "votes"))


def knn_regress(neigh: DataFrame, target: str, weights: str = "distance") -> DataFrame:
    """M7: (weighted) mean of the neighbours' target; with distance weights,
    neighbours at distance 0 (if any) take all the weight."""
    if weights == "distance":
        zero = F.min("d").over(Window.partitionBy("qid")) == 0
        wgt = F.when(zero, (F.col("d") == 0).cast("double")).otherwise(1.0 / F.col("d"))
    else:
        wgt = F.lit(1.0)
    n = neigh.withColumn("_w", wgt)
    return n.groupBy("qid").agg((F.sum(F.col("_w") * F.col(target)) / F.sum("_w")).alias("pred"))


def score(df: DataFrame, y: str, p: str, metric: str) -> DataFrame:
    """Accuracy, mse, rmse or cross-entropy (``p`` = probability of
    the true class)."""
    if metric == "accuracy":
        e = F.avg((F.col(y) == F.col(p)).cast("double"))
    elif metric == "mse":
        e = F.avg(F.pow(F.col(y) - F.col(p), 2))
    elif metric == "rmse":
        e = F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), 2)))
    elif metric == "cross_entropy":
        e = -F.avg(F.ln(F.col(p)))
    else:
        raise ValueError(metric)
    return df.agg(e.alias(metric))


def min_max(df: DataFrame, cols, lo: float = 0.0, hi: float = 1.0):
    """Scale to [lo, hi]; returns the scaled frame and the one-row
    ``(col_min, col_max)`` table needed by ``inverse_min_max``.  A constant
    column becomes ``lo``."""
    mm = df.agg(*[F.min(c).alias(f"{c}_min") for c in cols],
                *[F.max(c).alias(f"{c}_max") for c in cols])
    j = attach_row(df, mm)
    out = j.select(*[c for c in df.columns if c not in cols], *[
        F.when(F.col(c).isNotNull(), F.lit(lo) + F.coalesce(F.try_divide(
            F.col(c) - F.col(f"{c}_min"), F.col(f"{c}_max") - F.col(f"{c}_min")), F.lit(0.0))
            * (hi - lo)).alias(c) for c in cols])
    return out, mm


def inverse_min_max(df: DataFrame, mm: DataFrame, cols, lo: float = 0.0, hi: float = 1.0):
    j = attach_row(df, mm)
    return j.select(*[c for c in df.columns if c not in cols], *[
        (F.col(f"{c}_min") + (F.col(c) - lo) / (hi - lo)
         * (F.col(f"{c}_max") - F.col(f"{c}_min"))).alias(c) for c in cols])


# ---------------------------------------------------------------- Spark ML models

def _assemble(df: DataFrame, features):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def fit_predict(train: DataFrame, test: DataFrame, features, label: str, kind: str, **params):
    """Fit a Spark ML estimator on ``train`` and
    return ``test`` with ``prediction`` (and ``probability`` for
    classifiers)."""
    from pyspark.ml import classification as CL
    from pyspark.ml import regression as RG
    est = {
        "logistic": CL.LogisticRegression, "linear_svc": CL.LinearSVC,
        "random_forest": CL.RandomForestClassifier, "gbt": CL.GBTClassifier,
        "mlp": CL.MultilayerPerceptronClassifier,
        "rf_regressor": RG.RandomForestRegressor, "gbt_regressor": RG.GBTRegressor,
        "linear_regression": RG.LinearRegression,
    }[kind](featuresCol="features", labelCol=label, **params)
    model = est.fit(_assemble(train, features))
    return model, model.transform(_assemble(test, features))


def stratified_splits(df: DataFrame, key: str, y: str, n_splits: int = 5, frac: float = 0.2,
                      seed: int = 0, buckets: int = 65536) -> DataFrame:
    """M3: ``n_splits`` stratified shuffle splits: in split r every class c
    sends exactly ``ceil(frac * n_c)`` rows to the test side, chosen by a
    per-split hash of the key (the smallest hashes).

    Exact selection without ranking a whole class in one task: hashes are
    bucketed, bucket counts are a partial aggregate, the boundary bucket is
    found on the (bounded) bucket table, and only rows of that bucket are
    ranked.  Returns ``df`` columns + ``split`` + ``role``."""
    spark = df.sparkSession
    reps = F.broadcast(spark.range(n_splits).select(F.col("id").cast("int").alias("split")))
    h = ((F.col(key) * 7919 + F.col("split") * 15485863 + seed * 104729) % 1000003) / 1000003.0
    x = df.crossJoin(reps).withColumn("_h", h).withColumn("_b", F.floor(F.col("_h") * buckets))
    n = df.groupBy(y).agg(F.ceil(F.count(F.lit(1)) * frac).alias("_target"))
    bc = x.groupBy("split", y, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("split", y).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    bc = bc.withColumn("_cum", F.sum("_c").over(w)).join(n, y)
    edge = (bc.filter(F.col("_cum") >= F.col("_target")).groupBy("split", y)
            .agg(F.min(F.struct("_b", "_cum", "_c")).alias("e")))
    edge = edge.select("split", y, F.col("e._b").alias("_eb"),
                       (F.col("e._cum") - F.col("e._c")).alias("_before")).join(n, y)
    x = x.join(edge, ["split", y], "left")
    inner = x.filter(F.col("_b") == F.col("_eb"))
    wr = Window.partitionBy("split", y).orderBy("_h", key)
    inner = inner.withColumn("_rk", F.row_number().over(wr)).select(
        "split", key, (F.col("_rk") <= F.col("_target") - F.col("_before")).alias("_in"))
    x = x.join(inner, ["split", key], "left")
    role = F.when((F.col("_b") < F.col("_eb")) | F.coalesce(F.col("_in"), F.lit(False)), "test"
                  ).otherwise("train")
    return x.select(*df.columns, "split", role.alias("role"))


def grid_search(df: DataFrame, features, label: str, kind: str, grid: dict, folds: int = 3,
                key: str = "id", seed: int = 0) -> DataFrame:
    """M5: k-fold cross-validation over a parameter grid; folds from key
    arithmetic.  Returns ``(params, fold, score)`` rows (accuracy)."""
    from itertools import product
    d = df.withColumn("_fold", ((F.col(key) * 7919 + seed) % folds).cast("int")).cache()
    names = list(grid)
    out = []
    for combo in product(*[grid[n] for n in names]):
        params = dict(zip(names, combo))
        for f in range(folds):
            _, pred = fit_predict(d.filter(F.col("_fold") != f), d.filter(F.col("_fold") == f),
                                  features, label, kind, **params)
            sc = score(pred.withColumn("prediction", F.col("prediction").cast("int")),
                       label, "prediction", "accuracy")
            out.append(sc.select(F.lit(str(params)).alias("params"), F.lit(f).alias("fold"),
                                 F.col("accuracy").alias("score")))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def kernel_features(df: DataFrame, cols, kind: str = "rbf", dim: int = 50, gamma: float = 1.0,
                    seed: int = 0, degree: int = 2, keep=()) -> DataFrame:
    """Explicit kernel maps so that linear models act like kernel
    machines: random Fourier features ``sqrt(2/D) cos(w.x + b)`` with
    ``w ~ N(0, 2 gamma)`` (rbf), or all monomials up to ``degree`` (poly).
    The d x D projection is generated from the seed on the driver (small)."""
    import numpy as np
    if kind == "rbf":
        rng = np.random.default_rng(seed)
        w = rng.normal(0, np.sqrt(2 * gamma), size=(dim, len(cols)))
        b = rng.uniform(0, 2 * np.pi, size=dim)
        exprs = [(F.lit(float(np.sqrt(2.0 / dim))) * F.cos(
            sum((F.col(c) * float(w[k, i]) for i, c in enumerate(cols)), F.lit(float(b[k])))))
            .alias(f"z{k}") for k in range(dim)]
        return df.select(*keep, *exprs)
    from itertools import combinations_with_replacement
    exprs = []
    for deg in range(1, degree + 1):
        for combo in combinations_with_replacement(cols, deg):
            e = F.lit(1.0)
            for c in combo:
                e = e * F.col(c)
            exprs.append(e.alias("_".join(combo)))
    return df.select(*keep, *exprs)


def bagged_knn_regress(train: DataFrame, test: DataFrame, features, target: str, k: int = 2,
                       bags: int = 5, rows: float = 0.7, feats: float = 0.5, seed: int = 0,
                       key: str = "id") -> DataFrame:
    """M8: bagging of kNN regressors: bag b keeps training rows whose
    key hash falls under ``rows`` and a rotating ``feats`` share of the
    features; predictions are averaged over bags."""
    nf = max(1, int(round(len(features) * feats)))
    preds = []
    for b in range(bags):
        fs = [features[(b + i) % len(features)] for i in range(nf)]
        keep = ((F.col(key) * 7919 + b * 104729 + seed) % 100) < int(rows * 100)
        tr = train.filter(keep).select(key, F.array(*fs).alias("vec"), target)
        te = test.select(key, F.array(*fs).alias("vec"))
        nb = knn_join(te, tr, k, "manhattan", qid=key, bid=key, exclude_self=False)
        preds.append(knn_regress(nb, target, weights="uniform").withColumn("bag", F.lit(b)))
    allp = preds[0]
    for p in preds[1:]:
        allp = allp.unionByName(p)
    return allp.groupBy("qid").agg(F.avg("pred").alias("pred"))


LOSSES = ("hinge", "log", "modified_huber", "squared_hinge", "perceptron")
PENALTIES = ("l2", "l1", "elasticnet")


def _fold_sum(terms):
    acc = terms[0]
    for t in terms[1:]:
        acc = acc + t
    return acc


def _grad_factor(loss: str, s, y):
    """d loss / d score for label y in {-1, +1} and score s."""
    m = y * s
    if loss == "hinge":
        return F.when(m < 1, -y).otherwise(0.0)
    if loss == "perceptron":
        return F.when(m <= 0, -y).otherwise(0.0)
    if loss == "squared_hinge":
        return -2 * y * F.greatest(F.lit(0.0), 1 - m)
    if loss == "modified_huber":
        return F.when(m >= -1, -2 * y * F.greatest(F.lit(0.0), 1 - m)).otherwise(-4 * y)
    if loss == "log":
        return -y / (1 + F.exp(m))
    raise ValueError(loss)


def linear_grid(train: DataFrame, test: DataFrame, features, label: str, losses=LOSSES,
                penalties=PENALTIES, alpha: float = 1e-3, l1_ratio: float = 0.15,
                iters: int = 30, step: float = 0.5) -> DataFrame:
    """M9: linear classifiers for every (loss, penalty) pair, trained
    together by full-batch (sub)gradient descent: each round is ONE
    aggregate over the training rows giving the gradients of all models;
    the weights (models x features, tiny) live on the driver and enter the
    next round as literals.  l1 is applied as a proximal (soft-threshold)
    step.  Features are standardised with training statistics.  Returns
    ``(loss, penalty, accuracy)`` on ``test``."""
    import numpy as np
    feats = list(features)
    stats = train.agg(*[F.avg(c).alias(f"m_{c}") for c in feats],
                      *[F.stddev_pop(c).alias(f"s_{c}") for c in feats]).first()

    def prep(df):
        cols = [((F.col(c) - stats[f"m_{c}"]) / (stats[f"s_{c}"] or 1.0)).alias(c) for c in feats]
        return df.select(*cols, F.when(F.col(label) > 0, 1.0).otherwise(-1.0).alias("_y"))

    spark = train.sparkSession
    tr = prep(train).cache()
    models = [(lo, pe) for lo in losses for pe in penalties]
    nm, nf = len(models), len(feats)
    W = np.zeros((nm, nf))
    B = np.zeros(nm)
    y = F.col("_y")
    wcols = [f"w{k}_{j}" for k in range(nm) for j in range(nf)] + [f"b{k}" for k in range(nm)]
    wschema = ", ".join(f"{c} double" for c in wcols)

    def weights_row():
        # the weights enter as a broadcast one-row table, not as literals, so
        # the generated code is the same every round (compiled once)
        vals = [float(W[k, j]) for k in range(nm) for j in range(nf)] + [float(v) for v in B]
        return F.broadcast(spark.createDataFrame([tuple(vals)], wschema))

    def scores(df):
        x = df.crossJoin(weights_row())
        return x.select(*feats, "_y", *[
            (F.col(f"b{k}") + _fold_sum([F.col(c) * F.col(f"w{k}_{j}")
                                          for j, c in enumerate(feats)])).alias(f"s{k}")
            for k in range(nm)])

    for t in range(iters):
        sc = scores(tr)
        sc = sc.select(*feats, *[_grad_factor(lo, F.col(f"s{k}"), y).alias(f"g{k}")
                                 for k, (lo, _) in enumerate(models)])
        aggs = [F.avg(F.col(f"g{k}") * F.col(c)).alias(f"g{k}_{j}")
                for k in range(nm) for j, c in enumerate(feats)]
        aggs += [F.avg(f"g{k}").alias(f"g{k}_b") for k in range(nm)]
        r = sc.agg(*aggs).first()
        eta = step / (1 + 0.1 * t)
        for k, (_, pe) in enumerate(models):
            grad = np.array([r[f"g{k}_{j}"] for j in range(nf)])
            l2 = alpha * (1 - l1_ratio) if pe == "elasticnet" else (alpha if pe == "l2" else 0.0)
            l1 = alpha * l1_ratio if pe == "elasticnet" else (alpha if pe == "l1" else 0.0)
            W[k] -= eta * (grad + l2 * W[k])
            W[k] = np.sign(W[k]) * np.maximum(np.abs(W[k]) - eta * l1, 0.0)
            B[k] -= eta * r[f"g{k}_b"]
    tr.unpersist()
    te = scores(prep(test))
    row = te.agg(*[F.avg((F.when(F.col(f"s{k}") >= 0, 1.0).otherwise(-1.0) == y).cast("double"))
                   .alias(f"a{k}") for k in range(nm)]).first()
    spark = train.sparkSession
    return spark.createDataFrame([(lo, pe, float(row[f"a{k}"])) for k, (lo, pe) in
                                  enumerate(models)], "loss string, penalty string, accuracy double")
