"""Dimensionality reduction (D1--D6).

The d x d covariance / correlation / Gram matrix is one pass of partial
aggregates on Spark; only that small matrix reaches the driver, where numpy
solves the eigenproblem.  Scores are linear combinations of the columns,
computed back on Spark as plain Column arithmetic (codegen, no UDF).
Eigenvector signs are fixed: the entry of largest magnitude is positive.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.relational import attach_row


def _matrix(df: DataFrame, cols, kind: str) -> np.ndarray:
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            if kind == "cov":
                e = F.covar_samp(a, b)
            elif kind == "corr":
                e = F.lit(1.0) if a == b else F.corr(a, b)
            else:  # gram
                e = F.sum(F.col(a) * F.col(b))
            aggs.append(e.alias(f"{a}|{b}"))
    row = df.agg(*aggs).first()  # d(d+1)/2 numbers
    d = len(cols)
    m = np.zeros((d, d))
    for i, a in enumerate(cols):
        for j in range(i, d):
            m[i, j] = m[j, i] = row[f"{a}|{cols[j]}"]
    return m


def _fix_signs(vecs: np.ndarray) -> np.ndarray:
    out = vecs.copy()
    for k in range(out.shape[1]):
        if out[np.argmax(np.abs(out[:, k])), k] < 0:
            out[:, k] *= -1
    return out


def eigen_np(df: DataFrame, cols, kind: str = "cov"):
    m = _matrix(df, cols, kind)
    vals, vecs = np.linalg.eigh(m)
    order = np.argsort(vals)[::-1]
    return vals[order], _fix_signs(vecs[:, order])


def eigen(df: DataFrame, cols, kind: str = "cov") -> DataFrame:
    """``(component, value, vector)`` of the covariance or correlation
    matrix, largest eigenvalue first."""
    vals, vecs = eigen_np(df, cols, kind)
    rows = [(k + 1, float(vals[k]), [float(x) for x in vecs[:, k]]) for k in range(len(cols))]
    return df.sparkSession.createDataFrame(rows, "component int, value double, "
                                                 "vector array<double>")


def pca(df: DataFrame, cols, k: int, whiten: bool = False, id_col: str | None = None):
    """Principal components of the covariance matrix.  Returns
    ``(components(component, value, ratio, vector), scores(id?, pc1..pck))``;
    scores are ``(x - mean) . v`` (divided by sqrt(lambda) when whitened)."""
    vals, vecs = eigen_np(df, cols, "cov")
    total = float(vals.sum())
    spark = df.sparkSession
    comps = spark.createDataFrame(
        [(i + 1, float(vals[i]), float(vals[i] / total), [float(x) for x in vecs[:, i]])
         for i in range(k)], "component int, value double, ratio double, vector array<double>")
    means = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    j = attach_row(df, means)
    exprs = []
    for i in range(k):
        e = sum(((F.col(c) - F.col(f"_m_{c}")) * float(vecs[r, i]) for r, c in enumerate(cols)),
                F.lit(0.0))
        if whiten:
            e = e / float(np.sqrt(vals[i]))
        exprs.append(e.alias(f"pc{i + 1}"))
    keep = [id_col] if id_col else []
    return comps, j.select(*keep, *exprs)


def pca_compare(df: DataFrame, cols) -> DataFrame:
    """D3: eigenvalues of covariance and correlation side by side with
    their square roots and explained ratios."""
    vc, _ = eigen_np(df, cols, "cov")
    vr, _ = eigen_np(df, cols, "corr")
    rows = [(i + 1, float(vc[i]), float(np.sqrt(max(vc[i], 0))), float(vc[i] / vc.sum()),
             float(vr[i]), float(np.sqrt(max(vr[i], 0))), float(vr[i] / vr.sum()))
            for i in range(len(cols))]
    return df.sparkSession.createDataFrame(
        rows, "component int, value_cov double, sqrt_cov double, ratio_cov double, "
              "value_corr double, sqrt_corr double, ratio_corr double")


def kaiser(eig: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Components whose eigenvalue exceeds the threshold (scree rows)."""
    return eig.filter(F.col("value") > threshold)


def loading_checks(eig: DataFrame) -> DataFrame:
    """Loadings ``v * sqrt(lambda)``; sums of squares per variable
    (axis 'row', equals the communality, 1 for a full correlation PCA) and
    per component (axis 'col', equals lambda)."""
    e = eig.select("component", "value", F.posexplode("vector").alias("var", "v"))
    ld = e.select("component", "var", (F.col("v") * F.sqrt(F.col("value"))).alias("l"))
    rows = ld.groupBy(F.col("var").alias("index")).agg(F.sum(F.col("l") ** 2).alias("sum_sq"))
    cols = ld.groupBy(F.col("component").alias("index")).agg(F.sum(F.col("l") ** 2)
                                                              .alias("sum_sq"))
    return (rows.withColumn("axis", F.lit("row"))
            .unionByName(cols.withColumn("axis", F.lit("col")))
            .select("axis", "index", "sum_sq"))


def truncated_svd(df: DataFrame, cols, k: int, id_col: str | None = None):
    """SVD of the raw (uncentred) matrix through its d x d Gram matrix:
    singular values ``sqrt(eig(X'X))``, right vectors V, scores ``X V``.
    Ratio = share of the squared singular values."""
    g = _matrix(df, cols, "gram")
    vals, vecs = np.linalg.eigh(g)
    order = np.argsort(vals)[::-1]
    vals, vecs = np.clip(vals[order], 0, None), _fix_signs(vecs[:, order])
    s = np.sqrt(vals)
    spark = df.sparkSession
    comps = spark.createDataFrame(
        [(i + 1, float(s[i]), float(vals[i] / vals.sum())) for i in range(k)],
        "component int, s double, ratio double")
    keep = [id_col] if id_col else []
    scores = df.select(*keep, *[sum((F.col(c) * float(vecs[r, i]) for r, c in enumerate(cols)),
                                    F.lit(0.0)).alias(f"u{i + 1}") for i in range(k)])
    return comps, scores


def _varimax(L: np.ndarray, max_iter: int = 100, tol: float = 1e-8) -> np.ndarray:
    """Kaiser varimax rotation of a d x k loading matrix (small, driver)."""
    d, k = L.shape
    R = np.eye(k)
    last = 0.0
    for _ in range(max_iter):
        Lr = L @ R
        u, s, vt = np.linalg.svd(L.T @ (Lr ** 3 - Lr @ np.diag((Lr ** 2).sum(axis=0)) / d))
        R = u @ vt
        if s.sum() < last * (1 + tol):
            break
        last = s.sum()
    return L @ R


def factor_analysis(df: DataFrame, cols, k: int = 3, rotation: str | None = "varimax",
                    max_iter: int = 200, tol: float = 1e-6):
    """Principal-axis factoring of the correlation matrix (communalities
    start at the squared multiple correlations and are iterated), optional
    varimax rotation, regression (Thurstone) scores ``z . R^-1 L`` computed
    on Spark.  Returns ``(loadings(col, factor, value), scores)``."""
    R = _matrix(df, cols, "corr")
    h2 = 1 - 1 / np.diag(np.linalg.inv(R))
    for _ in range(max_iter):
        Rr = R.copy()
        np.fill_diagonal(Rr, h2)
        vals, vecs = np.linalg.eigh(Rr)
        order = np.argsort(vals)[::-1][:k]
        L = vecs[:, order] * np.sqrt(np.clip(vals[order], 0, None))
        new = (L ** 2).sum(axis=1)
        if np.abs(new - h2).max() < tol:
            h2 = new
            break
        h2 = new
    if rotation == "varimax" and k > 1:
        L = _varimax(L)
    L = _fix_signs(L)
    B = np.linalg.solve(R, L)
    spark = df.sparkSession
    loadings = spark.createDataFrame(
        [(c, f + 1, float(L[i, f])) for i, c in enumerate(cols) for f in range(k)],
        "col string, factor int, value double")
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                   *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols])
    j = attach_row(df, stats)
    z = {c: (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}") for c in cols}
    scores = j.select(*[sum((z[c] * float(B[i, f]) for i, c in enumerate(cols)), F.lit(0.0))
                        .alias(f"factor{f + 1}") for f in range(k)])
    return loadings, scores
