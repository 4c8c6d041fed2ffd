"""Registered time-series queries (Z*) on the monthly order series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import series as Z
from tessera.plans.catalog import query
from tessera.plans.views_sql import with_views
from tessera.sources import tables as T


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


TREND = ("tr", """
SELECT series_id, pos, x,
       CASE WHEN count(x) OVER (PARTITION BY series_id ORDER BY pos
                                ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
            THEN (avg(x) OVER (PARTITION BY series_id ORDER BY pos
                              ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
                + avg(x) OVER (PARTITION BY series_id ORDER BY pos
                              ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2 END AS trend
FROM monthly""")
DECOMP = ("dec", """
SELECT tr.series_id, tr.pos, tr.x, tr.trend, s.seasonal, tr.x - tr.trend - s.seasonal AS resid
FROM tr JOIN (SELECT series_id, ph, pm - avg(pm) OVER (PARTITION BY series_id) AS seasonal
              FROM (SELECT series_id, pos % 12 AS ph, avg(x - trend) AS pm FROM tr
                    GROUP BY 1, 2) a) s
  ON tr.series_id = s.series_id AND tr.pos % 12 = s.ph""")


@query("Z2_seasonal_decompose", with_views(["monthly"], """
SELECT series_id, pos, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
       round(resid, 6) AS resid FROM dec""", [TREND, DECOMP]))
def z2(spark, sf):
    d = Z.decompose(T.monthly(spark, sf))
    return d.select("series_id", "pos", *[r6(c).alias(c) for c in ("trend", "seasonal", "resid")])


@query("Z7_residual_t_test", with_views(["monthly"], """
SELECT series_id, count(resid) AS n,
       round(avg(resid) / (stddev_samp(resid) / sqrt(count(resid))), 6) AS t
FROM dec GROUP BY 1""", [TREND, DECOMP]))
def z7(spark, sf):
    t = Z.t_test(Z.decompose(T.monthly(spark, sf)))
    return t.select("series_id", "n", r6("t").alias("t"))


@query("Z3_box_cox_lambda", with_views(["monthly"], """
WITH lam AS (SELECT i / 10.0 AS lam FROM range(-20, 21) t(i)),
g AS (SELECT m.series_id, lam.lam, count(*) AS n, sum(ln(m.x + 1)) AS sl,
             var_pop(CASE WHEN lam.lam = 0 THEN ln(m.x + 1)
                          ELSE (pow(m.x + 1, lam.lam) - 1) / lam.lam END) AS v
      FROM monthly m CROSS JOIN lam GROUP BY 1, 2),
l AS (SELECT series_id, lam, (lam - 1) * sl - n / 2 * ln(v) AS llf FROM g)
SELECT series_id, lam AS "lambda", round(llf, 6) AS llf FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY llf DESC, lam) AS r FROM l) x
WHERE r = 1"""))
def z3(spark, sf):
    m = T.monthly(spark, sf).withColumn("x", F.col("x") + 1)
    best = Z.box_cox_best(Z.box_cox_grid(m))
    return best.select("series_id", "lambda", r6("llf").alias("llf"))


def _acf_ctes(table: str, x: str):
    """Autocorrelations ``a`` (series_id, lag, acf, n) of a column."""
    return [("st", f"SELECT series_id, avg({x}) AS m, count(*) AS n FROM {table} WHERE {x} IS NOT NULL GROUP BY 1"),
            ("c", f"SELECT mo.series_id, mo.pos, mo.{x} - st.m AS c, st.n FROM {table} mo "
                  f"JOIN st ON mo.series_id = st.series_id WHERE mo.{x} IS NOT NULL"),
            ("den", "SELECT series_id, sum(c * c) AS den FROM c GROUP BY 1"),
            ("num", "SELECT a.series_id, CAST(k.lag AS INTEGER) AS lag, sum(a.c * b.c) AS num, max(a.n) AS n "
                    "FROM c a CROSS JOIN (SELECT i AS lag FROM range(0, 51) t(i)) k "
                    "JOIN c b ON b.series_id = a.series_id AND b.pos = a.pos + k.lag GROUP BY 1, 2"),
            ("a", "SELECT num.series_id, lag, num / den AS acf, n FROM num JOIN den ON num.series_id = den.series_id")]


@query("Z4_acf", with_views(["monthly"], """
SELECT series_id, lag, round(acf, 6) AS acf, round(1.96 / sqrt(n), 6) AS band FROM a""", _acf_ctes("monthly", "x")))
def z4(spark, sf):
    a = Z.acf(T.monthly(spark, sf), lags=50)
    return a.select("series_id", "lag", r6("acf").alias("acf"), r6("band").alias("band"))


@query("Z4_pacf", with_views(["monthly"], """
, r AS (SELECT series_id, list(acf ORDER BY lag) AS r, max(n) AS n FROM a GROUP BY 1),
p(series_id, k, phi, q) AS (
  SELECT series_id, 0, CAST([] AS DOUBLE[]), CAST(1 AS DOUBLE) FROM r
  UNION ALL
  SELECT series_id, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - t * phi[k + 1 - j]), t), t
  FROM (SELECT p.series_id, k, phi,
               (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])), 0))
               / (1 - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1])), 0)) AS t
        FROM p JOIN r ON p.series_id = r.series_id WHERE k < len(r) - 1) x)
SELECT p.series_id, CAST(k AS INTEGER) AS lag, round(q, 6) AS pacf, round(1.96 / sqrt(n), 6) AS band
FROM p JOIN r ON p.series_id = r.series_id""", _acf_ctes("monthly", "x")).replace("WITH", "WITH RECURSIVE", 1).replace("\n\n,", ",", 1))
def z4p(spark, sf):
    a = Z.pacf(T.monthly(spark, sf), lags=50)
    return a.select("series_id", "lag", r6("pacf").alias("pacf"), r6("band").alias("band"))


@query("Z7_residual_acf", with_views(["monthly"], """
SELECT series_id, lag, round(acf, 6) AS acf, round(1.96 / sqrt(n), 6) AS band, abs(acf) > 1.96 / sqrt(n) AND lag > 0 AS outside
FROM a""", [TREND, DECOMP] + _acf_ctes("dec", "resid")))
def z7a(spark, sf):
    a = Z.acf(Z.decompose(T.monthly(spark, sf)).dropna(subset=["resid"]), x="resid", lags=50)
    return a.select("series_id", "lag", r6("acf").alias("acf"), r6("band").alias("band"),
                    ((F.abs("acf") > F.col("band")) & (F.col("lag") > 0)).alias("outside"))


@query("Z1_adf")
def z1(spark, sf):
    return Z.adf(T.monthly(spark, sf), max_lag=12)


@query("Z5_arma_grid_best_aic")
def z5(spark, sf):
    return Z.arma_best(Z.arma_grid(T.monthly(spark, sf)))


@query("Z6_arma_forecast")
def z6(spark, sf):
    m = T.monthly(spark, sf)
    return Z.arma_forecast(m, Z.arma_best(Z.arma_grid(m)), steps=12)


@query("Z8_supervised_forecast_rmse")
def z8(spark, sf):
    _, rmse = Z.supervised_forecast(T.monthly(spark, sf))
    return rmse
