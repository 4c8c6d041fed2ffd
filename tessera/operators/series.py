"""Time-series diagnosis over many series at once (Z1--Z4, Z7).

Input rows ``(series_id, pos, x)`` on a regular calendar (``pos`` =
0, 1, ...).  Windows are partitioned by series; a series is one value per
period, so its length is bounded by the calendar, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import relational as R


def decompose(df: DataFrame, series="series_id", pos="pos", x="x", period: int = 12) -> DataFrame:
    """Additive decomposition: trend = centred moving average (2 x
    period), seasonal = phase means of the detrended series, centred over
    the phases, residual = x - trend - seasonal."""
    s = [series] if isinstance(series, str) else list(series)
    d = R.centered_ma(df, s, pos, x, period, "trend")
    d = d.withColumn("_phase", F.col(pos) % period)
    ph = (d.groupBy(*s, "_phase").agg(F.avg(F.col(x) - F.col("trend")).alias("_pm")))
    ph = ph.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(Window.partitionBy(*s)))
    out = d.join(ph.select(*s, "_phase", "seasonal"), s + ["_phase"])
    return out.select(*s, pos, x, "trend", "seasonal",
                      (F.col(x) - F.col("trend") - F.col("seasonal")).alias("resid"))


def box_cox_grid(df: DataFrame, series="series_id", x="x", lambdas=None) -> DataFrame:
    """Z3: profile log-likelihood of the Box-Cox transform on a grid of
    lambda values, ``(lambda - 1) sum ln x - n/2 ln(var(y_lambda))`` with the
    population variance; returns every (series, lambda, llf)."""
    spark = df.sparkSession
    lambdas = lambdas or [round(-2 + 0.1 * i, 1) for i in range(41)]
    lam = F.broadcast(spark.createDataFrame([(float(v),) for v in lambdas], "lam double"))
    s = [series] if isinstance(series, str) else list(series)
    j = df.select(*s, x).crossJoin(lam)
    y = F.when(F.col("lam") == 0, F.ln(x)).otherwise((F.pow(F.col(x), F.col("lam")) - 1)
                                                      / F.col("lam"))
    j = j.withColumn("_y", y)
    g = j.groupBy(*s, "lam").agg(F.count(F.lit(1)).alias("n"), F.sum(F.ln(x)).alias("sl"),
                                 F.var_pop("_y").alias("v"))
    return g.select(*s, F.col("lam").alias("lambda"),
                    ((F.col("lam") - 1) * F.col("sl") - F.col("n") / 2 * F.ln("v")).alias("llf"))


def box_cox_best(grid: DataFrame, series="series_id") -> DataFrame:
    s = [series] if isinstance(series, str) else list(series)
    w = Window.partitionBy(*s).orderBy(F.desc("llf"), F.asc("lambda"))
    return grid.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def _acf_lists(df: DataFrame, s, pos: str, x: str, lags: int) -> DataFrame:
    """One row a series: ``_r``, its autocorrelations of lag 0 .. lags, and ``_n``.
    The lagged values are columns of one window, their products one aggregate."""
    every, order = Window.partitionBy(*s), Window.partitionBy(*s).orderBy(pos)
    c = df.select(*s, pos, (F.col(x) - F.avg(x).over(every)).alias("_c"))
    c = c.select(*s, "_c", *[F.lag("_c", k).over(order).alias(f"_c{k}") for k in range(1, lags + 1)])
    den = F.sum(F.col("_c") * F.col("_c"))
    g = c.groupBy(*s).agg(F.count(F.lit(1)).alias("_n"), F.array(F.try_divide(den, den), *[
        F.try_divide(F.sum(F.col("_c") * F.col(f"_c{k}")), den) for k in range(1, lags + 1)]).alias("_r"))
    return g.select(*s, "_n", F.slice("_r", F.lit(1), F.least(F.col("_n"), F.lit(lags + 1)).cast("int")).alias("_r"))


def acf(df: DataFrame, series="series_id", pos="pos", x="x", lags: int = 50) -> DataFrame:
    """Autocorrelation ``sum (x_t - m)(x_{t+k} - m) / sum (x_t - m)^2``
    for k = 0..lags, as far as the series reaches, with the 95 % band
    ``1.96 / sqrt(n)``; null for a constant series."""
    s = [series] if isinstance(series, str) else list(series)
    return _acf_lists(df, s, pos, x, lags).select(*s, F.posexplode("_r").alias("lag", "acf"), (1.96 / F.sqrt("_n")).alias("band"))


_SUM = "aggregate({}, 0D, (u, v) -> u + v)"


def pacf(df: DataFrame, series="series_id", pos="pos", x="x", lags: int = 50) -> DataFrame:
    """Partial autocorrelation for k = 0..lags by the Durbin-Levinson recursion
    over the autocorrelations, with the same band; null for a constant series.

    Per series the recursion runs inside one row: ``phi`` holds the coefficients of
    the autoregression of order k - 1, the next one's last is the new value."""
    s = [series] if isinstance(series, str) else list(series)
    num = f"get(_r, k) - {_SUM.format('transform(a.phi, (p, i) -> p * get(_r, k - 1 - i))')}"
    den = f"1D - {_SUM.format('transform(a.phi, (p, i) -> p * get(_r, i + 1))')}"
    step = ("named_struct('phi', cast(concat(transform(a.phi, (p, i) -> p - q * get(a.phi, k - 2 - i)), array(q)) as array<double>), "
            "'out', cast(concat(a.out, array(q)) as array<double>))")
    start = "named_struct('phi', cast(array() as array<double>), 'out', cast(array(get(_r, 0)) as array<double>))"
    out = F.expr(f"aggregate(if(size(_r) > 1, sequence(1, size(_r) - 1), cast(array() as array<int>)), {start}, (a, k) -> "
                 f"transform(array(try_divide({num}, {den})), q -> {step})[0], a -> a.out)")
    return _acf_lists(df, s, pos, x, lags).select(*s, "_n", out.alias("_o")).select(
        *s, F.posexplode("_o").alias("lag", "pacf"), (1.96 / F.sqrt("_n")).alias("band"))


def t_test(df: DataFrame, series="series_id", x="resid") -> DataFrame:
    """One-sample t statistic of the mean against 0 (sample sd); null
    for a constant or a single value."""
    s = [series] if isinstance(series, str) else list(series)
    return df.groupBy(*s).agg(
        F.count(x).alias("n"),
        F.try_divide(F.avg(x), F.try_divide(F.stddev_samp(x), F.sqrt(F.count(x)))).alias("t"))


# Fixed value: asymptotic 5 % critical value of the Dickey-Fuller test with
# a constant (MacKinnon).
ADF_CRIT_5 = -2.8621


def adf(df: DataFrame, series="series_id", pos="pos", x="x", max_lag: int = 12) -> DataFrame:
    """Augmented Dickey-Fuller statistic per series (constant, fixed lag
    order ``max_lag``) by least squares in ``applyInPandas``; one group is
    one series (bounded by the calendar length)."""
    s = [series] if isinstance(series, str) else list(series)

    def fit(pdf):
        import numpy as np
        import pandas as pd
        pdf = pdf.sort_values(pos)
        v = pdf[x].to_numpy(dtype=float)
        dv = np.diff(v)
        p = max_lag
        rows = []
        for t in range(p, len(dv)):
            rows.append([1.0, v[t]] + [dv[t - i] for i in range(1, p + 1)] + [dv[t]])
        key = {c: pdf[c].iloc[0] for c in s}
        if len(rows) <= p + 3:
            return pd.DataFrame([{**key, "stat": None, "n_obs": len(rows)}])
        m = np.array(rows)
        X, y = m[:, :-1], m[:, -1]
        beta, *_ = np.linalg.lstsq(X, y, rcond=None)
        resid = y - X @ beta
        dof = len(y) - X.shape[1]
        sigma2 = resid @ resid / dof
        try:
            cov = sigma2 * np.linalg.inv(X.T @ X)
            stat = float(beta[1] / np.sqrt(cov[1, 1]))
        except np.linalg.LinAlgError:
            stat = None
        return pd.DataFrame([{**key, "stat": stat, "n_obs": len(rows)}])

    types = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in s)
    out = df.groupBy(*s).applyInPandas(fit, f"{types}, stat double, n_obs long")
    return out.select("*", F.lit(ADF_CRIT_5).alias("crit5"),
                      (F.col("stat") < ADF_CRIT_5).alias("stationary"))


def _arma_fit(v, p, q, long_ar):
    """Hannan-Rissanen: long AR by least squares gives innovations; then
    least squares of v_t on p lags of v and q lags of the innovations.
    Returns (coefficients, sigma2, n_used, ok)."""
    import numpy as np
    n = len(v)
    m = long_ar
    if n <= m + max(p, q) + 3:
        return None, None, 0, False
    X = np.column_stack([np.ones(n - m)] + [v[m - i:n - i] for i in range(1, m + 1)])
    beta, *_ = np.linalg.lstsq(X, v[m:], rcond=None)
    e = np.zeros(n)
    e[m:] = v[m:] - X @ beta
    start = m + max(p, q)
    cols = [np.ones(n - start)]
    cols += [v[start - i:n - i] for i in range(1, p + 1)]
    cols += [e[start - j:n - j] for j in range(1, q + 1)]
    Z = np.column_stack(cols)
    y = v[start:]
    coef, *_ = np.linalg.lstsq(Z, y, rcond=None)
    r = y - Z @ coef
    return coef, float(r @ r / len(y)), len(y), True


def arma_grid(df: DataFrame, series="series_id", pos="pos", x="x", period: int = 12,
              ps=(0, 1, 2, 3), qs=(0, 1, 2), long_ar: int = 12) -> DataFrame:
    """Z5 (re-aimed SARIMA grid): after a seasonal difference of order
    ``period`` (D = 1), fit ARMA(p, q) with constant by Hannan-Rissanen for
    every (series, p, q) -- one bounded group each, all in parallel -- and
    report ``aic = n ln(sigma2) + 2 (p + q + 1)``; failures get a status."""
    s = [series] if isinstance(series, str) else list(series)
    spark = df.sparkSession
    grid = F.broadcast(spark.createDataFrame([(p, q) for p in ps for q in qs], "p int, q int"))
    d = df.select(*s, pos, x).crossJoin(grid)

    def fit(pdf):
        import numpy as np
        import pandas as pd
        pdf = pdf.sort_values(pos)
        v = pdf[x].to_numpy(float)
        v = v[period:] - v[:-period]
        p, q = int(pdf["p"].iloc[0]), int(pdf["q"].iloc[0])
        key = {c: pdf[c].iloc[0] for c in s}
        try:
            coef, s2, n, ok = _arma_fit(v, p, q, long_ar)
            aic = n * np.log(s2) + 2 * (p + q + 1) if ok and s2 > 0 else None
            status = "ok" if aic is not None else "too short"
        except np.linalg.LinAlgError as err:  # skip failing parameter sets
            aic, status = None, f"failed: {err}"
        return pd.DataFrame([{**key, "p": p, "q": q, "aic": aic, "status": status}])

    types = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in s)
    return d.groupBy(*s, "p", "q").applyInPandas(
        fit, f"{types}, p int, q int, aic double, status string")


def arma_best(grid: DataFrame, series="series_id") -> DataFrame:
    s = [series] if isinstance(series, str) else list(series)
    w = Window.partitionBy(*s).orderBy(F.asc_nulls_last("aic"), "p", "q")
    return (grid.filter(F.col("aic").isNotNull()).withColumn("_r", F.row_number().over(w))
            .filter("_r = 1").drop("_r"))


def arma_forecast(df: DataFrame, best: DataFrame, series="series_id", pos="pos", x="x",
                  period: int = 12, steps: int = 12, long_ar: int = 12,
                  z: float = 1.96) -> DataFrame:
    """Forecast ``steps`` periods ahead with the chosen ARMA(p, q) on the
    seasonal difference, undone by adding the value one period earlier;
    the 95 % band comes from the psi-weights of the ARMA part (the
    seasonal integration adds psi_{j-period} terms)."""
    s = [series] if isinstance(series, str) else list(series)
    d = df.select(*s, pos, x).join(best.select(*s, "p", "q"), s)

    def fc(pdf):
        import numpy as np
        import pandas as pd
        pdf = pdf.sort_values(pos)
        lvl = pdf[x].to_numpy(float)
        v = lvl[period:] - lvl[:-period]
        p, q = int(pdf["p"].iloc[0]), int(pdf["q"].iloc[0])
        coef, s2, _, ok = _arma_fit(v, p, q, long_ar)
        key = {c: pdf[c].iloc[0] for c in s}
        last = int(pdf[pos].iloc[-1])
        if not ok:
            return pd.DataFrame([{**key, pos: last + h, "mean": None, "lo": None, "hi": None}
                                 for h in range(1, steps + 1)])
        c0, phi, theta = coef[0], coef[1:1 + p], coef[1 + p:]
        # innovations of the fitted model for the MA part
        e = np.zeros(len(v))
        for t in range(max(p, q), len(v)):
            e[t] = v[t] - c0 - sum(phi[i] * v[t - 1 - i] for i in range(p)) \
                - sum(theta[j] * e[t - 1 - j] for j in range(q))
        vv, ee = list(v), list(e)
        for _ in range(steps):
            t = len(vv)
            nxt = c0 + sum(phi[i] * vv[t - 1 - i] for i in range(p)) \
                + sum(theta[j] * ee[t - 1 - j] for j in range(q))
            vv.append(nxt)
            ee.append(0.0)
        # psi weights of ARMA, then of (1 - B^period)^-1 applied to it
        psi = [1.0]
        for j in range(1, steps):
            val = (theta[j - 1] if j - 1 < q else 0.0) + sum(
                phi[i] * psi[j - 1 - i] for i in range(p) if j - 1 - i >= 0)
            psi.append(val)
        tot = [sum(psi[j - m * period] for m in range(j // period + 1)) for j in range(steps)]
        levels = list(lvl)
        out = []
        for h in range(1, steps + 1):
            levels.append(vv[len(v) + h - 1] + levels[-period])
            sd = float(np.sqrt(s2 * sum(t * t for t in tot[:h])))
            m = levels[-1]
            out.append({**key, pos: last + h, "mean": m, "lo": m - z * sd, "hi": m + z * sd})
        return pd.DataFrame(out)

    types = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in s)
    return d.groupBy(*s).applyInPandas(
        fc, f"{types}, {pos} long, mean double, lo double, hi double")


def supervised_forecast(df: DataFrame, series="series_id", pos="pos", x="x", k: int = 4,
                        period: int = 12, neighbours: int = 2, train_frac: float = 0.8):
    """Look-back frame on the seasonal difference (W3 + W4), kNN
    regression (manhattan, distance weights) trained on the first
    ``train_frac`` of the calendar, prediction turned back into a level by
    adding the value one period earlier (W5); returns ``(rows, rmse)``."""
    from tessera.operators import supervised as M
    s = [series] if isinstance(series, str) else list(series)
    d = R.seasonal_diff(df, s, pos, x, period, "_d").filter(F.col("_d").isNotNull())
    lb = R.look_back(d, s, pos, "_d", k)
    w = Window.partitionBy(*s).orderBy(pos)
    lvl = df.select(*s, pos, F.col(x).alias("level"),
                    F.lag(x, period).over(w).alias("_prev"))
    lb = lb.join(lvl, s + [pos]).withColumn(
        "_id", F.col(s[0]).cast("long") * 1000003 + F.col(pos))
    cut = lb.agg(F.max(pos).alias("_m")).select((F.col("_m") * train_frac).alias("_c"))
    lb = R.attach_row(lb, cut)
    train = lb.filter(F.col(pos) <= F.col("_c")).select(F.col("_id").alias("id"),
                                                         F.col("features").alias("vec"), "y")
    test = lb.filter(F.col(pos) > F.col("_c"))
    nb = M.knn_join(test.select(F.col("_id").alias("id"), F.col("features").alias("vec")),
                    train, neighbours, "manhattan", exclude_self=False)
    pred = M.knn_regress(nb, "y")
    rows = (test.join(pred, test["_id"] == pred["qid"])
            .select(*s, pos, "level", (F.col("pred") + F.col("_prev")).alias("yhat")))
    return rows, M.score(rows, "level", "yhat", "rmse")
