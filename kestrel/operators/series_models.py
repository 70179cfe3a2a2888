"""Per-series solvers: augmented Dickey–Fuller with lag selection, ARIMA fitting, order
grid search and forecasting.

Each series is a group of period rows (bounded by the calendar); the solvers run
in ``applyInPandas`` with numpy on one series (or one (series, order) pair) at a
time, so the work spreads over as many tasks as there are groups.  Model-order
grids replicate a series per order with ``explode`` (no join), letting every
(series, order) fit run in its own group.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.timeseries import S, T, V

# MacKinnon (1994) p-value approximation for the Dickey–Fuller statistic,
# regression with a constant, one variable (tau bounds, small- and large-p polynomials).
MACKINNON_TAU_MAX, MACKINNON_TAU_MIN, MACKINNON_TAU_STAR = 2.74, -18.83, -1.61
MACKINNON_SMALL_P = (2.1659, 1.4412, 0.038269)
MACKINNON_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
# Asymptotic critical values (1 %, 5 %, 10 %), constant only.
ADF_CRITICAL = (-3.43035, -2.86154, -2.56677)


def _norm_cdf(x: float) -> float:
    return 0.5 * (1.0 + math.erf(x / math.sqrt(2.0)))


def mackinnon_p(tau: float) -> float:
    if tau > MACKINNON_TAU_MAX:
        return 1.0
    if tau < MACKINNON_TAU_MIN:
        return 0.0
    coef = MACKINNON_SMALL_P if tau <= MACKINNON_TAU_STAR else MACKINNON_LARGE_P
    return _norm_cdf(sum(c * tau ** i for i, c in enumerate(coef)))


# ---------------------------------------------------------------- ADF with lag selection
def _ols(y: np.ndarray, x: np.ndarray):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ beta
    return beta, resid


def adf_statistic(y: np.ndarray, max_lag: int | None = None, autolag: bool = True):
    """Δy_t = α + γ y_{t−1} + Σ_{i≤p} δ_i Δy_{t−i}; p chosen by AIC on a common sample."""
    y = np.asarray(y, dtype=float)
    n = len(y)
    if max_lag is None:
        max_lag = int(math.ceil(12.0 * (n / 100.0) ** 0.25))
    max_lag = max(0, min(max_lag, n // 2 - 2))
    dy = np.diff(y)

    def design(p, start):
        rows = range(start, len(dy))
        x = [[1.0, y[t]] + [dy[t - i] for i in range(1, p + 1)] for t in rows]
        return np.array([dy[t] for t in rows]), np.array(x)

    best_p = max_lag
    if autolag:
        best_aic = np.inf
        for p in range(0, max_lag + 1):
            yy, xx = design(p, max_lag)
            if len(yy) <= xx.shape[1]:
                continue
            _, res = _ols(yy, xx)
            nobs = len(yy)
            aic = nobs * math.log(max(float(res @ res) / nobs, 1e-300)) + 2 * xx.shape[1]
            if aic < best_aic:
                best_aic, best_p = aic, p
    yy, xx = design(best_p, best_p)
    beta, res = _ols(yy, xx)
    nobs, k = xx.shape
    s2 = float(res @ res) / (nobs - k)
    cov = s2 * np.linalg.inv(xx.T @ xx)
    tau = beta[1] / math.sqrt(cov[1, 1])
    return float(tau), int(best_p), int(nobs)


def augmented_dickey_fuller(df: DataFrame, max_lag: int | None = None, series: str = S, ts: str = T,
                            value: str = V) -> DataFrame:
    """ADF statistic, chosen lag, MacKinnon p-value and critical values per series."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(ts)[value].dropna().to_numpy(dtype=float)
        try:
            tau, lag, nobs = adf_statistic(y, max_lag)
            p = mackinnon_p(tau)
        except (ValueError, np.linalg.LinAlgError, ZeroDivisionError):  # too short or singular
            tau, lag, nobs, p = float("nan"), -1, len(y), float("nan")
        return pd.DataFrame({series: [pdf[series].iloc[0]], "adf_stat": [tau], "used_lag": [lag], "n_obs": [nobs],
                             "p_value": [p], "crit_1pct": [ADF_CRITICAL[0]], "crit_5pct": [ADF_CRITICAL[1]],
                             "crit_10pct": [ADF_CRITICAL[2]]})

    schema = (f"{series} string, adf_stat double, used_lag int, n_obs int, p_value double, "
              "crit_1pct double, crit_5pct double, crit_10pct double")
    return df.groupBy(series).applyInPandas(solve, schema)


# ---------------------------------------------------------------- ARIMA
def _lags(x: np.ndarray, t: int, k: int) -> list[float]:
    return [x[t - i] for i in range(1, k + 1)]


def arima_fit(y: np.ndarray, p: int, d: int, q: int, horizon: int = 0, p_max: int | None = None, q_max: int | None = None):
    """Conditional least squares ARIMA(p, d, q) with a constant; MA terms by Hannan–Rissanen
    (long autoregression residuals as regressors).  All orders up to (p_max, d, q_max) are
    fitted to the same rows, so their AICs compare.  Returns (aic, fitted levels aligned with
    ``y`` — NaN where undefined —, forecasts of ``horizon`` future levels); raises
    ``ValueError`` for a series too short for the order."""
    p_max, q_max = p if p_max is None else p_max, q if q_max is None else q_max
    y = np.asarray(y, dtype=float)
    z = np.diff(y, n=d) if d else y.copy()
    n = len(z)
    e = np.zeros(n)
    start = p_max
    if q_max > 0:
        m = max(p_max + q_max, min(int(10 * math.log10(max(n, 10))), n // 4))
        if n - m <= m + 1:
            raise ValueError("series too short")
        ya = np.array([z[t] for t in range(m, n)])
        xa = np.array([[1.0] + _lags(z, t, m) for t in range(m, n)])
        _, ra = _ols(ya, xa)
        e[m:] = ra
        start = m + q_max
    rows = range(start, n)
    if len(rows) <= 1 + p + q:
        raise ValueError("series too short")
    yy = np.array([z[t] for t in rows])
    xx = np.array([[1.0] + _lags(z, t, p) + _lags(e, t, q) for t in rows])
    beta, res = _ols(yy, xx)
    nobs = len(yy)
    sigma2 = float(res @ res) / nobs
    llf = -0.5 * nobs * (math.log(2 * math.pi * max(sigma2, 1e-300)) + 1.0)
    aic = -2.0 * llf + 2.0 * (p + q + 2)
    zhat = np.full(n, np.nan)
    zhat[start:] = xx @ beta
    e_full = e.copy()
    e_full[start:] = res
    # fitted levels: undo the differencing with the observed history
    fitted = np.full(len(y), np.nan)
    fitted[d:] = zhat
    for k in range(1, d + 1):
        fitted[d:] += (-1) ** (k + 1) * math.comb(d, k) * y[d - k:len(y) - k]
    fc = []
    if horizon:
        zz, ee = list(z), list(e_full)
        for _ in range(horizon):
            t = len(zz)
            x = [1.0] + [zz[t - i] for i in range(1, p + 1)] + [ee[t - i] for i in range(1, q + 1)]
            zz.append(float(np.dot(beta, x)))
            ee.append(0.0)
        zf = np.array(zz[n:])
        if d == 0:
            fc = zf
        else:
            # integrate d times from the last observed values
            hist = [y]
            for _ in range(d - 1):
                hist.append(np.diff(hist[-1]))
            cur = zf
            for level in reversed(hist):
                cur = level[-1] + np.cumsum(cur)
            fc = cur
    return aic, fitted, np.asarray(fc, dtype=float)


def arima_order_grid(df: DataFrame, p_max: int = 4, d_max: int = 4, q_max: int = 4, series: str = S, ts: str = T,
                     value: str = V) -> DataFrame:
    """AIC of every order (p, d, q) per series; an order that cannot be fitted gives a NULL AIC and the reason."""
    orders = [(p, d, q) for p in range(p_max + 1) for d in range(d_max + 1) for q in range(q_max + 1)]
    grid = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(d).alias("d"), F.lit(q).alias("q")) for p, d, q in orders])
    rep = df.select(series, ts, value, F.explode(grid).alias("o")).select(series, ts, value, "o.p", "o.d", "o.q")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts)
        p, d, q = int(pdf["p"].iloc[0]), int(pdf["d"].iloc[0]), int(pdf["q"].iloc[0])
        aic, reason = None, None
        try:
            aic, _, _ = arima_fit(pdf[value].to_numpy(dtype=float), p, d, q, p_max=p_max, q_max=q_max)
        except (ValueError, np.linalg.LinAlgError) as ex:
            reason = str(ex)
        return pd.DataFrame({series: [pdf[series].iloc[0]], "p": [p], "d": [d], "q": [q], "aic": [aic], "reason": [reason]})

    return rep.groupBy(series, "p", "d", "q").applyInPandas(fit, f"{series} string, p int, d int, q int, aic double, reason string")


def best_orders(grid: DataFrame, series: str = S) -> DataFrame:
    """Lowest-AIC order per series (ties → smallest (p, d, q))."""
    g = grid.filter(F.col("aic").isNotNull())
    return g.groupBy(series).agg(F.min_by(F.struct("p", "d", "q"), F.struct("aic", "p", "d", "q")).alias("o"),
                                 F.min("aic").alias("aic")).select(series, "o.p", "o.d", "o.q", "aic")


def arima_fitted(df: DataFrame, p: int, d: int, q: int, series: str = S, ts: str = T, value: str = V) -> DataFrame:
    """Actual vs fitted levels ``(series, ts, actual, fitted)`` for one order."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts)
        y = pdf[value].to_numpy(dtype=float)
        try:
            _, fitted, _ = arima_fit(y, p, d, q)
        except (ValueError, np.linalg.LinAlgError):  # too short
            fitted = np.full(len(y), np.nan)
        return pd.DataFrame({series: pdf[series].to_numpy(), ts: pdf[ts].to_numpy(), "actual": y, "fitted": fitted})

    return df.groupBy(series).applyInPandas(fit, f"{series} string, {ts} timestamp_ntz, actual double, fitted double")


def arima_forecast(df: DataFrame, p: int, d: int, q: int, horizon: int, months_per_step: int = 1,
                   series: str = S, ts: str = T, value: str = V) -> DataFrame:
    """``horizon`` future periods per series ``(series, ts, forecast)``; levels are rebuilt
    from the last observed values."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts)
        y = pdf[value].to_numpy(dtype=float)
        try:
            _, _, fc = arima_fit(y, p, d, q, horizon)
        except (ValueError, np.linalg.LinAlgError):  # too short
            fc = np.full(horizon, np.nan)
        return pd.DataFrame({series: pdf[series].iloc[0], "step": np.arange(1, horizon + 1, dtype="int32"),
                             "forecast": fc})

    steps = df.groupBy(series).applyInPandas(fit, f"{series} string, step int, forecast double")
    last = df.groupBy(series).agg(F.max(ts).alias("__last"))
    out = steps.join(last, series)
    return out.select(series, F.add_months(F.col("__last").cast("date"), F.col("step") * months_per_step)
                      .cast("timestamp_ntz").alias(ts), "step", "forecast")
