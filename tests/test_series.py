import datetime as dt
import math

import numpy as np

from kestrel.operators import series_models as sm
from kestrel.operators import timeseries as ts


def _series(spark, values, sid="a", start=dt.datetime(2000, 1, 1)):
    rows = [(sid, dt.datetime(start.year + (start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1, 1),
             None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, value double")


def test_rolling_null_until_full_window(spark):
    df = _series(spark, range(1, 14))
    r = ts.rolling_stats(df, 12).orderBy("ts").collect()
    assert all(x["rolling_mean"] is None for x in r[:11])
    assert r[11]["rolling_mean"] == 6.5 and r[12]["rolling_mean"] == 7.5


def test_diff_cumsum_roundtrip_and_backfill(spark):
    vals = [3.0, 5.0, 4.0, 8.0, 9.0]
    df = _series(spark, [math.log(v) for v in vals])
    d = ts.cumulative_sum(ts.difference(df), "diff")
    r = ts.restore_from_log_diff(d, "value", "diff").orderBy("ts").collect()
    assert [round(x["restored"], 9) for x in r] == vals
    g = _series(spark, [None, 1.0, None, None, 4.0, None])
    b = [x["value"] for x in ts.backfill(g).orderBy("ts").collect()]
    assert b == [1.0, 1.0, 4.0, 4.0, 4.0, None]


def test_decomposition_adds_up(spark):
    rng = np.random.default_rng(1)
    vals = [10 + 0.1 * i + 2 * math.sin(2 * math.pi * i / 12) + rng.normal(0, 0.1) for i in range(48)]
    d = ts.seasonal_decompose(_series(spark, vals), 12).orderBy("ts").collect()
    assert all(x["trend"] is None for x in d[:6]) and all(x["trend"] is None for x in d[-6:])
    for x in d[6:-6]:
        assert abs(x["trend"] + x["seasonal"] + x["resid"] - x["value"]) < 1e-9
    seas = {}
    for i, x in enumerate(d):
        seas[i % 12] = x["seasonal"]
    assert abs(sum(seas.values())) < 1e-9


def _ar1(n, phi, seed=3):
    rng = np.random.default_rng(seed)
    y = [0.0]
    for _ in range(n - 1):
        y.append(phi * y[-1] + rng.normal())
    return y


def test_acf_pacf_of_ar1(spark):
    df = _series(spark, _ar1(400, 0.7))
    acf = {r["lag"]: r["acf"] for r in ts.autocorrelation(df, 5).collect()}
    assert abs(acf[0] - 1.0) < 1e-12 and abs(acf[1] - 0.7) < 0.1
    y = np.array(_ar1(400, 0.7))
    d = y - y.mean()
    assert abs(acf[2] - (d[2:] @ d[:-2]) / (d @ d)) < 1e-12
    pacf = {r["lag"]: r["pacf"] for r in ts.partial_autocorrelation(df, 5).collect()}
    assert abs(pacf[1] - acf[1]) < 1e-12 and abs(pacf[2]) < 0.15


def test_arima_recovers_ar1_and_forecasts(spark):
    y = np.array(_ar1(500, 0.6, seed=5)) + 10
    aic, fitted, fc = sm.arima_fit(y, 1, 0, 0, horizon=3)
    resid = y[1:] - fitted[1:]
    assert np.isfinite(aic) and np.std(resid) < 1.2 and len(fc) == 3
    # random walk: d=1 forecast starts from the last value
    rw = np.cumsum(np.random.default_rng(2).normal(size=200))
    _, _, f1 = sm.arima_fit(rw, 0, 1, 0, horizon=2)
    assert abs(f1[0] - rw[-1]) < 1.0
    grid = sm.arima_order_grid(_series(spark, list(y[:120])), 1, 1, 1)
    best = sm.best_orders(grid).first()
    assert best["aic"] is not None and grid.count() == 8


def test_adf_separates_stationary_from_random_walk(spark):
    stat = _series(spark, _ar1(300, 0.3), sid="s")
    rw = _series(spark, list(np.cumsum(np.random.default_rng(4).normal(size=300))), sid="w")
    r = {x["series_id"]: x for x in sm.augmented_dickey_fuller(stat.unionByName(rw)).collect()}
    assert r["s"]["p_value"] < 0.01 and r["w"]["p_value"] > 0.05
    assert abs(sm.mackinnon_p(-2.86154) - 0.05) < 0.005
    lag0 = ts.dickey_fuller(stat).first()
    assert lag0["adf_stat"] < -8


def test_arima_orders_share_one_sample_and_all_differences_fit():
    r = np.random.default_rng(3)
    chosen = []
    for _ in range(25):
        y = r.normal(size=80)
        aic = {(p, q): sm.arima_fit(y, p, 0, q, p_max=2, q_max=2)[0] for p in range(3) for q in range(3)}
        chosen.append(min(aic, key=aic.get))
    assert sum(c == (0, 0) for c in chosen) >= 8          # white noise: no term needed, most often
    y = np.cumsum(np.cumsum(r.normal(size=120)))
    for d in range(5):
        for p in range(3):
            for q in range(3):
                aic, fitted, fc = sm.arima_fit(y, p, d, q, horizon=2, p_max=2, q_max=2)
                assert np.isfinite(aic) and np.isfinite(fc).all() and np.isfinite(fitted[-40:]).all()


def test_fitted_levels_of_a_polynomial_are_exact():
    y = np.arange(60.0) ** 2
    _, fitted, fc = sm.arima_fit(y, 0, 2, 0, horizon=2)
    assert np.allclose(fitted[2:], y[2:]) and np.allclose(fc, [3600.0, 3721.0])


def test_order_grid_gives_an_aic_or_a_reason(spark):
    grid = sm.arima_order_grid(_series(spark, [float(k % 7) + 0.01 * k * k for k in range(70)]), 2, 3, 2).collect()
    assert len(grid) == 36 and all((r["aic"] is None) != (r["reason"] is None) for r in grid)
