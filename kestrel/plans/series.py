"""Queries for the per-series window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import safe_ln
from kestrel.operators import timeseries as ts
from kestrel.plans.registry import register
from kestrel.sources.tables import load

R = 6
MONTHLY_SQL = """m AS (SELECT o_orderpriority AS series_id, date_trunc('month', o_orderdate) AS ts,
                      ln(sum(o_totalprice)) AS value FROM orders GROUP BY 1, 2)"""
W12 = "(PARTITION BY series_id ORDER BY ts ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"


def monthly_log_totals(spark, sf):
    """Log of monthly order totals per priority: the period-grain series the operators use."""
    m = ts.to_period_series(load(spark, sf, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice", "month")
    return m.withColumn("value", safe_ln("value"))


def _out(df, cols, d=R):
    return df.withColumns({c: F.round(c, d) for c in cols}).withColumn("ts", F.date_format("ts", "yyyy-MM-dd"))


@register("monthly_rolling_stats", sql=f"""
WITH {MONTHLY_SQL}
SELECT series_id, strftime(ts, '%Y-%m-%d') AS ts, round(value, 6) AS value,
       round(CASE WHEN count(value) OVER {W12} = 12 THEN avg(value) OVER {W12} END, 6) AS rolling_mean,
       round(CASE WHEN count(value) OVER {W12} = 12 THEN stddev_samp(value) OVER {W12} END, 6) AS rolling_std
FROM m
""", headline=True)
def monthly_rolling_stats(spark, sf):
    """12-month trailing mean and std, NULL until 12 months exist."""
    return _out(ts.rolling_stats(monthly_log_totals(spark, sf), 12), ["value", "rolling_mean", "rolling_std"])


@register("monthly_detrended", sql=f"""
WITH {MONTHLY_SQL},
r AS (SELECT series_id, ts, value - CASE WHEN count(value) OVER {W12} = 12 THEN avg(value) OVER {W12} END AS detrended FROM m)
SELECT series_id, strftime(ts, '%Y-%m-%d') AS ts, round(detrended, 6) AS detrended FROM r WHERE detrended IS NOT NULL
""")
def monthly_detrended(spark, sf):
    """Series minus its 12-month trailing mean, incomplete windows dropped."""
    return _out(ts.detrend(monthly_log_totals(spark, sf), 12).select("series_id", "ts", "detrended"), ["detrended"])


@register("monthly_difference_restore", sql=f"""
WITH {MONTHLY_SQL},
d AS (SELECT series_id, ts, value, value - lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS diff FROM m),
c AS (SELECT *, sum(diff) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumsum,
             first_value(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS base
      FROM d)
SELECT series_id, strftime(ts, '%Y-%m-%d') AS ts, round(diff, 6) AS diff, round(cumsum, 6) AS cumsum,
       round(exp(base + coalesce(cumsum, 0)), 2) AS restored
FROM c
""")
def monthly_difference_restore(spark, sf):
    """First difference of the log series, its running sum, and the exp back-transform."""
    m = monthly_log_totals(spark, sf)
    d = ts.difference(m, 1, 1)
    c = ts.cumulative_sum(d, "diff")
    r = ts.restore_from_log_diff(c, "value", "diff")
    out = r.select("series_id", "ts", F.round("diff", R).alias("diff"), F.round("cumsum", R).alias("cumsum"),
                   F.round("restored", 2).alias("restored"))
    return out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd"))


@register("daily_backfill", sql="""
WITH d AS (SELECT event_type AS series_id, date_trunc('day', ts) AS ts, sum(value) AS value FROM events GROUP BY 1, 2),
g AS (SELECT series_id, ts, CASE WHEN day(ts) % 4 <> 0 THEN value END AS value FROM d),
b AS (SELECT series_id, ts, first_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
                                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM g)
SELECT series_id, strftime(ts, '%Y-%m-%d') AS ts, round(value, 6) AS value FROM b WHERE value IS NOT NULL
""")
def daily_backfill(spark, sf):
    """Daily sums with gaps (every 4th day of the month blanked) filled from the next value."""
    d = ts.to_period_series(load(spark, sf, "events"), "event_type", "ts", "value", "day")
    g = d.withColumn("value", F.when(F.dayofmonth("ts") % 4 != 0, F.col("value")))
    b = ts.backfill(g).dropna(subset=["value"])
    return _out(b, ["value"])


@register("seasonal_decomposition", sql=f"""
WITH {MONTHLY_SQL},
d AS (SELECT series_id, ts, value,
        CASE WHEN count(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
             THEN (sum(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
                 + sum(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 24.0 END AS trend,
        (row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1) % 12 AS phase FROM m),
pm AS (SELECT series_id, phase, avg(value - trend) AS pm FROM d GROUP BY 1, 2),
c AS (SELECT series_id, phase, pm - avg(pm) OVER (PARTITION BY series_id) AS seasonal FROM pm)
SELECT d.series_id, strftime(ts, '%Y-%m-%d') AS ts, round(value, 6) AS value, round(trend, 6) AS trend,
       round(seasonal, 6) AS seasonal, round(value - trend - seasonal, 6) AS resid
FROM d JOIN c ON d.series_id = c.series_id AND d.phase = c.phase
""")
def seasonal_decomposition(spark, sf):
    """Additive decomposition with period 12."""
    s = ts.seasonal_decompose(monthly_log_totals(spark, sf), 12)
    return _out(s.select("series_id", "ts", "value", "trend", "seasonal", "resid"),
                ["value", "trend", "seasonal", "resid"])


ACF_SQL = MONTHLY_SQL + """,
p AS (SELECT series_id, value, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos FROM m),
s AS (SELECT series_id, avg(value) AS mu, count(*) AS n FROM p GROUP BY 1),
c AS (SELECT p.series_id, pos, value - mu AS d, n FROM p JOIN s ON p.series_id = s.series_id),
den AS (SELECT series_id, sum(d * d) AS ss FROM c GROUP BY 1),
lags AS (SELECT CAST(unnest(range(0, 51)) AS INTEGER) AS lag),
num AS (SELECT a.series_id, lag, sum(a.d * b.d) AS num
        FROM c a CROSS JOIN lags LEFT JOIN c b ON a.series_id = b.series_id AND b.pos = a.pos - lag
        WHERE lag < a.n GROUP BY 1, 2),
acf AS (SELECT num.series_id, lag, coalesce(num, 0) / ss AS acf FROM num JOIN den ON num.series_id = den.series_id)"""


@register("monthly_autocorrelation", sql=f"""
WITH {ACF_SQL}
SELECT series_id, lag, round(acf, 6) AS acf FROM acf
""")
def monthly_autocorrelation(spark, sf):
    """Autocorrelation for lags 0..50 per series."""
    a = ts.autocorrelation(monthly_log_totals(spark, sf), 50)
    return a.withColumn("acf", F.round("acf", R))


@register("dickey_fuller_lag0", sql=f"""
WITH {MONTHLY_SQL},
l AS (SELECT series_id, value - lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS dy,
             lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS ylag FROM m),
g AS (SELECT series_id, regr_count(dy, ylag) AS n, regr_slope(dy, ylag) AS beta, regr_sxx(dy, ylag) AS sxx,
             regr_sxy(dy, ylag) AS sxy, regr_syy(dy, ylag) AS syy FROM l WHERE dy IS NOT NULL AND ylag IS NOT NULL GROUP BY 1)
SELECT series_id, CAST(n AS BIGINT) AS n_obs, round(beta, 6) AS beta,
       round(beta / sqrt((syy - beta * sxy) / (n - 2) / sxx), 6) AS adf_stat,
       CAST(-3.43035 AS DOUBLE) AS crit_1pct, CAST(-2.86154 AS DOUBLE) AS crit_5pct, CAST(-2.56677 AS DOUBLE) AS crit_10pct
FROM g
""")
def dickey_fuller_lag0(spark, sf):
    """Dickey–Fuller statistic per series from regression aggregates (W9, no lags)."""
    d = ts.dickey_fuller(monthly_log_totals(spark, sf))
    return d.withColumns({"beta": F.round("beta", R), "adf_stat": F.round("adf_stat", R)})


@register("monthly_year_slice", sql=f"""
WITH {MONTHLY_SQL}
SELECT series_id, strftime(ts, '%Y-%m-%d') AS ts, round(value, 6) AS value FROM m WHERE year(ts) = 1995
""")
def monthly_year_slice(spark, sf):
    """Partial-date slice: all periods of one year."""
    return _out(ts.partial_date(monthly_log_totals(spark, sf), "1995").select("series_id", "ts", "value"), ["value"])


@register("monthly_mean_line", sql=f"""
WITH {MONTHLY_SQL}
SELECT series_id, strftime(ts, '%Y-%m-%d') AS ts, round(value, 6) AS value, round(avg(value) OVER (PARTITION BY series_id), 6) AS level FROM m
""")
def monthly_mean_line(spark, sf):
    """The series' mean as a constant over its index."""
    return _out(ts.constant_over_index(monthly_log_totals(spark, sf)).select("series_id", "ts", "value", "level"), ["value", "level"])


@register("daily_calendar", sql="""
WITH d AS (SELECT event_type AS series_id, CAST(date_trunc('day', ts) AS DATE) AS ts, sum(value) AS value FROM events GROUP BY 1, 2),
g AS (SELECT * FROM d WHERE day(ts) % 4 <> 0),
b AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM g GROUP BY 1),
c AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ts FROM b)
SELECT c.series_id, strftime(c.ts, '%Y-%m-%d') AS ts, round(g.value, 6) AS value FROM c LEFT JOIN g ON c.series_id = g.series_id AND c.ts = g.ts
""")
def daily_calendar(spark, sf):
    """Daily sums without every 4th day of the month, put back on a full calendar as gaps."""
    d = ts.to_period_series(load(spark, sf, "events"), "event_type", "ts", "value", "day")
    return _out(ts.complete_calendar(d.filter(F.dayofmonth("ts") % 4 != 0)).select("series_id", "ts", "value"), ["value"])


# ---------------------------------------------------------------- per-series solvers (no SQL twin)
from kestrel.operators import series_models as sm  # noqa: E402


@register("monthly_partial_autocorrelation", sql=f"""
WITH RECURSIVE {ACF_SQL},
r AS (SELECT series_id, list(acf ORDER BY lag) AS r FROM acf GROUP BY 1),
d AS (SELECT series_id, 0 AS lag, CAST([] AS DOUBLE[]) AS phi, CAST(1 AS DOUBLE) AS pacf, r FROM r
      UNION ALL
      SELECT series_id, lag + 1, list_concat(list_transform(phi, lambda x, j: x - p * phi[len(phi) + 1 - j]), [p]), p, r
      FROM (SELECT *, (r[lag + 2] - coalesce(list_sum(list_transform(phi, lambda x, j: x * r[lag + 2 - j])), 0))
                      / (1 - coalesce(list_sum(list_transform(phi, lambda x, j: x * r[j + 1])), 0)) AS p
            FROM d WHERE lag + 1 < len(r)))
SELECT series_id, lag, round(pacf, 6) AS pacf FROM d
""")
def monthly_partial_autocorrelation(spark, sf):
    """PACF for lags 0..50 per series by Durbin–Levinson over the ACF."""
    return ts.partial_autocorrelation(monthly_log_totals(spark, sf), 50).withColumn("pacf", F.round("pacf", R))


@register("monthly_augmented_dickey_fuller")
def monthly_augmented_dickey_fuller(spark, sf):
    """Augmented Dickey–Fuller with AIC lag choice, MacKinnon p-value."""
    return sm.augmented_dickey_fuller(monthly_log_totals(spark, sf))


@register("arima_order_search")
def arima_order_search(spark, sf):
    """AIC over the order grid p, d, q ∈ 0..4 per series (failed fits skipped) and the best
    order (W12, W13)."""
    grid = sm.arima_order_grid(monthly_log_totals(spark, sf), 4, 4, 4)
    return sm.best_orders(grid)


AR1_SQL = MONTHLY_SQL + """,
z AS (SELECT series_id, ts, value AS y, lag(value) OVER w AS y1, value - lag(value) OVER w AS z FROM m WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
p AS (SELECT *, lag(z) OVER (PARTITION BY series_id ORDER BY ts) AS z1 FROM z),
c AS (SELECT series_id, regr_slope(z, z1) AS b, regr_intercept(z, z1) AS a FROM p WHERE z IS NOT NULL AND z1 IS NOT NULL GROUP BY 1)"""


@register("arima_fitted_vs_actual", sql=f"""
WITH {AR1_SQL}
SELECT p.series_id, strftime(ts, '%Y-%m-%d') AS ts, round(exp(y), 2) AS actual, round(exp(y1 + a + b * z1), 2) AS fitted
FROM p JOIN c ON p.series_id = c.series_id
""")
def arima_fitted_vs_actual(spark, sf):
    """ARIMA(1,1,0) on the log series: actual vs fitted monthly totals in units."""
    f = sm.arima_fitted(monthly_log_totals(spark, sf), 1, 1, 0)
    return f.select("series_id", F.date_format("ts", "yyyy-MM-dd").alias("ts"),
                    F.round(F.exp("actual"), 2).alias("actual"), F.round(F.exp(F.nanvl("fitted", F.lit(None).cast("double"))), 2).alias("fitted"))


@register("arima_monthly_forecast", sql=f"""
WITH {AR1_SQL},
e AS (SELECT series_id, arg_max(y, ts) AS y, arg_max(z, ts) AS z, max(ts) AS ts FROM p GROUP BY 1),
k AS (SELECT CAST(unnest(range(1, 61)) AS INTEGER) AS step)
SELECT e.series_id, strftime(e.ts + to_months(step), '%Y-%m-%d') AS ts, step,
       round(exp(y + step * (a / (1 - b)) + (z - a / (1 - b)) * b * (1 - b ** step) / (1 - b)), 2) AS forecast
FROM e JOIN c ON e.series_id = c.series_id, k
""")
def arima_monthly_forecast(spark, sf):
    """Sixty months ahead from ARIMA(1,1,0) on the log series, back in units."""
    f = sm.arima_forecast(monthly_log_totals(spark, sf), 1, 1, 0, 60)
    return f.select("series_id", F.date_format("ts", "yyyy-MM-dd").alias("ts"), "step",
                    F.round(F.exp("forecast"), 2).alias("forecast"))
