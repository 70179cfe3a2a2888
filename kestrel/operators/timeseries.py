"""Per-series time-series operators on long frames ``(series_id, ts, value)``.

Raw rows are first aggregated to the period grain (:func:`to_period_series`),
a hash aggregate with map-side combine, so even a series holding a third of all
rows becomes one row per period before any window runs.  Every window is
``partitionBy(series)`` over those period rows, whose number is bounded by the
calendar, not by the data volume.  Lag joins use equi-joins on
``(series, position)``, which spread one long series over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

S, T, V = "series_id", "ts", "value"


def _w(series: str = S, ts: str = T):
    return Window.partitionBy(series).orderBy(ts)


def to_period_series(df: DataFrame, series: str | Column, ts: str, value: str | Column, unit: str = "month",
                     how: str = "sum") -> DataFrame:
    """Raw rows → one row per (series, period start) with the aggregated value."""
    s = F.col(series) if isinstance(series, str) else series
    v = F.col(value) if isinstance(value, str) else value
    agg = {"sum": F.sum, "avg": F.avg, "count": F.count, "max": F.max, "min": F.min}[how]
    p = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")
    return df.groupBy(s.cast("string").alias(S), p.alias(T)).agg(agg(v).cast("double").alias(V))


def with_position(df: DataFrame, series: str = S, ts: str = T, col: str = "pos") -> DataFrame:
    """0-based position of each period within its series."""
    return df.withColumn(col, F.row_number().over(_w(series, ts)) - 1)


def rolling_stats(df: DataFrame, window: int = 12, series: str = S, ts: str = T, value: str = V) -> DataFrame:
    """Trailing mean and sample std over ``window`` rows; NULL until a full window exists."""
    w = _w(series, ts).rowsBetween(-(window - 1), 0)
    full = F.count(F.col(value)).over(w) == window
    return df.withColumns({"rolling_mean": F.when(full, F.avg(value).over(w)),
                           "rolling_std": F.when(full, F.stddev_samp(value).over(w))})


def detrend(df: DataFrame, window: int = 12, series: str = S, ts: str = T, value: str = V,
            out: str = "detrended") -> DataFrame:
    """value − trailing mean; rows without a full window are dropped."""
    r = rolling_stats(df, window, series, ts, value)
    return r.withColumn(out, F.col(value) - F.col("rolling_mean")).dropna(subset=[out]) \
            .drop("rolling_mean", "rolling_std")


def difference(df: DataFrame, lag: int = 1, order: int = 1, series: str = S, ts: str = T, value: str = V,
               out: str = "diff") -> DataFrame:
    """``value − value.shift(lag)`` applied ``order`` times (first rows become NULL)."""
    cur = F.col(value)
    res = df.withColumn(out, cur)
    for _ in range(order):
        res = res.withColumn(out, F.col(out) - F.lag(out, lag).over(_w(series, ts)))
    return res


def cumulative_sum(df: DataFrame, value: str, series: str = S, ts: str = T, out: str = "cumsum") -> DataFrame:
    """Running sum (inverse of a first difference); NULLs are skipped."""
    w = _w(series, ts).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def restore_from_log_diff(df: DataFrame, log_value: str, diff_col: str, series: str = S, ts: str = T,
                          out: str = "restored") -> DataFrame:
    """Back-transform of a differenced log series: first log value + running sum of the
    differences, then ``exp``."""
    w_all = _w(series, ts).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = F.first(log_value).over(w_all)
    w = _w(series, ts).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.exp(base + F.coalesce(F.sum(diff_col).over(w), F.lit(0.0))))


def backfill(df: DataFrame, value: str = V, series: str = S, ts: str = T, out: str | None = None) -> DataFrame:
    """Next non-null value (``fillna(method='bfill')``); trailing NULLs stay NULL."""
    w = _w(series, ts).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(out or value, F.first(value, ignorenulls=True).over(w))


def complete_calendar(df: DataFrame, unit: str = "day", series: str = S, ts: str = T) -> DataFrame:
    """Every period between each series' first and last period, missing ones with NULL values."""
    step = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH"}[unit]
    bounds = df.groupBy(series).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    grid = bounds.select(series, F.explode(F.expr(f"sequence(__lo, __hi, {step})")).alias(ts))
    return grid.join(df, on=[series, ts], how="left")


def partial_date(df: DataFrame, part: str, ts: str = T) -> DataFrame:
    """Rows of one year (``"1995"``) or month (``"1995-06"``): a closed-open range on ``ts``."""
    year, _, month = part.partition("-")
    lo = F.make_date(F.lit(int(year)), F.lit(int(month or 1)), F.lit(1))
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < F.add_months(lo, 1 if month else 12)))


def constant_over_index(df: DataFrame, value: str = V, series: str = S, out: str = "level") -> DataFrame:
    """The series' mean repeated over its index (the flat line a series is compared with)."""
    return df.join(df.groupBy(series).agg(F.avg(value).alias(out)), series)


def seasonal_decompose(df: DataFrame, period: int = 12, series: str = S, ts: str = T, value: str = V) -> DataFrame:
    """Additive classical decomposition: centred moving-average trend (2×period for an even
    period), per-phase mean of the detrended values centred to sum 0, residual."""
    w = _w(series, ts)
    h = period // 2
    if period % 2 == 0:
        a = F.sum(value).over(w.rowsBetween(-h, h - 1))
        b = F.sum(value).over(w.rowsBetween(-h + 1, h))
        n = F.count(value).over(w.rowsBetween(-h, h))
        trend = F.when(n == 2 * h + 1, (a + b) / F.lit(2.0 * period))
    else:
        n = F.count(value).over(w.rowsBetween(-h, h))
        trend = F.when(n == period, F.avg(value).over(w.rowsBetween(-h, h)))
    d = df.withColumns({"trend": trend, "__phase": (F.row_number().over(w) - 1) % period})
    phase_mean = d.groupBy(series, "__phase").agg(F.avg(F.col(value) - F.col("trend")).alias("__pm"))
    centred = phase_mean.withColumn("seasonal", F.col("__pm") - F.avg("__pm").over(Window.partitionBy(series)))
    out = d.join(centred.select(series, "__phase", "seasonal"), on=[series, "__phase"], how="left")
    return out.withColumn("resid", F.col(value) - F.col("trend") - F.col("seasonal")).drop("__phase")


def autocorrelation(df: DataFrame, max_lag: int = 50, series: str = S, ts: str = T, value: str = V) -> DataFrame:
    """ACF ``r_k = Σ (y_t−ȳ)(y_{t−k}−ȳ) / Σ (y_t−ȳ)²`` for k = 0..max_lag → ``(series, lag, acf)``.

    Lagged pairs come from an equi-join on ``(series, position)``; the join and the
    final aggregation are hash-partitioned on both keys, so one long series is spread
    over many tasks."""
    p = with_position(df.filter(F.col(value).isNotNull()), series, ts)
    m = p.groupBy(series).agg(F.avg(value).alias("__mean"), F.count(F.lit(1)).alias("__n"))
    c = p.join(m, series).select(series, "pos", "__n", (F.col(value) - F.col("__mean")).alias("d"))
    denom = c.groupBy(series).agg(F.sum(F.col("d") * F.col("d")).alias("__ss"))
    left = c.select(series, "__n", "pos", "d", F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag")) \
            .filter(F.col("lag") < F.col("__n"))
    right = c.select(series, F.col("pos").alias("__rpos"), F.col("d").alias("d_lag"))
    pairs = left.join(right, (left[series] == right[series]) & (left["pos"] - left["lag"] == right["__rpos"]), "left") \
                .drop(right[series])
    num = pairs.groupBy(series, "lag").agg(F.sum(F.col("d") * F.col("d_lag")).alias("__num"))
    return num.join(denom, series).select(series, "lag",
                                          (F.coalesce(F.col("__num"), F.lit(0.0)) / F.col("__ss")).alias("acf"))


# Asymptotic Dickey–Fuller critical values for a regression with a constant
# (MacKinnon 2010, first coefficient): 1 %, 5 %, 10 %.
DF_CRITICAL_CONSTANT = (-3.43035, -2.86154, -2.56677)


def durbin_levinson(r: Column) -> Column:
    """Partial autocorrelations 0..K (ARRAY) from the autocorrelations r_0..r_K, by the Durbin–Levinson
    recursion as a fold over the lags; NaN from the lag on at which the recursion breaks down."""
    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def step(state: Column, k: Column) -> Column:
        phi, seen = state["phi"], F.slice(r, F.lit(2), k - 1)              # phi_1..phi_{k-1}, r_1..r_{k-1}
        left = 1.0 - dot(phi, seen)
        last = F.when(left != 0, (F.get(r, k) - dot(phi, F.reverse(seen))) / left).otherwise(F.lit(float("nan")))
        # one-element array: the new coefficient is computed once
        return F.get(F.transform(F.array(last), lambda p: F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - p * y), F.array(p)).alias("phi"),
            F.concat(state["out"], F.array(p)).alias("out"))), 0)

    start = F.struct(F.array().cast("array<double>").alias("phi"), F.array(F.lit(1.0)).alias("out"))
    lags = F.when(F.size(r) > 1, F.sequence(F.lit(1), F.size(r) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(lags, start, step, lambda s: s["out"])


def partial_autocorrelation(df: DataFrame, max_lag: int = 50, series: str = S, ts: str = T, value: str = V) -> DataFrame:
    """``(series, lag, pacf)`` for lags 0..``max_lag`` by ``durbin_levinson`` over the autocorrelations of each series."""
    acf = autocorrelation(df, max_lag, series, ts, value)
    r = F.transform(F.sort_array(F.collect_list(F.struct("lag", "acf"))), lambda x: x["acf"])  # max_lag + 1 values at most
    return acf.groupBy(series).agg(r.alias("r")).select(series, F.posexplode(durbin_levinson(F.col("r"))).alias("lag", "pacf"))


def dickey_fuller(df: DataFrame, series: str = S, ts: str = T, value: str = V) -> DataFrame:
    """Dickey–Fuller test without augmentation: Δy_t = α + β·y_{t−1} + e; returns the
    t-statistic of β per series from closed-form regression aggregates (one pass)."""
    w = _w(series, ts)
    lagged = df.select(series, F.col(value).alias("y"), F.lag(value).over(w).alias("ylag")) \
               .withColumn("dy", F.col("y") - F.col("ylag")).dropna(subset=["dy", "ylag"])
    g = lagged.groupBy(series).agg(F.regr_count("dy", "ylag").alias("n"), F.regr_slope("dy", "ylag").alias("beta"),
                                   F.regr_sxx("dy", "ylag").alias("sxx"), F.regr_sxy("dy", "ylag").alias("sxy"),
                                   F.regr_syy("dy", "ylag").alias("syy"))
    sse = F.col("syy") - F.col("beta") * F.col("sxy")
    se = F.sqrt(sse / (F.col("n") - 2) / F.col("sxx"))
    return g.select(series, F.col("n").cast("bigint").alias("n_obs"), "beta", (F.col("beta") / se).alias("adf_stat"),
                    F.lit(DF_CRITICAL_CONSTANT[0]).alias("crit_1pct"), F.lit(DF_CRITICAL_CONSTANT[1]).alias("crit_5pct"),
                    F.lit(DF_CRITICAL_CONSTANT[2]).alias("crit_10pct"))
