"""Queries for the scalar column functions (dates, geo, strings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import functions as kf
from kestrel.operators.aggregate import quantiles
from kestrel.plans.registry import register
from kestrel.sources.tables import coordinates_view, load, trip_text_view

R = 6  # decimals kept in compared doubles


def _trips(spark, sf):
    """Parsed trip rows: one timestamp for every feature, amounts as numbers."""
    t = trip_text_view(load(spark, sf, "orders"))
    return t.select("trip_id", kf.parse_trip_ts("pickup_text").alias("ts"),
                    kf.money_to_double("total_amount_text").alias("amount"), "category")


@register("trip_peak_weekend_summary", headline=True, sql="""
WITH t AS (SELECT o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts, o_totalprice AS amount FROM orders)
SELECT CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
       CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS peak_time,
       CAST(count(*) AS BIGINT) AS n_trips,
       round(avg(amount), 6) AS mean_amount,
       round(median(amount), 6) AS median_amount
FROM t WHERE month(ts) = 1
GROUP BY 1, 2
""")
def trip_peak_weekend_summary(spark, sf):
    """Flagship: two-format time text → month filter → null guard → weekend/peak groups."""
    f = _trips(spark, sf).filter(kf.in_month("ts", 1)).dropna(subset=["ts", "amount"])
    f = f.withColumns({"weekend": kf.is_weekend("ts"), "peak_time": kf.peak_time("ts")})
    keys = ["weekend", "peak_time"]
    counts = f.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_trips"), F.round(F.avg("amount"), R).alias("mean_amount"))
    return counts.join(quantiles(f, ["amount"], [0.5], by=keys), keys) \
                 .select(*keys, "n_trips", "mean_amount", F.round(F.col("q")[0], R).alias("median_amount"))


@register("trip_text_features", sql="""
SELECT o_orderkey AS trip_id,
       strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS ts_text,
       CASE WHEN hour(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))) BETWEEN 7 AND 9
              OR hour(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))) BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS peak_time,
       CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
       month(o_orderdate) = 1 AS is_jan,
       month(o_orderdate) = 2 AS is_feb,
       round(o_totalprice, 6) AS amount,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 24 AS INTEGER) END AS text_hour
FROM orders
""")
def trip_text_features(spark, sf):
    """Row-level features of the raw trip text (D1, D2, D3 hour, D4, T1)."""
    t = trip_text_view(load(spark, sf, "orders"))
    ts = kf.parse_trip_ts("pickup_text")
    return t.select("trip_id",
                    F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
                    kf.peak_time(ts).alias("peak_time"),
                    kf.is_weekend(ts).alias("weekend"),
                    kf.in_month(ts, 1).alias("is_jan"),
                    kf.in_month(ts, 2).alias("is_feb"),
                    F.round(kf.money_to_double("total_amount_text"), R).alias("amount"),
                    kf.text_hour("pickup_text").alias("text_hour"))


@register("event_time_flags", sql="""
SELECT event_id,
       CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS peak_time,
       CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS peak_flag_text,
       CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS weekend
FROM events
""")
def event_time_flags(spark, sf):
    """Peak and weekend flags on real times of day; the text variant reads the hour from ISO text."""
    e = load(spark, sf, "events")
    return e.select("event_id", kf.peak_time("ts").alias("peak_time"),
                    kf.peak_flag_text(F.col("ts").cast("string")).alias("peak_flag_text"),
                    kf.is_weekend("ts").alias("weekend"))


@register("quarter_label_counts", sql="""
SELECT strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS quarter_start,
       CAST(count(*) AS BIGINT) AS n_orders
FROM orders GROUP BY 1
""")
def quarter_label_counts(spark, sf):
    """``2000Q1``-style labels parsed back to the first day of the quarter."""
    o = load(spark, sf, "orders")
    label = F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"), F.quarter("o_orderdate").cast("string"))
    q = o.select(kf.quarter_start(label).alias("qs"))
    return q.groupBy("qs").agg(F.count(F.lit(1)).alias("n_orders")) \
            .select(F.date_format("qs", "yyyy-MM-dd").alias("quarter_start"), "n_orders")


@register("month_label_counts", sql="""
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
       CAST(count(*) AS BIGINT) AS n_orders, round(sum(o_totalprice), 4) AS total_price
FROM orders GROUP BY 1
""")
def month_label_counts(spark, sf):
    """``yyyy-MM`` labels parsed to month starts (D6), monthly totals."""
    o = load(spark, sf, "orders")
    m = o.select(kf.parse_month(F.date_format("o_orderdate", "yyyy-MM")).alias("ms"), "o_totalprice")
    return m.groupBy("ms").agg(F.count(F.lit(1)).alias("n_orders"),
                               F.round(F.sum("o_totalprice"), 4).alias("total_price")) \
            .select(F.date_format("ms", "yyyy-MM-dd").alias("month_start"), "n_orders", "total_price")


@register("forecast_quarter_index", sql="""
WITH last AS (SELECT o_orderpriority AS category, max(date_trunc('quarter', o_orderdate))::DATE AS last_q
              FROM orders GROUP BY 1)
SELECT category, strftime(d, '%Y-%m-%d') AS period
FROM last, unnest(generate_series(last_q + INTERVAL 3 MONTH, last_q + INTERVAL 12 MONTH, INTERVAL 3 MONTH)) AS g(d)
""")
def forecast_quarter_index(spark, sf):
    """The next four quarter starts after each category's last observed quarter."""
    o = load(spark, sf, "orders")
    last = o.groupBy(F.col("o_orderpriority").alias("category")) \
            .agg(F.max(F.trunc(F.col("o_orderdate").cast("date"), "quarter")).alias("last_q"))
    return last.select("category", F.explode(kf.future_periods("last_q", 4, 3)).alias("d")) \
               .select("category", F.date_format("d", "yyyy-MM-dd").alias("period"))


@register("pseudo_trip_distance", sql="""
WITH c AS (SELECT vec_id, embedding[1]::DOUBLE * 90.0 AS la1, embedding[2]::DOUBLE * 180.0 AS lo1,
                  embedding[3]::DOUBLE * 90.0 AS la2, embedding[4]::DOUBLE * 180.0 AS lo2 FROM embeddings),
a AS (SELECT vec_id, sin(radians(la2 - la1) / 2) * sin(radians(la2 - la1) / 2)
          + cos(radians(la1)) * cos(radians(la2)) * sin(radians(lo2 - lo1) / 2) * sin(radians(lo2 - lo1) / 2) AS a FROM c)
SELECT vec_id, round(6371.0 * (2.0 * atan2(sqrt(a), sqrt(1.0 - a))), 6) AS distance_km FROM a
""")
def pseudo_trip_distance(spark, sf):
    """Great-circle distance between pseudo coordinates (G1)."""
    c = coordinates_view(load(spark, sf, "embeddings"))
    d = kf.haversine_km("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
    return c.select("vec_id", F.round(d, R).alias("distance_km")).dropna(subset=["distance_km"])


@register("numeric_transforms", sql="""
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN l_extendedprice > 0 THEN ln(l_extendedprice) END, 6) AS ln_price,
       round(exp(l_discount), 6) AS exp_discount,
       round(sqrt(l_quantity), 6) AS sqrt_qty,
       round(l_quantity + 100, 6) AS qty_plus_100,
       CAST(trunc(l_extendedprice / 7) AS BIGINT) AS int_part
FROM lineitem
""")
def numeric_transforms(spark, sf):
    """Elementwise log/exp/sqrt, null-safe constant add, integer part."""
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(kf.safe_ln("l_extendedprice"), R).alias("ln_price"),
                     F.round(F.exp("l_discount"), R).alias("exp_discount"),
                     F.round(F.sqrt("l_quantity"), R).alias("sqrt_qty"),
                     F.round(kf.add_const("l_quantity", 100), R).alias("qty_plus_100"),
                     kf.int_part(F.col("l_extendedprice") / 7).alias("int_part"))


@register("money_text_roundtrip", sql="""
SELECT o_orderkey, round(o_totalprice, 2) AS amount, CAST(length(format('{:,.2f}', o_totalprice)) AS INTEGER) AS text_len,
       upper(o_orderpriority) AS priority_upper, CAST(o_custkey AS VARCHAR) AS cust_text,
       regexp_extract(o_orderpriority, '^(\\d)-', 1) AS priority_digit
FROM orders
""")
def money_text_roundtrip(spark, sf):
    """Money text with thousands separators back to numbers; cast, length, upper, regex group."""
    o = load(spark, sf, "orders")
    text = F.format_number("o_totalprice", 2)
    return o.select("o_orderkey", F.round(kf.money_to_double(text), 2).alias("amount"),
                    kf.text_length(text).alias("text_len"),
                    kf.upper_text("o_orderpriority").alias("priority_upper"),
                    kf.to_text("o_custkey").alias("cust_text"),
                    kf.regex_group("o_orderpriority", r"^(\d)-", 1).alias("priority_digit"))
