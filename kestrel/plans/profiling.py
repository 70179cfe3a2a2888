"""Queries for profiling aggregates and cleaning/alignment operators."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators import aggregate as agg
from kestrel.operators import clean
from kestrel.plans.registry import register
from kestrel.session import checkpoint_dir
from kestrel.sources import files as fs
from kestrel.sources.files import profile_shape
from kestrel.sources.tables import TABLES, lineitem_with_gaps, load

R = 6
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _r(df, cols, d=R):
    return df.withColumns({c: F.round(F.col(c), d) for c in cols})


def _union_sql(template: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


@register("lineitem_describe", sql=_union_sql(
    "SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, "
    "round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, "
    "round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max "
    "FROM lineitem", NUM), headline=True)
def lineitem_describe(spark, sf):
    d = agg.describe_numeric(load(spark, sf, "lineitem"), NUM)
    return _r(d, ["mean", "std", "min", "p25", "p50", "p75", "max"])


CAT = ["p_brand", "p_type", "p_container_size"]


def _part_cat(spark, sf):
    p = load(spark, sf, "part")
    return p.select("p_brand", "p_type", F.col("p_size").cast("string").alias("p_container_size"))


@register("part_describe_categorical", sql="""
WITH long AS (
  SELECT 'p_brand' AS column_name, p_brand AS value FROM part
  UNION ALL SELECT 'p_type', p_type FROM part
  UNION ALL SELECT 'p_container_size', CAST(p_size AS VARCHAR) FROM part),
pv AS (SELECT column_name, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rk FROM pv)
SELECT column_name, CAST(sum(n) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS unique,
       max(CASE WHEN rk = 1 THEN value END) AS top, CAST(max(n) AS BIGINT) AS freq
FROM ranked GROUP BY 1
""")
def part_describe_categorical(spark, sf):
    return agg.describe_categorical(_part_cat(spark, sf), CAT)


GAPS = ["l_orderkey", "l_linenumber", "l_discount", "l_returnflag", "l_quantity"]
LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                    "l_returnflag", "l_linestatus", "l_shipdate"]
_GAPS_SQL = """(SELECT l_orderkey, nullif(l_linenumber, 3) AS l_linenumber,
  CASE WHEN l_orderkey % 7 <> 0 THEN l_discount END AS l_discount,
  CASE WHEN l_orderkey % 5 <> 0 THEN l_returnflag END AS l_returnflag, l_quantity FROM lineitem)"""
_ALL_GAPS_SQL = """(SELECT * REPLACE (nullif(l_linenumber, 3) AS l_linenumber,
  CASE WHEN l_orderkey % 7 <> 0 THEN l_discount END AS l_discount,
  CASE WHEN l_orderkey % 5 <> 0 THEN l_returnflag END AS l_returnflag) FROM lineitem)"""


@register("null_count_profile", sql=f"""
WITH g AS {_ALL_GAPS_SQL}
""" + _union_sql("SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM g", LINEITEM_COLUMNS))
def null_count_profile(spark, sf):
    return agg.null_counts(lineitem_with_gaps(load(spark, sf, "lineitem")))


@register("lineitem_correlations", sql="\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(NUM) for b in NUM[i + 1:]))
def lineitem_correlations(spark, sf):
    return _r(agg.correlation_pairs(load(spark, sf, "lineitem"), NUM), ["r"])


@register("price_correlation_selection", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(corr({c}, l_extendedprice), 6) AS r, "
    f"abs(corr({c}, l_extendedprice)) > 0.3 AS kept FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey"]))
def price_correlation_selection(spark, sf):
    """Target correlations and the |r| > 0.3 column selection (threshold projection)."""
    li = load(spark, sf, "lineitem")
    cols = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey"]
    kept = agg.select_by_correlation(li, "l_extendedprice", 0.3, cols)
    t = agg.target_correlations(li, "l_extendedprice", cols)
    return t.select("column_name", F.round("r", R).alias("r"), F.col("column_name").isin(kept).alias("kept"))


PROBS = [0.1, 0.25, 0.5, 0.75, 1.0]


@register("lineitem_quantiles", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
    for c in NUM for p in PROBS))
def lineitem_quantiles(spark, sf):
    return _r(agg.quantile_table(load(spark, sf, "lineitem"), NUM, PROBS), ["value"])


@register("mean_median_by_status", sql="""
SELECT l_linestatus, round(avg(l_extendedprice), 6) AS mean_price, round(median(l_extendedprice), 6) AS median_price,
       round(avg(l_quantity), 6) AS mean_qty, round(median(l_quantity), 6) AS median_qty
FROM lineitem GROUP BY 1
""")
def mean_median_by_status(spark, sf):
    li = load(spark, sf, "lineitem")
    means = li.groupBy("l_linestatus").agg(F.round(F.avg("l_extendedprice"), R).alias("mean_price"),
                                           F.round(F.avg("l_quantity"), R).alias("mean_qty"))
    q = agg.quantiles(li, ["l_extendedprice", "l_quantity"], [0.5], by=["l_linestatus"])
    medians = q.groupBy("l_linestatus").agg(*[F.round(F.max(F.when(F.col("column_name") == c, F.col("q")[0])), R).alias(n)
                                              for c, n in (("l_extendedprice", "median_price"), ("l_quantity", "median_qty"))])
    return means.join(medians, "l_linestatus").select("l_linestatus", "mean_price", "median_price", "mean_qty", "median_qty")


@register("global_max_scaling", sql="""
WITH m AS (SELECT greatest(max(l_quantity), max(l_discount), max(l_tax)) AS m FROM lineitem)
SELECT l_orderkey, l_linenumber, round(l_quantity / m, 6) AS l_quantity, round(l_discount / m, 6) AS l_discount,
       round(l_tax / m, 6) AS l_tax
FROM lineitem, m
""")
def global_max_scaling(spark, sf):
    """Every column divided by the largest value over all of them (A7 + F6)."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    scaled, _ = clean.scale_by_global_max(li, ["l_quantity", "l_discount", "l_tax"])
    return _r(scaled, ["l_quantity", "l_discount", "l_tax"])


@register("brand_mode_by_size", sql="""
WITH c AS (SELECT p_size, p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY n DESC, p_brand) AS rk FROM c)
SELECT p_size, p_brand AS mode, CAST(n AS BIGINT) AS freq FROM r WHERE rk = 1
""")
def brand_mode_by_size(spark, sf):
    return agg.mode_value(load(spark, sf, "part"), "p_brand", by=["p_size"])


@register("lineitem_value_counts", sql="""
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1
""")
def lineitem_value_counts(spark, sf):
    return agg.value_counts(load(spark, sf, "lineitem"), "l_returnflag")


@register("lineitem_boxplot", sql="\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round((SELECT min({c}) FROM lineitem WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS lower_whisker,
  round((SELECT max({c}) FROM lineitem WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS upper_whisker,
  (SELECT CAST(count(*) AS BIGINT) FROM lineitem WHERE NOT ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 FROM lineitem)"""
    for c in ["l_extendedprice", "l_quantity"]))
def lineitem_boxplot(spark, sf):
    b = agg.boxplot_summary(load(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])
    return _r(b, ["q1", "median", "q3", "lower_whisker", "upper_whisker"])


@register("quartile_band_filter", sql="""
WITH q1 AS (SELECT quantile_cont(l_quantity, 0.25) AS lo, quantile_cont(l_quantity, 0.75) AS hi FROM lineitem),
f1 AS (SELECT l.* FROM lineitem l, q1 WHERE l_quantity BETWEEN lo AND hi),
q2 AS (SELECT quantile_cont(l_extendedprice, 0.25) AS lo, quantile_cont(l_extendedprice, 0.75) AS hi FROM f1),
f2 AS (SELECT f1.* FROM f1, q2 WHERE l_extendedprice BETWEEN lo AND hi),
q3 AS (SELECT quantile_cont(l_discount, 0.25) AS lo, quantile_cont(l_discount, 0.75) AS hi FROM f2),
f3 AS (SELECT f2.* FROM f2, q3 WHERE l_discount BETWEEN lo AND hi)
SELECT l_orderkey, l_linenumber, l_quantity, round(l_extendedprice, 6) AS l_extendedprice, l_discount FROM f3
""")
def quartile_band_filter(spark, sf):
    """Sequential interquartile band filter over three columns (P10)."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    out = clean.quantile_band_filter(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return _r(out, ["l_extendedprice"])


@register("upper_fence_filter", sql="""
WITH q AS (SELECT quantile_cont(c_acctbal, 0.75) AS q3 FROM customer)
SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal FROM customer, q WHERE c_acctbal > 0 AND c_acctbal < q3 * 1.15
""")
def upper_fence_filter(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return _r(clean.fence_filter(c, "c_acctbal", 0.0, 1.15, 0.75), ["c_acctbal"])


@register("gap_imputation", sql=f"""
WITH g AS {_GAPS_SQL},
s AS (SELECT median(l_linenumber) AS m_line, median(l_discount) AS m_disc FROM g),
m AS (SELECT l_returnflag AS mode FROM g WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT l_orderkey, l_quantity, round(coalesce(CAST(l_linenumber AS DOUBLE), m_line), 6) AS l_linenumber,
       round(coalesce(l_discount, m_disc), 6) AS l_discount,
       coalesce(l_returnflag, m.mode) AS l_returnflag,
       coalesce(CASE WHEN l_quantity > 45 THEN NULL ELSE 'small' END, 'No Value') AS size_class
FROM g, s, m
""")
def gap_imputation(spark, sf):
    """Median fill for numbers, most-frequent fill for text, constant fill for absent-means-none."""
    g = lineitem_with_gaps(load(spark, sf, "lineitem")).select(*GAPS)
    g = g.withColumn("size_class", F.when(F.col("l_quantity") <= 45, F.lit("small")))
    g = clean.fill_median(g, ["l_linenumber", "l_discount"])
    g = clean.fill_mode(g, ["l_returnflag"])
    g = clean.fill_constant(g, {"size_class": "No Value"})
    return _r(g, ["l_linenumber", "l_discount"]).select("l_orderkey", "l_quantity", "l_linenumber", "l_discount",
                                                          "l_returnflag", "size_class")


@register("split_filter_align", sql="""
SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS acctbal, c_name AS name, c_mktsegment AS segment
FROM customer WHERE c_acctbal > 0
""")
def split_filter_align(spark, sf):
    """Type split → filter numeric part → keep surviving text rows (semi join) → align on key
    (P4–P7, J1, J2), then rename."""
    c = load(spark, sf, "customer")
    num, txt = clean.split_by_type(c)
    num_part = c.select(*num).filter(F.col("c_acctbal") > 0)
    txt_part = clean.keep_surviving(c.select("c_custkey", *txt), num_part, "c_custkey")
    out = clean.align_columns(num_part, txt_part, "c_custkey")
    out = out.withColumnsRenamed({"c_name": "name", "c_mktsegment": "segment", "c_acctbal": "acctbal"})
    return _r(out, ["acctbal"])


@register("table_shapes", sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, (SELECT CAST(count(*) AS BIGINT) FROM {t}) AS n_rows, "
    f"(SELECT CAST(count(*) AS BIGINT) FROM information_schema.columns WHERE table_name = '{t}') AS n_cols" for t in TABLES))
def table_shapes(spark, sf):
    """Shape of every given table (row count from a scan, column count from the schema)."""
    parts = [profile_shape(load(spark, sf, t)).select(F.lit(t).alias("table_name"), "n_rows", "n_cols") for t in TABLES]
    return reduce(DataFrame.unionByName, parts)


@register("aligned_daily_sum", sql="""
WITH a AS (SELECT CAST(ts AS DATE) AS day, sum(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1),
b AS (SELECT CAST(ts AS DATE) AS day, sum(value) AS v FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT strftime(coalesce(a.day, b.day), '%Y-%m-%d') AS day, round(coalesce(a.v, 0) + coalesce(b.v, 0), 6) AS value
FROM a FULL OUTER JOIN b ON a.day = b.day
""")
def aligned_daily_sum(spark, sf):
    """Index-aligned addition of two daily series, missing labels count as 0."""
    e = load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    a = e.filter(F.col("event_type") == "purchase").groupBy("day").agg(F.sum("value").alias("value"))
    b = e.filter(F.col("event_type") == "error").groupBy("day").agg(F.sum("value").alias("value"))
    s = clean.add_aligned(a, b, ["day"])
    return s.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("value", R).alias("value"))


# ---------------------------------------------------------------- files written and read back
def _folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/files-{name}-{uuid.uuid4().hex}"


@register("orders_csv_round_trip", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders
""")
def orders_csv_round_trip(spark, sf):
    """Orders written as CSV with a header by all tasks and read back with a declared schema."""
    o = load(spark, sf, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    path = _folder(spark, "orders")
    fs.write_table(o, path, "csv")
    return fs.read_delimited(spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string")


@register("monthly_csv_series", sql="""
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ts, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY 1
""")
def monthly_csv_series(spark, sf):
    """Monthly totals written as CSV with ISO dates and read back as a dated series."""
    m = load(spark, sf, "orders").groupBy(F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("day")).agg(F.sum("o_totalprice").alias("total"))
    path = _folder(spark, "monthly")
    fs.write_table(m, path, "csv")
    return fs.read_dated_series(spark, path, "day", "total").select(F.date_format("ts", "yyyy-MM-dd").alias("ts"), F.round("value", 2).alias("value"))


@register("supplier_tsv_pairs", sql="""
SELECT s_name AS input, CAST(round(s_acctbal, 2) AS VARCHAR) AS output FROM supplier
""")
def supplier_tsv_pairs(spark, sf):
    """Supplier names and balances written as a tab-separated pair file and read back."""
    s = load(spark, sf, "supplier").select(F.col("s_name").alias("input"), F.round("s_acctbal", 2).cast("string").alias("output"))
    path = _folder(spark, "pairs")
    s.write.option("sep", "\t").option("header", True).csv(path)
    return fs.read_pairs(spark, path)


@register("part_tagged_corpus", sql="""
WITH t AS (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS word, lower(p_brand) AS tag FROM part)
SELECT word, tag, count(*) AS n FROM t WHERE word <> '' GROUP BY 1, 2
""")
def part_tagged_corpus(spark, sf):
    """Part types written as lines of ``word/tag`` tokens, read back as a tagged corpus and counted."""
    lines = load(spark, sf, "part").select(F.array_join(F.transform(F.split("p_type", " "), lambda w: F.concat(w, F.lit("/"), F.col("p_brand"))), " ").alias("value"))
    path = _folder(spark, "tagged")
    lines.write.text(path)
    return fs.read_tagged(spark, path).groupBy("word", "tag").agg(F.count(F.lit(1)).alias("n"))


@register("region_whole_texts", sql="""
SELECT CAST(r_regionkey AS VARCHAR) AS folder, string_agg(n_name, ' ' ORDER BY n_name) AS "text" FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1
""")
def region_whole_texts(spark, sf):
    """The nations of each region written as the lines of one text file and read back as one text a file."""
    n = load(spark, sf, "nation").join(load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    path = _folder(spark, "texts")
    lines = n.select("n_regionkey", F.col("n_name").alias("value"), F.col("r_regionkey").cast("string").alias("folder"))
    lines.repartition("folder").sortWithinPartitions("folder", "value").select("value", "folder").write.partitionBy("folder").text(path)
    texts = fs.read_whole_texts(spark, path)
    return texts.select(F.regexp_extract("path", "folder=([^/]+)/", 1).alias("folder"), "text")
