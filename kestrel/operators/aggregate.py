"""Profiling aggregates: describe, null counts, correlations, quantiles, modes, box summaries.

Moments, counts and correlations are one aggregation pass (map-side partial
aggregation, one small shuffle), then a reshape of the result row into a long
table.  Quantiles are exact (linear interpolation, equal to pandas / DuckDB
``quantile_cont``) and come from selection by buckets: counts by parts of the value range,
then by leading bits, combined map-side, so no values are sorted and no task holds a column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import stage_table

DESCRIBE_PROBS = (0.25, 0.5, 0.75)
DIGIT_BITS = 16              # key bits that one pass of a quantile tells apart
EVEN_PASSES = 2              # passes by equal parts of the value range before key bits are used
FINITE = 2.0 ** 1022         # the difference of two values up to this is finite


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def ordered_key(value: Column) -> Column:
    """Order-preserving 64-bit integer of a double: equal doubles share a key, smaller ones have smaller keys.

    Sign times exponent and mantissa, taken apart by exact arithmetic (powers of two only);
    both zeros are 0, NaN is above infinity, NULL stays NULL.
    """
    size = F.abs(value)
    guess = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022))
    ratio = size / F.pow(F.lit(2.0), guess)   # the logarithm may be off by one next to a power of two
    step = F.when(ratio >= 2.0, 1).when(ratio < 1.0, -1).otherwise(0)
    mantissa = F.when(ratio >= 2.0, ratio / 2.0).when(ratio < 1.0, ratio * 2.0).otherwise(ratio)
    normal = (guess + step + 1023) * F.lit(1 << 52) + ((mantissa - 1.0) * float(1 << 52)).cast("long")
    key = (F.when(F.isnan(value), F.lit((2047 << 52) + 1)).when(size == float("inf"), F.lit(2047 << 52))
           .when(size < 2.0 ** -1022, (size * 2.0 ** 1022 * float(1 << 52)).cast("long")).otherwise(normal))
    return F.when(value.isNotNull(), F.when(value < 0, -key).otherwise(key))


def _even_bucket(value: Column, lo: Column, hi: Column) -> Column:
    """One of 2 ** ``DIGIT_BITS`` equal parts of the range from ``lo`` to ``hi``; what is not finite lies below or above them."""
    lo, hi, parts = F.greatest(lo, F.lit(-FINITE)), F.least(hi, F.lit(FINITE)), 1 << DIGIT_BITS
    part = F.floor(F.coalesce(F.try_divide(value - lo, hi - lo), F.lit(0.0)) * float(parts - 1))
    return F.when(value < lo, F.lit(-1)).when(value > hi, F.lit(parts)).otherwise(part)


def _hits(counts: DataFrame) -> DataFrame:
    """Wanted ranks with the bucket each falls in: one row per slot, from a node's buckets with ``n, lo, hi``.

    ``slots`` is the node's array of ``(slot, rank)``, a slot being resolved when its bucket's
    smallest or largest value must be it.
    """
    run = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("node").orderBy("bucket")))
    run = run.withColumn("before", F.col("upto") - F.col("n"))
    hit = run.select("root", "node", "bucket", "before", "upto", "lo", "hi", "total", F.explode(F.filter(
        "slots", lambda s: (s["rank"] >= F.col("before")) & (s["rank"] < F.col("upto")))).alias("s"))
    rank = F.col("s.rank") - F.col("before")
    return hit.select("root", "node", "bucket", "lo", "hi", "total", F.col("s.slot").alias("slot"), rank.alias("rank"),
                      F.when((rank == 0) | F.col("lo").eqNullSafe(F.col("hi")), F.col("lo"))
                       .when(F.col("s.rank") == F.col("upto") - 1, F.col("hi")).alias("value"))


def quantiles(df: DataFrame, cols: list[str], probs, by: list[str] | None = None) -> DataFrame:
    """``(by…, column_name, q)``: the exact quantiles of every column per group as an array.

    Selection by buckets, all columns, groups and probabilities at once.  One aggregation gives
    each part's (group's and column's) count and range.  Its values are counted by equal parts
    of the range; only buckets that hold a wanted rank are cut again, until each wanted bucket's
    smallest or largest value is the answer.  What ``EVEN_PASSES`` such passes leave open (values
    of very different magnitude) is told apart by the bits of order-preserving keys, at most
    64 / ``DIGIT_BITS`` passes more.  Counts are combined map-side to about 2 ** DIGIT_BITS rows
    per bucket, values are never sorted or kept.
    NULLs are left out; NaN is the largest value; a column (or group) without values has no row.
    """
    by, probs = by or [], [float(p) for p in probs]
    groups = [f"_{i}" for i in range(len(by))]
    narrow = df.select(*[F.col(k).alias(g) for k, g in zip(by, groups)], *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    stats = []
    for i in range(len(cols)):
        finite = F.when(F.abs(f"x{i}") <= FINITE, F.col(f"x{i}"))
        stats.append(F.struct(F.lit(i).alias("column"), F.count(f"x{i}").alias("total"),
                              F.coalesce(F.min(finite), F.lit(0.0)).alias("lo"), F.coalesce(F.max(finite), F.lit(0.0)).alias("hi")))
    ranges = stage_table(narrow.groupBy(*groups).agg(F.array(*stats).alias("e")).select(*groups, F.inline("e")).filter("total > 0")
                         .withColumn("root", F.monotonically_increasing_id()), "value-ranges")
    entry = F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"x{i}").alias("value")) for i in range(len(cols))])
    long = narrow.select(*groups, F.explode(entry).alias("e")).select(*groups, "e.column", "e.value").filter("value IS NOT NULL")
    part = ranges.select(*[F.col(g).alias(f"_{g}") for g in groups], F.col("column").alias("_column"), F.col("root").alias("node"), "lo", "hi")
    rows = long.join(part, [F.col("column") == F.col("_column"), *[F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups]]).select("node", "value", "lo", "hi")
    last = F.col("total") - 1
    slots = F.array(*[F.struct(F.lit(2 * i + side).alias("slot"), end(F.lit(p) * last).cast("long").alias("rank"))
                      for i, p in enumerate(probs) for side, end in ((0, F.floor), (1, F.ceil))])
    wanted = ranges.select("root", F.col("root").alias("node"), "total", slots.alias("slots"))
    buckets = [_even_bucket(F.col("value"), F.col("lo"), F.col("hi"))] * EVEN_PASSES
    buckets += [F.shiftright(ordered_key(F.col("value")), max(level, 0)) for level in range(64 - DIGIT_BITS, -DIGIT_BITS, -DIGIT_BITS)]
    found = []
    for bucket in buckets:
        tagged = rows.withColumn("bucket", bucket)
        counts = tagged.groupBy("node", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        hits = stage_table(_hits(counts.join(wanted, "node")).withColumn("next", F.monotonically_increasing_id()), "rank-buckets")
        found.append(hits.filter("value IS NOT NULL"))
        open_ = hits.filter("value IS NULL")
        if open_.isEmpty():
            break
        inner = open_.groupBy("node", "bucket").agg(F.min("next").alias("next"), *[F.first(c).alias(c) for c in ("root", "total", "lo", "hi")],
                                                    F.collect_list(F.struct("slot", "rank")).alias("slots"))
        rows = (tagged.select("node", "bucket", "value").join(inner.select("node", "bucket", "next", "lo", "hi"), ["node", "bucket"])
                .select(F.col("next").alias("node"), "value", "lo", "hi"))
        wanted = inner.select("root", F.col("next").alias("node"), "total", "slots")

    stats, out = [], []
    for i, p in enumerate(probs):
        place = F.lit(p) * last
        stats += [*(F.max(F.when(F.col("slot") == 2 * i + side, F.col("value"))).alias(f"{end}{i}") for side, end in enumerate(("lo", "hi"))),
                  F.max(place - F.floor(place)).alias(f"f{i}")]
        out.append(F.col(f"lo{i}") + F.col(f"f{i}") * (F.col(f"hi{i}") - F.col(f"lo{i}")))
    done = reduce(DataFrame.unionByName, found).groupBy("root").agg(*stats).select("root", F.array(*out).alias("q"))
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("column") + 1)
    return done.join(ranges, "root").select(*[F.col(g).alias(k) for k, g in zip(by, groups)], name.alias("column_name"), "q")


def quantile_values(df: DataFrame, cols: list[str], probs) -> dict[str, list[float | None]]:
    """The quantiles of a few columns as numbers (a fitted statistic)."""
    found = {r["column_name"]: r["q"] for r in quantiles(df, cols, probs).collect()}
    return {c: found.get(c) or [None] * len(list(probs)) for c in cols}


def _stack(one_row: DataFrame, cols: list[str], stats: list[str], key: str = "column_name") -> DataFrame:
    """Turn ``<col>__<stat>`` fields of a one-row frame into rows ``(column, stat…)``."""
    parts = [F.struct(F.lit(c).alias(key), *[F.col(f"`{c}__{s}`").alias(s) for s in stats]) for c in cols]
    return one_row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """pandas ``describe().T``: one row per numeric column with count, mean, std (sample),
    min, 25 %, 50 %, 75 %, max."""
    cols = cols or numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    moments = _stack(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    return (moments.join(quantiles(df, cols, DESCRIBE_PROBS), "column_name", "left")
            .select("column_name", "count", "mean", "std", "min",
                    F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max"))


def describe_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``describe(include='all')`` for text columns: count, unique, top, freq.

    All columns are profiled in one shuffle: unpivot to ``(column, value)``,
    count per value with map-side combine, then one aggregate per column.
    Tie on the top value → the smallest value.
    """
    cols = cols or string_columns(df)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                         for c in cols])).alias("r")).select("r.*")
    per_value = long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct((-F.col("n")).alias("negn"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null count per column, largest first (ties by column name); NaN counts as missing."""
    cols = cols or df.columns
    aggs = []
    for f in df.schema.fields:
        if f.name not in cols:
            continue
        miss = F.col(f"`{f.name}`").isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(F.col(f"`{f.name}`"))
        aggs.append(F.sum(miss.cast("bigint")).alias(f"{f.name}__n_null"))
    row = df.agg(*aggs)
    return _stack(row, cols, ["n_null"]).orderBy(F.desc("n_null"), F.asc("column_name"))


def correlation_pairs(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson correlation for every pair i<j (pairwise-complete rows), long ``(a, b, r)``;
    one aggregation pass for the whole matrix."""
    cols = cols or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{k}")
                   for k, (a, b) in enumerate(pairs)])
    parts = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{k}").alias("r"))
             for k, (a, b) in enumerate(pairs)]
    return row.select(F.explode(F.array(*parts)).alias("x")).select("x.*")


def target_correlations(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    """Correlation of every numeric column with ``target`` (``corr()[target]``)."""
    cols = [c for c in (cols or numeric_columns(df)) if c != target]
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"{c}__r") for c in cols])
    return _stack(row, cols, ["r"])


def select_by_correlation(df: DataFrame, target: str, threshold: float = 0.3,
                          cols: list[str] | None = None) -> list[str]:
    """Columns whose |corr| with ``target`` is strictly above ``threshold`` (fitted statistic:
    one row per column comes back to the driver)."""
    rows = target_correlations(df, target, cols).collect()
    return [r["column_name"] for r in rows if r["r"] is not None and abs(r["r"]) > threshold]


def quantile_table(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Long ``(column, p, value)`` table of quantiles."""
    return (quantiles(df, cols, probs).select("column_name", F.posexplode("q").alias("k", "value"))
            .select("column_name", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("k") + 1).alias("p"), "value"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency table, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col))


def mode_value(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Most frequent non-null value (ties → smallest) — distributed: counts per value are
    combined map-side, then the winner per group is picked with ``min_by``."""
    by = by or []
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*by).agg(F.min_by(col, F.struct((-F.col("n")).alias("negn"), F.col(col))).alias("mode"),
                                   F.max("n").alias("freq"))


def boxplot_summary(df: DataFrame, cols: list[str], whisker: float = 1.5) -> DataFrame:
    """Numbers behind a box plot per column: q1, median, q3, whiskers at the most extreme
    points within ``whisker``·IQR of the box, outlier count.  Two passes: quartiles
    (fitted statistic), then one aggregate with the fences as literals."""
    stats = quantile_values(df, cols, [0.25, 0.5, 0.75])
    aggs = []
    for c in cols:
        q1, _, q3 = stats[c]
        x = F.col(c).cast("double")
        if q1 is None:
            lo_f = hi_f = None
        else:
            lo_f, hi_f = q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)
        inside = x.between(F.lit(lo_f), F.lit(hi_f))
        aggs += [F.min(F.when(inside, x)).alias(f"{c}__lower_whisker"),
                 F.max(F.when(inside, x)).alias(f"{c}__upper_whisker"),
                 F.sum((x.isNotNull() & ~inside).cast("bigint")).alias(f"{c}__n_outliers")]
    row = df.agg(*aggs)
    long = _stack(row, cols, ["lower_whisker", "upper_whisker", "n_outliers"])
    spark = df.sparkSession
    qdf = spark.createDataFrame([(c, *stats[c]) for c in cols],
                                "column_name string, q1 double, median double, q3 double")
    return qdf.join(long, "column_name")
