"""Feature engineering with fit/transform semantics.

Fitted state is either a handful of numbers (min/max, medians) kept on the
driver, or a distributed dictionary DataFrame (label ids).  Dictionaries are
built without collecting values: distinct values are numbered with
:func:`kestrel.operators.ordering.global_index` and joined back (AQE broadcasts
the dictionary when its measured size is small, and shuffles otherwise).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.ordering import global_index
from kestrel.session import stage_table

HASH_BUCKETS = 10000
BROADCAST_LABELS = 10000      # one-row-per-label tables up to this size are broadcast


# ---------------------------------------------------------------- label encoding
@dataclass
class LabelDictionary:
    """Fitted label encoder: ``(column_name, value, id)`` with ids 0..k−1 in sorted value order."""
    table: DataFrame
    columns: list[str]

    def transform(self, df: DataFrame, suffix: str = "_id", unseen: int | None = None) -> DataFrame:
        """Add ``<col><suffix>`` for each fitted column; values not seen in fit get ``unseen``
        (default: the next id k, as ``handleInvalid='keep'``)."""
        out = df
        sizes = {} if unseen is not None else dict(
            self.table.groupBy("column_name").agg(F.count(F.lit(1)).alias("k")).collect())
        for c in self.columns:
            d = self.table.filter(F.col("column_name") == c).select(F.col("value").alias(f"__v_{c}"),
                                                                    F.col("id").alias(f"{c}{suffix}"))
            out = out.join(d, out[c].cast("string").eqNullSafe(d[f"__v_{c}"]), "left").drop(f"__v_{c}")
            fill = unseen if unseen is not None else sizes.get(c, 0)
            out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(fill).cast("bigint")))
        return out


def fit_label_dictionary(df: DataFrame, cols: list[str]) -> LabelDictionary:
    """Fit ids for all ``cols`` at once: unpivot, distinct, one global numbering ordered by
    (column, value), then rebase per column (NULL is a category, sorted first)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                         for c in cols])).alias("r")).select("r.*").distinct()
    idx = global_index(long, [F.col("column_name").asc(), F.col("value").asc_nulls_first()], "gi")
    base = idx.groupBy("column_name").agg(F.min("gi").alias("g0"))
    table = idx.join(F.broadcast(base), "column_name") \
               .select("column_name", "value", (F.col("gi") - F.col("g0")).alias("id"))
    return LabelDictionary(table, list(cols))


def frequency_indexer(cols: list[str], order: str = "frequencyDesc", keep_unseen: bool = True) -> StringIndexer:
    """MLlib label indexer: most frequent label → 0 (ties alphabetical), or ``alphabetAsc``."""
    return StringIndexer(inputCols=cols, outputCols=[f"{c}_idx" for c in cols], stringOrderType=order,
                         handleInvalid="keep" if keep_unseen else "error")


def one_hot(cols: list[str], drop_last: bool = True) -> OneHotEncoder:
    return OneHotEncoder(inputCols=cols, outputCols=[f"{c}_vec" for c in cols], dropLast=drop_last)


def assemble(cols: list[str], out: str = "features", skip_invalid: bool = True) -> VectorAssembler:
    """Numeric columns → one vector; rows with a NULL input are skipped (replaces a null guard)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="skip" if skip_invalid else "error")


# ---------------------------------------------------------------- min-max scaling
@dataclass
class MinMaxFit:
    """Fitted min/max per column; transform to [0, 1] and back to units."""
    stats: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        exprs = {}
        for c, (lo, hi) in self.stats.items():
            span = (hi - lo) if (hi is not None and lo is not None) else None
            x = F.col(c).cast("double")
            exprs[c + suffix] = F.lit(0.0) * x if not span else (x - F.lit(lo)) / F.lit(span)
        return df.withColumns(exprs)

    def inverse(self, df: DataFrame, cols: dict[str, str] | None = None) -> DataFrame:
        """Back to original units; ``cols`` maps a scaled column to the fitted column whose
        statistics apply (e.g. a prediction column → the label column)."""
        cols = cols or {c: c for c in self.stats}
        exprs = {}
        for out_c, fit_c in cols.items():
            lo, hi = self.stats[fit_c]
            exprs[out_c] = F.col(out_c) * F.lit((hi - lo) if hi is not None else None) + F.lit(lo)
        return df.withColumns(exprs)


def fit_min_max(df: DataFrame, cols: list[str]) -> MinMaxFit:
    """One aggregation pass; a constant column scales to 0 (not 0.5)."""
    row = df.agg(*[x for c in cols for x in (F.min(F.col(c).cast("double")).alias(f"{c}__lo"),
                                             F.max(F.col(c).cast("double")).alias(f"{c}__hi"))]).first()
    return MinMaxFit({c: (row[f"{c}__lo"], row[f"{c}__hi"]) for c in cols})


# ---------------------------------------------------------------- splits and folds
def hash_bucket(key, seed: int = 42):
    """Bucket 0..9999 from the md5 of ``seed:key`` — independent of partitioning and row order."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string") if isinstance(key, str) else key.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % HASH_BUCKETS


def split_by_hash(df: DataFrame, key: str, test_fraction: float, seed: int = 42,
                  flag: str = "is_test") -> DataFrame:
    """Repeatable train/test flag: a row is test when its hash bucket < fraction · 10000."""
    return df.withColumn(flag, hash_bucket(key, seed) < F.lit(int(round(test_fraction * HASH_BUCKETS))))


def split_stratified(df: DataFrame, key: str, label: str, test_fraction: float, seed: int = 42,
                     flag: str = "is_test") -> DataFrame:
    """Stratified repeatable split: per label, the smallest buckets holding at least the
    fraction of that label's rows go to test.  The cut is found on per-(label, bucket)
    counts — at most 10000 rows per label, whatever the data size."""
    b = df.withColumn("__b", hash_bucket(key, seed))
    counts = b.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(label).orderBy("__b")
    cum = counts.select(label, "__b", F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("__cum"),
                        F.sum("__n").over(Window.partitionBy(label)).alias("__tot"))
    cut = cum.filter(F.col("__cum") >= F.lit(test_fraction) * F.col("__tot")) \
             .groupBy(label).agg(F.min("__b").alias("__cut"))
    # one row per label value: broadcast while that is few, else joined by label
    cut = stage_table(cut, "split-cuts")
    if cut.count() <= BROADCAST_LABELS:
        cut = F.broadcast(cut)
    out = b.join(cut, on=label, how="left")
    return out.withColumn(flag, F.coalesce(F.col("__b") <= F.col("__cut"), F.lit(False))).drop("__b", "__cut")


def assign_folds(df: DataFrame, key: str | list[str], k: int, fold_col: str = "fold") -> DataFrame:
    """Contiguous k folds in key order (k-fold without shuffling): fold sizes equal
    ``ntile(k)`` for unique keys — the first ``n mod k`` folds hold one row more.  Only the
    keys are sorted; the k − 1 keys that start a fold are then applied as literals (rows of
    equal key share a fold)."""
    return assign_folds_for(df, key, {fold_col: k})


def assign_folds_for(df: DataFrame, key: str | list[str], sizes: dict[str, int]) -> DataFrame:
    """``assign_folds`` for several numbers of folds (fold column to number): the keys are sorted once."""
    keys = [key] if isinstance(key, str) else list(key)
    idx = global_index(df.select(*keys), [F.col(c).asc() for c in keys], "__pos")
    n = idx.count()

    def starts(k: int) -> list[int]:
        q, r = divmod(n, k)
        return [s for s in (min(f, r) * (q + 1) + max(f - r, 0) * q for f in range(1, k)) if s < n]

    wanted = sorted({s for k in sizes.values() for s in starts(k)})
    first = {x["__pos"]: x for x in idx.filter(F.col("__pos").isin(wanted)).collect()}
    row, folds = F.struct(*[F.col(c) for c in keys]), {}
    for column, k in sizes.items():
        fold = F.lit(0)
        for s in starts(k):
            bound = F.struct(*[F.lit(first[s][c]).cast(df.schema[c].dataType).alias(c) for c in keys])
            fold = fold + (row >= bound).cast("int")
        folds[column] = fold.cast("int")
    return df.withColumns(folds)
