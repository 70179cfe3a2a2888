"""Cleaning, filtering and alignment operators.

Fitted statistics (quantiles, medians, modes) are computed in one aggregation
pass and come back to the driver as a handful of numbers; they are then
applied as literals, so the resulting predicates push down into the scan and
no join is needed to spread a scalar over the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators.aggregate import quantile_values


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric columns, text columns) from the schema — a projection, not a data split."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return num, txt


def quantile_band_filter(df: DataFrame, cols: list[str], lo_p: float = 0.25, hi_p: float = 0.75) -> DataFrame:
    """Closed-interval filter ``Q(lo_p) <= c <= Q(hi_p)`` applied column after column; each
    column's quantiles are computed on the frame already filtered by the previous ones."""
    out = df
    for c in cols:
        q = quantile_values(out, [c], [lo_p, hi_p])[c]
        if q[0] is None:
            out = out.filter(F.lit(False))
            continue
        out = out.filter(F.col(c).between(F.lit(q[0]), F.lit(q[1])))
    return out


def fence_filter(df: DataFrame, col: str, lower: float = 0.0, factor: float = 1.15, p: float = 0.75) -> DataFrame:
    """Open-interval fence ``lower < c < Q(p) * factor``."""
    q = quantile_values(df, [col], [p])[col][0]
    if q is None:
        return df.filter(F.lit(False))
    return df.filter((F.col(col) > F.lit(lower)) & (F.col(col) < F.lit(q * factor)))


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.fillna(values)


def median_values(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact median of each column (all columns in one job)."""
    return {c: q[0] for c, q in quantile_values(df, cols, [0.5]).items()}


def fill_median(df: DataFrame, cols: list[str], medians: dict[str, float] | None = None) -> DataFrame:
    """Replace NULLs by the column median (fitted on ``df`` unless ``medians`` is given,
    e.g. fitted on the training split and applied to the test split)."""
    m = medians if medians is not None else median_values(df, cols)
    # a median of integers can fall between two of them: the filled column is DOUBLE
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m[c]).cast("double")) for c in cols})


def mode_values(df: DataFrame, cols: list[str]) -> dict[str, object]:
    """Most frequent value per column as text (ties → smallest), all columns in one job."""
    entry = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = (df.select(F.explode(entry).alias("e")).select("e.*").filter("value IS NOT NULL")
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    top = counts.groupBy("column_name").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    found = dict(top.collect())
    return {c: found.get(c) for c in cols}


def fill_mode(df: DataFrame, cols: list[str], modes: dict[str, object] | None = None) -> DataFrame:
    """Replace NULLs by the most frequent value of the column."""
    m = modes if modes is not None else mode_values(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m[c]).cast(df.schema[c].dataType)) for c in cols})


def align_columns(left: DataFrame, right: DataFrame, key: str | list[str]) -> DataFrame:
    """Horizontal concat of two column groups of the same rows: full outer equi-join on the key."""
    return left.join(right, on=key, how="full_outer")


def keep_surviving(rows: DataFrame, survivors: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``rows`` whose key survived a filter applied to ``survivors`` (left semi join)."""
    keys = [key] if isinstance(key, str) else key
    return rows.join(survivors.select(*keys), on=keys, how="left_semi")


def lookup(df: DataFrame, table: DataFrame, on: str | list[str], default: dict[str, object] | None = None) -> DataFrame:
    """Left equi-join to a lookup table (vocabulary, lemma, tag table) with defaults for misses.

    No broadcast hint: AQE turns the join into a broadcast join when the measured
    size of the lookup side is under the threshold, and splits skewed keys otherwise.
    """
    out = df.join(table, on=on, how="left")
    if default:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in default.items()})
    return out


def add_aligned(a: DataFrame, b: DataFrame, keys: list[str], value: str = "value",
                fill_value: float = 0.0, out: str = "value") -> DataFrame:
    """Index-aligned addition (``s1.add(s2, fill_value=0)``): full outer join on the keys,
    a label missing on one side counts as ``fill_value``."""
    l = a.select(*keys, F.col(value).alias("__a"))
    r = b.select(*keys, F.col(value).alias("__b"))
    j = l.join(r, on=keys, how="full_outer")
    return j.select(*keys, (F.coalesce("__a", F.lit(fill_value)) + F.coalesce("__b", F.lit(fill_value))).alias(out))


def scale_by_global_max(df: DataFrame, cols: list[str]) -> tuple[DataFrame, float]:
    """Divide every column by the largest value over all of them (one constant for the frame)."""
    row = df.agg(F.greatest(*[F.max(F.col(c).cast("double")) for c in cols]).alias("m")).first()
    m = row["m"]
    return df.withColumns({c: F.col(c) / F.lit(m) for c in cols}), m


def first_rows(df: DataFrame, order_by: list, n: int) -> DataFrame:
    """The first ``n`` rows in an explicit order (``head``/``show`` made deterministic): a
    distributed top-n (per-partition top-n, then a merge), never a full sort."""
    return df.orderBy(*order_by).limit(n)
