import math

import pandas as pd
from pyspark.sql import functions as F

from kestrel.operators import aggregate as agg
from kestrel.operators import clean


def _frame(spark):
    pdf = pd.DataFrame({"id": range(10), "x": [1.0, 2, 3, 4, 5, 6, 7, 8, 9, 100],
                        "y": [None, 1.0, 1, 2, 2, 2, 3, None, 4, 5], "s": ["a", "b", "b", None, "c", "c", "a", "a", "b", "c"]})
    return pdf, spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id long, x double, y double, s string")


def test_describe_matches_pandas(spark):
    pdf, df = _frame(spark)
    d = {r["column_name"]: r for r in agg.describe_numeric(df, ["x", "y"]).collect()}
    ref = pdf[["x", "y"]].describe()
    for c in ["x", "y"]:
        assert d[c]["count"] == ref[c]["count"]
        for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                             ("p75", "75%"), ("max", "max")):
            assert math.isclose(d[c][ours], ref[c][theirs], rel_tol=1e-12)


def test_null_counts_and_mode_ties(spark):
    _, df = _frame(spark)
    n = agg.null_counts(df).collect()
    assert [(r["column_name"], r["n_null"]) for r in n] == [("y", 2), ("s", 1), ("id", 0), ("x", 0)]
    m = agg.mode_value(df, "s").first()
    assert (m["mode"], m["freq"]) == ("a", 3)        # a, b, c tie at 3 → smallest


def test_categorical_describe(spark):
    _, df = _frame(spark)
    r = agg.describe_categorical(df, ["s"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (9, 3, "a", 3)


def test_band_and_fence_filters(spark):
    _, df = _frame(spark)
    kept = sorted(r["id"] for r in clean.quantile_band_filter(df, ["x"]).collect())
    # quartiles of x: 3.25 and 7.75 → 4..7
    assert kept == [3, 4, 5, 6]
    f = clean.fence_filter(df, "x", 0.0, 1.15, 0.75)
    assert all(0 < r["x"] < 7.75 * 1.15 for r in f.collect())


def test_imputation(spark):
    _, df = _frame(spark)
    out = clean.fill_mode(clean.fill_median(df, ["y"]), ["s"]).orderBy("id").collect()
    assert out[0]["y"] == 2.0 and out[7]["y"] == 2.0
    assert out[3]["s"] == "a"


def test_boxplot_summary(spark):
    _, df = _frame(spark)
    b = agg.boxplot_summary(df, ["x"]).first()
    assert b["n_outliers"] == 1 and b["upper_whisker"] == 9.0 and b["lower_whisker"] == 1.0


def test_semi_join_and_alignment(spark):
    _, df = _frame(spark)
    num = df.select("id", "x").filter(F.col("x") < 5)
    txt = clean.keep_surviving(df.select("id", "s"), num, "id")
    assert txt.count() == 4
    assert clean.align_columns(num, txt, "id").count() == 4


def test_correlation_pairwise_complete(spark):
    pdf, df = _frame(spark)
    r = agg.correlation_pairs(df, ["x", "y"]).first()["r"]
    assert math.isclose(r, pdf["x"].corr(pdf["y"]), rel_tol=1e-12)


def test_first_rows_ordered(spark):
    _, df = _frame(spark)
    assert [r["id"] for r in clean.first_rows(df, [F.desc("x")], 2).collect()] == [9, 8]
