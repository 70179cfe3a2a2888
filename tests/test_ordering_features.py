import numpy as np
from pyspark.sql import functions as F

from kestrel.operators import features as fe
from kestrel.operators.ordering import global_index
from kestrel.operators.aggregate import quantile_values, quantiles


def test_global_index_is_a_permutation_in_order(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    idx = global_index(df.repartition(5), [F.col("k")], "i").collect()
    assert sorted(r["i"] for r in idx) == list(range(5000))
    assert all(r["i"] == r["k"] for r in idx)


def test_quantiles_equal_numpy(spark):
    df = spark.range(0, 1001).selectExpr("(id * 37 % 1001) / 3.0 AS v", "CASE WHEN id % 5 <> 0 THEN id % 13 END AS w", "id % 3 AS g", "CAST(NULL AS DOUBLE) AS none")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    pdf = df.toPandas()
    for by in ([], ["g"]):
        got = {tuple(r[k] for k in [*by, "column_name"]): r["q"] for r in quantiles(df, ["v", "w", "none"], probs, by).collect()}
        for g, part in ([((), pdf)] if not by else [((k,), p) for k, p in pdf.groupby("g")]):
            for c in ("v", "w"):
                assert np.allclose(got[(*g, c)], np.quantile(part[c].dropna().astype(float), probs))
        assert not any(k[-1] == "none" for k in got)
    assert quantile_values(df, ["none"], [0.5]) == {"none": [None]}


def test_fold_sizes_like_ntile(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    f = fe.assign_folds(df, "k", 3).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in f] == [4, 3, 3]
    rows = fe.assign_folds(spark.range(100).withColumnRenamed("id", "k"), "k", 7).orderBy("k").collect()
    folds = [r["fold"] for r in rows]
    assert folds == sorted(folds)            # contiguous blocks
    sizes = [folds.count(i) for i in range(7)]
    assert max(sizes) - min(sizes) <= 1


def test_hash_split_repeatable_under_repartition(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = {r["k"] for r in fe.split_by_hash(df, "k", 0.3).filter("is_test").collect()}
    b = {r["k"] for r in fe.split_by_hash(df.repartition(13), "k", 0.3).filter("is_test").collect()}
    assert a == b and 450 < len(a) < 750


def test_stratified_split_keeps_shares(spark):
    df = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    s = fe.split_stratified(df, "k", "y", 0.25).groupBy("y").agg(F.avg(F.col("is_test").cast("double")).alias("r"))
    for r in s.collect():
        assert abs(r["r"] - 0.25) < 0.03


def test_minmax_inverse_and_constant(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 5.0), (3, 10.0, 5.0)], "id int, x double, c double")
    fit = fe.fit_min_max(df, ["x", "c"])
    s = fit.transform(df)
    got = {r["id"]: (r["x"], r["c"]) for r in s.collect()}
    assert got[1] == (0.0, 0.0) and got[3] == (1.0, 0.0)
    back = fit.inverse(s.select("id", "x"), {"x": "x"}).orderBy("id").collect()
    assert [r["x"] for r in back] == [2.0, 4.0, 10.0]


def test_label_dictionary_sorted_ids_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "v string")
    d = fe.fit_label_dictionary(train, ["v"])
    test = spark.createDataFrame([("a",), ("c",), ("z",)], "v string")
    got = {r["v"]: r["v_id"] for r in d.transform(test).collect()}
    assert got == {"a": 0, "c": 2, "z": 3}
