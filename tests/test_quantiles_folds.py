import math
import random
import struct

import numpy as np
import pytest
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from kestrel.operators import aggregate as ag
from kestrel.operators import features as fe
from kestrel.operators import folds as fo
from kestrel.operators import models as md

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def bits(x):
    n = struct.unpack("<q", struct.pack("<d", x))[0]
    return n if n >= 0 else -(n & (2 ** 63 - 1))


def test_keys_are_the_ordered_bits_of_doubles(spark):
    r = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308,
              math.inf, -math.inf, 0.1, 2.0 ** 52, 2.0 ** 53 - 1, 8.0, 7.999999999999999]
    values += [struct.unpack("<d", struct.pack("<Q", r.getrandbits(64)))[0] for _ in range(3000)]
    values += [math.nextafter(2.0 ** e, d) for e in range(-1030, 1024, 7) for d in (0, math.inf)]
    values = [v for v in values if v == v]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ag.ordered_key(F.col("v")).alias("k")).collect()
    assert all(x["k"] == bits(x["v"]) for x in rows)


@pytest.mark.parametrize("digit", [16, 5])
def test_quantiles_equal_numpy(spark, monkeypatch, digit):
    monkeypatch.setattr(ag, "DIGIT_BITS", digit)
    r = random.Random(digit)
    rows = []
    for i in range(3000):
        rows.append((r.choice(["a", "b", None]), r.gauss(0, 1e6), float(r.randint(-3, 3)), r.choice([None, 1e-300, -1e300, 0.1 + r.random() * 1e-12]), None))
    rows += [("one", 5.5, -0.0, None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double, w double")
    got = {(q["g"], q["column_name"]): q["q"] for q in ag.quantiles(df, ["x", "y", "z", "w"], PROBS, by=["g"]).collect()}
    for g in ("a", "b", None, "one"):
        for k, c in enumerate(["x", "y", "z", "w"], 1):
            have = [x[k] for x in rows if x[0] == g and x[k] is not None]
            if not have:
                assert (g, c) not in got
            else:
                assert np.allclose(got[g, c], np.quantile(have, PROBS), rtol=1e-12, atol=0), (g, c)
    whole = ag.quantile_values(df, ["x", "w"], [0.5])
    assert whole == {"x": [float(np.quantile([x[1] for x in rows], 0.5))], "w": [None]}
    assert ag.quantiles(df.limit(0), ["x"], [0.5]).count() == 0


def test_quantiles_with_infinities_and_nan(spark):
    df = spark.createDataFrame([(math.inf,), (1.0,), (-math.inf,), (math.nan,), (2.0,)], "x double")
    assert ag.quantile_values(df, ["x"], [0.25, 0.5])["x"] == [1.0, 2.0]
    assert math.isnan(ag.quantile_values(df, ["x"], [1.0])["x"][0])


def test_quantiles_of_ordinary_values_need_no_key_bits(spark, monkeypatch):
    """Values spread over a range are told apart by equal parts of it, in two cheap passes; only mixed magnitudes need the key's logarithms."""
    plans, stage = [], ag.stage_table

    def seen(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(ag, "stage_table", seen)
    df = spark.range(0, 200_000, 1, 4).select((F.col("id") * 7919 % 200_003 / 100 + 900).alias("x"), (F.col("id") % 50).alias("y"))
    got = ag.quantile_values(df, ["x", "y"], PROBS)
    assert np.allclose(got["x"], np.quantile([i * 7919 % 200_003 / 100 + 900 for i in range(200_000)], PROBS), rtol=1e-12, atol=0)
    assert np.allclose(got["y"], np.quantile([i % 50 for i in range(200_000)], PROBS), rtol=1e-12, atol=0)
    assert len(plans) <= 3 and not any("LOG2" in p.upper() for p in plans)
    wide = spark.createDataFrame([(s * 10.0 ** e * m,) for e in range(-300, 300, 7) for m in (1, 2, 3) for s in (-1, 1)], "x double")
    assert np.allclose(ag.quantile_values(wide, ["x"], PROBS)["x"],
                       np.quantile([s * 10.0 ** e * m for e in range(-300, 300, 7) for m in (1, 2, 3) for s in (-1, 1)], PROBS), rtol=1e-12, atol=0)
    assert any("LOG2" in p.upper() for p in plans)


def test_values_are_neither_sorted_nor_staged(spark, monkeypatch):
    """What a pass stages are buckets of wanted ranks; windows sort bucket rows, and nothing is range-partitioned."""
    staged, stage = [], ag.stage_table

    def seen(df, name):
        table = stage(df, name)
        staged.append((df._jdf.queryExecution().executedPlan().toString(), table.count()))
        return table

    monkeypatch.setattr(ag, "stage_table", seen)
    df = spark.range(0, 20_000, 1, 4).select((F.col("id") * 0.37).alias("x"), F.sqrt("id").alias("y"))
    ag.quantiles(df, ["x", "y"], PROBS).collect()
    assert 1 <= len(staged) <= 4
    assert all("rangepartitioning" not in plan and "Sort [value" not in plan and n <= 2 * 2 * len(PROBS) for plan, n in staged)


def linear(spark, n=600, seed=3):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 3)) @ np.array([[2, 1, 0], [0, 1, 0.3], [0, 0, 0.5]]) + [100, -3, 40]
    y = x @ [2, -1, 0.5] + r.normal(size=n)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(n)] + [(n, None, 1.0, 1.0, 1.0)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(5)


def test_fold_lines_and_components_equal_per_fold_fits(spark):
    df, cols = linear(spark), ["a", "b", "c"]
    folded = fe.assign_folds_for(df.dropna(), "id", {"f2": 2, "f5": 5})
    stats = fo.fold_statistics(folded, cols, "y", ["f2", "f5"])
    assert sorted(stats.grams["f2"]) == [0, 1] and sorted(stats.grams["f5"]) == list(range(5))
    for column, fold in (("f2", 1), ("f5", 3)):
        learn, test = folded.filter(F.col(column) != fold), folded.filter(F.col(column) == fold)
        line = stats.line(stats.train(column, fold))
        fit = md.feature_pipeline(cols, md.regressor("ols", label="y")).fit(learn)
        assert np.allclose(line.slope, fit.stages[-1].coefficients.toArray(), atol=1e-6)
        for d, gram in ((learn, stats.train(column, fold)), (test, stats.test(column, fold))):
            assert abs(stats.r2(gram, line) - md.regression_metrics(fit.transform(d), "y").first()["r2"]) < 1e-8
        own = stats.components(stats.train(column, fold))
        raw = VectorAssembler(inputCols=cols, outputCol="raw").transform(learn)
        centred = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=False).fit(raw).transform(raw)
        pca = PCA(k=3, inputCol="z", outputCol="pc").fit(centred)
        assert np.allclose(np.abs(own.vectors), np.abs(pca.pc.toArray()), atol=1e-6)
        assert np.allclose(own.variance / own.variance.sum(), pca.explainedVariance.toArray(), atol=1e-9)
        for size in (1, 2, 3):
            scored = fo.project(folded, cols, own, size)
            pipe = md.feature_pipeline([f"pc{j}" for j in range(size)], md.regressor("ols", label="y")).fit(scored.filter(F.col(column) != fold))
            want = md.regression_metrics(pipe.transform(scored.filter(F.col(column) == fold)), "y").first()["r2"]
            assert abs(stats.r2(stats.test(column, fold), stats.line(stats.train(column, fold), size)) - want) < 1e-7


def test_kfold_table_of_fitted_and_closed_form_algorithms(spark):
    df, cols = linear(spark, 200), ["a", "b", "c"]
    algos = {"line": None, "ols": md.regressor("ols", label="y"), "tree": md.regressor("tree", label="y", maxDepth=3)}
    rows = md.kfold_scores(df, "id", [2, 3], cols, "y", algos, sizes=[None, 1, 3]).collect()
    assert len(rows) == 3 * 5 * 3
    by = {(r["algo"], r["k"], r["size"], r["fold"]): (r["train_r2"], r["test_r2"]) for r in rows}
    for (algo, *at), scores in by.items():
        if algo == "ols":
            assert np.allclose(scores, by[("line", *at)], atol=1e-6)
    assert all(np.allclose(by["line", k, None, f], by["line", k, 3, f], atol=1e-9) for k in (2, 3) for f in range(k))


def test_staged_grid_equals_fitting_every_point(spark):
    df = linear(spark, 240).dropna()
    grid = dict(maxDepth=[1, 3], maxIter=[2, 5])
    model, table = md.grid_search(df, ["a", "b", "c"], "y", "id", folds=2, grid=grid, seed=7)
    got = {(r["maxDepth"], r["maxIter"]): r["rmse"] for r in table.collect()}
    folded = df.withColumn("fold", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(2)).cast("int"))
    gbt = GBTRegressor(featuresCol="features", labelCol="y", seed=7)
    maps = ParamGridBuilder().addGrid(gbt.maxDepth, grid["maxDepth"]).addGrid(gbt.maxIter, grid["maxIter"]).build()
    cv = CrossValidator(estimator=md.feature_pipeline(["a", "b", "c"], gbt), estimatorParamMaps=maps, evaluator=RegressionEvaluator(labelCol="y", metricName="rmse"),
                        numFolds=2, foldCol="fold").fit(folded)
    for m, want in zip(maps, cv.avgMetrics):
        assert abs(got[m[gbt.maxDepth], m[gbt.maxIter]] - want) < 1e-9
    assert model.stages[-1].getNumTrees == min(got, key=lambda p: (got[p], p[1], p[0]))[1]


def test_ablation_reports_every_round(spark):
    df = linear(spark, 200).dropna()
    train, test = df.filter("id < 150"), df.filter("id >= 150")
    est = md.regressor("gbt", label="y", maxIter=4, maxDepth=2)
    rows = md.feature_set_ablation(train, test, {"all": ["a", "b", "c"], "one": ["c"]}, "y", est).collect()
    assert len(rows) == 2 * 2 * 4
    short = md.feature_pipeline(["a", "b", "c"], md.regressor("gbt", label="y", maxIter=2, maxDepth=2)).fit(train)
    want = md.regression_metrics(short.transform(test), "y").first()["rmse"]
    assert [abs(r["rmse"] - want) < 1e-9 for r in rows if (r["feature_set"], r["split"], r["round"]) == ("all", "evaluate", 2)] == [True]


def repeated(spark, n=3000):
    """Rows of few distinct vectors (60) and labels that differ within them."""
    r = random.Random(4)
    rows = [(i, float(r.randint(0, 4)), float(r.randint(0, 3)), float(r.randint(0, 2)), r.gauss(0, 1)) for i in range(n)]
    return spark.createDataFrame([(i, a, b, c, 3 * a - b * c + e) for i, a, b, c, e in rows], "id long, a double, b double, c double, y double")


def test_distinct_vectors_stand_for_their_rows(spark, monkeypatch):
    df, cols, sizes, stage = repeated(spark), ["a", "b", "c"], {}, md.stage_table

    def seen(frame, name):
        table = stage(frame, name)
        sizes[name] = max(sizes.get(name, 0), table.count())
        return table

    monkeypatch.setattr(md, "stage_table", seen)
    est = md.regressor("gbt", label="y", maxIter=3, maxDepth=3)
    train, test = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    rows = md.feature_set_ablation(train, test, {"all": cols}, "y", est).collect()
    model = md.feature_pipeline(cols, est.copy()).fit(train)
    for split, d in (("train", train), ("evaluate", test)):
        want = md.regression_metrics(model.transform(d), "y").first()["rmse"]
        assert abs(next(r["rmse"] for r in rows if r["split"] == split and r["round"] == 3) - want) < 1e-9
    assert sizes["ablation-train"] <= 60 and sizes["ablation-evaluate"] <= 60

    algos = {"tree": md.regressor("tree", label="y", maxDepth=3), "forest": md.regressor("forest", label="y", numTrees=8, maxDepth=4)}
    found = {(r["algo"], r["fold"]): (r["train_r2"], r["test_r2"]) for r in md.kfold_scores(df, "id", [3], cols, "y", algos).collect()}
    assert sizes["fold-cells"] <= 3 * 60
    for fold in range(3):
        learn, held = df.filter(f"floor(id / 1000) <> {fold}"), df.filter(f"floor(id / 1000) = {fold}")
        for name, est in algos.items():
            m = md.feature_pipeline(cols, est.copy()).fit(learn)
            want = [md.regression_metrics(m.transform(d), "y").first()["r2"] for d in (learn, held)]
            assert np.allclose(found[name, fold], want, atol=1e-9 if name == "tree" else 0.15), (name, fold)


def test_bags_are_bootstrap_samples_of_the_rows(spark):
    df = repeated(spark, 20_000)
    cells = md.distinct_vectors(df, ["a"], "y", bags=2).collect()
    assert sum(c["__n"] for c in cells) == 20_000
    for b in (0, 1):
        assert abs(sum(c[f"__n{b}"] for c in cells) - 20_000) < 6 * math.sqrt(20_000)
        assert all(abs(c[f"__y{b}"] - c["y"]) < 6 * math.sqrt(2 * c["__within"]) / c["__n"] for c in cells)
    assert [c["__n0"] for c in cells] != [c["__n1"] for c in cells]
