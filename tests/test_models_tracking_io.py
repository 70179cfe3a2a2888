import math
import os

import numpy as np
from pyspark.sql import functions as F

from kestrel.operators import models as md
from kestrel.operators import tracking as tr
from kestrel.sources import files as fs


def _linear(spark, n=400):
    return fs.synthetic_linear(spark, n, seed=7, partitions=4)


def test_synthetic_linear_is_deterministic(spark):
    a = _linear(spark).orderBy("id").collect()
    b = _linear(spark).orderBy("id").collect()
    assert a == b and all(abs(r["x4"] - (2 * r["x1"] + 3 * r["x2"] + r["x3"])) < 1e-12 for r in a)


def test_metrics_match_numpy(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (3.0, 3.5), (4.0, 4.0)], "label double, prediction double")
    m = md.regression_metrics(df).first()
    y, p = np.array([1, 2, 3, 4.0]), np.array([1.5, 1, 3.5, 4])
    assert math.isclose(m["rmse"], math.sqrt(np.mean((y - p) ** 2)))
    assert math.isclose(m["mae"], np.mean(np.abs(y - p)))
    assert math.isclose(m["r2"], 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    a = md.accuracy(spark.createDataFrame([(1, 1.0), (0, 1.0)], "label int, prediction double")).first()
    assert a["accuracy"] == 0.5


def test_ols_recovers_exact_linear_map_and_save_load(spark, tmpdir_path):
    df = _linear(spark)
    model = md.feature_pipeline(["x1", "x2", "x3"], md.regressor("ols", label="x4")).fit(df)
    lr = model.stages[-1]
    assert np.allclose(lr.coefficients.toArray(), [2, 3, 1], atol=1e-8)
    path = os.path.join(tmpdir_path, "m")
    fs.save_model(model, path)
    again = fs.load_pipeline_model(path)
    a = model.transform(df).select("id", "prediction").orderBy("id").collect()
    b = again.transform(df).select("id", "prediction").orderBy("id").collect()
    assert a == b


def test_adaboost_beats_mean(spark):
    df = _linear(spark)
    predict, trees, alphas = md.adaboost_r2(df, ["x1", "x2", "x3"], "x4", n_estimators=4, max_depth=3)
    m = md.regression_metrics(predict(df), "x4").first()
    assert 1 <= len(trees) <= 4 and m["r2"] > 0.5


def test_kfold_scores_shape(spark):
    df = _linear(spark, 200)
    s = md.kfold_scores(df, "id", [3], ["x1", "x2", "x3"], "x4", {"ols": md.regressor("ols", label="x4")})
    rows = s.collect()
    assert len(rows) == 3 and all(r["test_r2"] > 0.99 for r in rows)
    assert md.mean_over_folds(s).count() == 1


def test_run_table_keeps_last_metric(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "runs")
    with tr.Run(spark, path, "exp", {"team": "x"}) as r:
        r.log_param("depth", 3)
        r.log_metric("rmse", 2.0, step=1)
        r.log_metric("rmse", 1.5, step=2)
        r.log_artifact("model", "/m/1")
    with tr.Run(spark, path, "exp") as r2:
        r2.log_metric("rmse", 1.7)
    runs = tr.runs_table(spark, path)
    got = {x["run_id"]: x for x in runs.collect()}
    assert got[r.run_id]["metrics"]["rmse"] == 1.5 and got[r.run_id]["params"]["depth"] == "3"
    best = tr.best_run(runs, "rmse").first()
    assert best["run_id"] == r.run_id
    assert tr.artifact_path(runs, r.run_id, "model") == "/m/1"


def test_file_sources(spark, tmpdir_path):
    pairs = os.path.join(tmpdir_path, "pairs.tsv")
    with open(pairs, "w", newline="") as f:
        f.write("input\toutput\r\nhi there\thello you\r\nbye\tsee you \r\n")
    got = [(r["input"], r["output"]) for r in fs.read_pairs(spark, pairs).collect()]
    assert got == [("hi there", "hello you"), ("bye", "see you")]
    pos = os.path.join(tmpdir_path, "one.pos")
    with open(pos, "w") as f:
        f.write("python/nn anaconda/nn and/or/cc jupyter/NN\n")
    t = fs.read_tagged(spark, pos).orderBy("pos").collect()
    assert [(r["word"], r["tag"]) for r in t] == [("python", "nn"), ("anaconda", "nn"), ("and/or", "cc"),
                                                   ("jupyter", "nn")]
    story = os.path.join(tmpdir_path, "story.txt")
    with open(story, "w") as f:
        f.write("Alice was\nbeginning to get\n")
    assert fs.read_whole_texts(spark, story).first()["text"] == "Alice was beginning to get"
    out = os.path.join(tmpdir_path, "out_csv")
    fs.write_table(spark.range(3), out, fmt="csv")
    assert spark.read.option("header", True).csv(out).count() == 3
    shape = fs.profile_shape(spark.range(5)).first()
    assert (shape["n_rows"], shape["n_cols"]) == (5, 1)


def test_dated_series_and_literal_frame(spark, tmpdir_path):
    path = f"{tmpdir_path}/dated.csv"
    fr = fs.literal_frame(spark, [("2020-01-05", 1.5), ("2020-02-05", 2.5), ("no date", 3.0)], "day string, level double")
    fs.write_table(fr, path, "csv")
    got = fs.read_dated_series(spark, path, "day", "level").orderBy("ts").collect()
    assert [(str(r["ts"])[:10], r["value"]) for r in got] == [("2020-01-05", 1.5), ("2020-02-05", 2.5)]


def test_naive_bayes_on_long_counts_equals_mllib(spark):
    from pyspark.ml.feature import CountVectorizer
    rows = [(i, t.split(), float(y)) for i, (t, y) in enumerate([("a a b", 0), ("b c", 1), ("c c d", 1), ("a d", 0), ("b b", 1), ("zz a", 0), ("", 1)])]
    docs = spark.createDataFrame(rows, "doc_id long, words array<string>, label double")
    train = F.col("doc_id") < 5
    counts = docs.select("doc_id", F.explode("words").alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))
    got = {r["doc_id"]: r["prediction"] for r in md.naive_bayes_predictions(counts, docs.select("doc_id", "label"), "doc_id", "label", train).collect()}
    vec = CountVectorizer(inputCol="words", outputCol="features").fit(docs.filter(train))
    want = md.classifier("naive_bayes").fit(vec.transform(docs.filter(train))).transform(vec.transform(docs))
    assert got == {r["doc_id"]: r["prediction"] for r in want.collect()}
