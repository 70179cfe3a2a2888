import random

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm import quality as q
from kestrel.llm.sampling import within_bytes

GOOD, BAD = [f"word{k}" for k in range(60)], ["AAA!!", "***", "|", "x&&&", "$$$"]


def rows(n, seed, levels):
    r = random.Random(seed)
    out = []
    for i in range(n):
        g = r.randrange(levels)
        share = 1 - (g + 0.5) / levels
        out.append((i, " ".join(r.choice(BAD) if r.random() < share else r.choice(GOOD) for _ in range(80)), g * 10))
    return out


def frames(spark, data):
    return (spark.createDataFrame([(i, t, 3) for i, t, _ in data], "doc_id long, text string, kept int"),
            spark.createDataFrame([(i, g) for i, _, g in data], "doc_id long, quality int"))


def test_four_grades_are_ordered_and_accurate_on_held_out_rows(spark):
    docs, labels = frames(spark, rows(1200, 1, 4))
    model = q.fit(docs, labels.filter("doc_id < 800"))
    assert list(model.grades) == [0, 10, 20, 30] and np.all(np.diff(model.thresholds) > 0)
    out = q.quality_scores(docs.filter("doc_id >= 800"), model).join(labels, "doc_id").collect()
    assert len(out) == 400 and np.mean([abs(x.expected_grade - x.quality) for x in out]) < 4
    means = [np.mean([x.expected_grade for x in out if x.quality == g]) for g in (0, 10, 20, 30)]
    assert means == sorted(means)
    assert all(0 <= x.tail_probability <= 1 and 0 <= x.expected_grade <= 30 for x in out)
    assert np.mean([x.kept for x in out if x.quality == 30]) > 0.9


def test_expected_grade_and_tail_agree_with_the_grade_probabilities():
    model = q.Model(np.zeros(q.FEATURES), np.array([-1.0, 0.5]), np.array([0, 1, 5]), 0.5)
    docs = [q.features(b"some words here", q._Columns())]
    above = 1 / (1 + np.exp(model.thresholds))
    p = [1 - above[0], above[0] - above[1], above[1]]
    expected, tail = q.assess(model, docs)
    assert np.isclose(expected[0], p[1] + 5 * p[2]) and np.isclose(tail[0], p[2])
    assert np.isclose(q.assess(model, docs, target=1)[1][0], p[1] + p[2]) and q.assess(model, docs, target=0)[1][0] == 1


def test_gradient_lowers_the_loss_to_the_empirical_shares():
    docs = [q.features(b"same text", q._Columns())] * 400
    grade = np.array([0] * 100 + [1] * 60 + [2] * 240)
    w, theta = q.fit_ordinal(docs, grade, 3)
    above = 1 / (1 + np.exp(theta - q.margins(w, docs)[0]))
    assert np.allclose(above, [0.75, 0.6], atol=0.06)


def test_selection_keeps_columns_and_odd_rows(spark):
    data = rows(300, 2, 2)
    docs, labels = frames(spark, data)
    model = q.fit(docs, labels)
    odd = spark.createDataFrame([(900, None, 1), (901, "", 1), (902, "word1 " * 80000, 1), (None, "*** ***", 1), (903, " \t", 1)], docs.schema)
    every = docs.unionByName(odd).withColumn("tail_probability", F.lit("clash"))
    scored = {r.doc_id: r for r in q.quality_scores(every, model).collect()}
    left = q.select_good(every, model)
    assert left.columns == every.columns and len(scored) == 305
    assert {r.doc_id for r in left.collect()} == {i for i, r in scored.items() if r.kept}
    assert scored[900].tail_probability == scored[901].tail_probability == scored[903].tail_probability
    assert scored[902].kept and not scored[None].kept
    assert q.select_good(every.limit(0), model).count() == 0


def test_one_grade_or_no_labels_keep_all(spark):
    docs, labels = frames(spark, rows(30, 3, 2))
    for some in (labels.limit(0), labels.withColumn("quality", F.lit(1)), labels.withColumn("quality", F.lit(None).cast("int"))):
        assert q.select_good(docs, q.fit(docs, some)).count() == 30


def test_the_sample_is_bounded_in_bytes_and_not_by_the_length_of_a_text(spark):
    rows = [(i, "word " * (30_000 if i == 7 else 20), i % 2) for i in range(40)]
    drawn = spark.createDataFrame(rows, "doc_id long, text string, label int")
    whole = within_bytes(drawn, F.length("text"), 10 ** 7).collect()
    assert sorted(tuple(r) for r in whole) == rows
    some = within_bytes(drawn, F.length("text"), 1000).collect()
    assert 1 <= len(some) <= 11 and (len(some) == 1 or sum(len(r.text) for r in some) <= 1000)
    assert within_bytes(drawn.limit(0), F.length("text"), 1000).count() == 0


def test_scores_equal_a_plain_computation(spark):
    docs, labels = frames(spark, rows(200, 9, 3))
    model = q.fit(docs, labels)
    odd = spark.createDataFrame([(900, None, 1), (901, " \t ", 1), (902, "Some WORD1 99 !!", 1)], docs.schema)
    every = docs.limit(30).unionByName(odd)
    texts = {r.doc_id: r.text for r in every.collect()}
    for r in q.quality_scores(every, model).collect():
        words, counts = (texts[r.doc_id] or "").encode().split(), {}
        for w in words:
            for f in q._Columns()[w]:
                counts[f] = counts.get(f, 0) + 1
        margin = sum(float(model.weights[f]) * (n / len(words)) ** 0.5 for f, n in counts.items()) if words else float(model.weights[q.FEATURES - 1])
        above = [1 / (1 + np.exp(-(margin - t))) for t in model.thresholds]
        expected = model.grades[0] + sum(p * (b - a) for p, a, b in zip(above, model.grades, model.grades[1:]))
        assert abs(r.expected_grade - expected) < 1e-4 and abs(r.tail_probability - above[-1]) < 1e-5
        assert r.kept == (r.tail_probability >= model.cut)
