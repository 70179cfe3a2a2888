import random

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm import toxicity as tx
from kestrel.llm.common import train_fold

VOCAB = {"aa": [f"wort{k}" for k in range(200)], "bb": [f"mot{k}" for k in range(200)]}
BAD = {"aa": ["grumbleA", "grumbleB", "snarl"], "bb": ["zutX", "zutY", "flûte"]}


def rows(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang, toxic = r.choice(["aa", "bb"]), int(r.random() < 0.25)
        w = r.choices(VOCAB[lang], k=r.choice([5, 30, 120]))
        for _ in range(3 * toxic):
            w.insert(r.randrange(len(w)), r.choice(BAD[lang]))
        out.append((i, " ".join(w), lang, toxic))
    return out


def frames(spark, data):
    return (spark.createDataFrame([x[:3] for x in data], "doc_id long, text string, lang string"),
            spark.createDataFrame([(x[0], x[3]) for x in data], "doc_id long, toxic int"))


def test_held_out_accuracy_and_fixed_cut(spark):
    docs, labels = frames(spark, rows(1500, 1))
    out = tx.held_out_scores(docs.withColumn("score", F.lit("clash")), labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(out) > 250 and np.mean([r.predicted == r.toxic for r in out]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in out)


def test_scores_read_text_only_and_whole(spark):
    data = rows(800, 2)
    docs, labels = frames(spark, data)
    model = tx.fit(docs, labels)
    late = " ".join(VOCAB["aa"] * 500 + BAD["aa"])
    odd = spark.createDataFrame([(9000, None, None), (9001, "", "aa"), (9002, late, "aa"), (None, "grumbleA snarl grumbleB", "bb"), (9003, " ".join(VOCAB["aa"]), None)], docs.schema)
    every = docs.unionByName(odd)
    got = {r.doc_id: (r.score, r.predicted) for r in tx.toxicity_scores(every, model).collect()}
    other = {r.doc_id: (r.score, r.predicted) for r in tx.toxicity_scores(every.withColumn("lang", F.lit("zz")), model).collect()}
    assert got == other and len(got) == 805
    assert got[9000] == got[9001] and got[9002][1] == 1 and got[None][1] == 1 and got[9003][1] == 0
    assert tx.toxicity_scores(every.limit(0), model).count() == 0


def test_labels_of_the_other_fold_do_not_matter(spark):
    docs, labels = frames(spark, rows(300, 3))
    flipped = labels.withColumn("toxic", F.when(train_fold(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in tx.held_out_scores(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_one_class_or_no_labels(spark):
    docs, labels = frames(spark, rows(40, 4))
    for some in (labels.limit(0), labels.filter("toxic = 0")):
        assert tx.held_out_scores(docs, some).count() == 40


def test_windows_never_hold_words_of_two_texts():
    model = tx.Model(np.r_[np.eye(tx.BUCKETS + 1, tx.EMBEDDING, dtype=np.float32)], tuple(np.ones((w, tx.EMBEDDING, tx.FILTERS), np.float32) for w in tx.WIDTHS),
                     tuple(np.zeros(tx.FILTERS, np.float32) for _ in tx.WIDTHS), np.ones(tx.FILTERS * len(tx.WIDTHS), np.float32), 0.0,
                     np.zeros((tx.BUCKETS + 1, 1), np.float32), np.zeros(1))
    empty, one, three = np.zeros((0, 2), np.int32), np.zeros((1, 2), np.int32), np.zeros((3, 2), np.int32)
    docs = [empty, one, three, empty, one]
    assert np.allclose(tx.logits(model, docs), [tx.logits(model, [d])[0] for d in docs])


def plain_score(model, words):
    """The network by loops over words, filters and languages."""
    rows = [divmod(tx.WordRows()[w], 1 << 32) for w in words]
    zero = np.zeros(tx.EMBEDDING)
    word = [model.embedding[a] + model.embedding[b] for a, b in rows] or [zero]
    pooled = []
    for width, filters, bias in zip(tx.WIDTHS, model.filters, model.biases):
        for f in range(tx.FILTERS):
            best = max(sum(float((word[at + k] if at + k < len(word) else zero) @ filters[k, :, f]) for k in range(width)) for at in range(len(word)))
            pooled.append(max(best + bias[f], 0.0))
    logit = float(np.array(pooled) @ model.weights) + model.bias
    by_lang = [sum(model.languages[a, k] + model.languages[b, k] for a, b in rows) for k in range(len(model.thresholds))]
    shift = np.log(tx.CUT / (1 - tx.CUT)) - model.thresholds[int(np.argmax(by_lang))]
    return 1 / (1 + np.exp(-np.clip(logit + shift, -30, 30)))


def test_scores_equal_a_plain_forward_pass(spark):
    docs, labels = frames(spark, rows(300, 6))
    model = tx.fit(docs, labels)
    odd = spark.createDataFrame([(9000, None, None), (9001, "grumbleA", "aa"), (9002, "x ! y", None)], docs.schema)
    for r in tx.toxicity_scores(docs.limit(40).unionByName(odd), model).join(docs.unionByName(odd).select("doc_id", "text"), "doc_id").collect():
        want = plain_score(model, tx.words_of((r.text or "").encode()))
        assert abs(r.score - want) < 1e-3 and r.predicted == int(r.score >= tx.CUT)


def test_a_text_of_any_length_is_trained_on(spark):
    """The only toxic texts are long ones: their words are learnt."""
    filler = " ".join(VOCAB["aa"] * 150)
    data = [(i, filler + " " + " ".join(BAD["aa"]) if i % 8 == 0 else " ".join(VOCAB["aa"][i % 50:i % 50 + 40]), "aa", int(i % 8 == 0)) for i in range(160)]
    docs, labels = frames(spark, data)
    model = tx.fit(docs, labels)
    got = {r.doc_id: r.predicted for r in tx.toxicity_scores(spark.createDataFrame([(1, "snarl grumbleA grumbleB", "aa"), (2, "wort1 wort2", "aa")], docs.schema), model).collect()}
    assert got == {1: 1, 2: 0}


def test_every_labelled_text_is_learnt_from(spark, monkeypatch):
    """Counts and thresholds are those of all labelled texts, whatever their number; several learners are averaged."""
    data = [(i, f"wort{i % 90} mot{i % 70} " + ("snarl" if i % 11 == 0 else f"only{i}"), "ab"[i % 2], int(i % 11 == 0)) for i in range(2600)]
    docs, labels = frames(spark, data)
    monkeypatch.setattr(tx, "SHARD_DOCS", 900, raising=False)
    monkeypatch.setattr(tx, "EPOCHS", 2)
    monkeypatch.setattr(tx, "LEAST_STEPS", 20)
    model = tx.fit(docs, labels)
    want = np.full((tx.BUCKETS + 1, 2), 0.1)
    for _, text, lang, _ in data:
        np.add.at(want[:, "ab".index(lang)], tx.rows_of(text.encode(), tx.WordRows()).ravel(), 1)
    want = np.log(want / want.sum(axis=0))
    assert np.allclose(model.languages[:tx.PAD], want[:tx.PAD], atol=1e-4)
    got = {r.doc_id: r.predicted for r in tx.toxicity_scores(docs, model).collect()}
    assert np.mean([got[i] == toxic for i, _, _, toxic in data]) > 0.98
