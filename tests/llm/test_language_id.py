import random

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm import language_id as li
from kestrel.llm.common import train_fold

WORDS = {"aa": "the and over house water green light people", "bb": "der und über haus wasser grün licht leute", "cc": "дом вода зелёный свет люди над и"}


def rows(n, seed):
    r = random.Random(seed)
    return [(i, " ".join(r.choices(WORDS[lang].split(), k=12)).title(), lang) for i, lang in enumerate(r.choices(list(WORDS), k=n))]


def test_vectors_are_bound_and_bundled():
    grams, counts = li.ngrams("Abab! ab")
    assert counts.sum() == len("abab") + len("ab")
    v = li.gram_vectors(grams, 512)
    a, b = li.letter_vectors(np.array([ord("a"), ord("b")]), 512).astype(int)
    aba = ord("a") << 42 | ord("b") << 21 | ord("a")
    assert np.array_equal(v[grams.tolist().index(aba)], a * np.roll(b, 1) * np.roll(a, 2))
    whole = li.bundle([(grams, counts)], np.zeros(1, int), 1, 512)[0]
    assert np.allclose(whole, (v * counts[:, None]).sum(axis=0))
    assert set(np.unique(v)) == {-1.0, 1.0}


def test_held_out_accuracy(spark):
    df = spark.createDataFrame(rows(300, 3), "doc_id long, text string, lang string")
    out = li.held_out_predictions(df).join(df.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert out.count() > 40 and out.filter("lang = lang_pred").count() == out.count()


def test_prediction_never_reads_lang(spark):
    df = spark.createDataFrame(rows(60, 4), "doc_id long, text string, lang string")
    model = li.prototypes(df)
    a = li.identify(df, model).orderBy("doc_id").collect()
    assert a == li.identify(df.withColumn("lang", F.lit("zz")).withColumn("lang_pred", F.lit(1)), model).orderBy("doc_id").collect()


def test_null_empty_long_and_repeated_rows(spark):
    base = rows(40, 5)
    odd = [(100, None, "aa"), (101, "", None), (102, "123 !?", "bb"), (103, "the " * 60000, None), (None, "der und haus", "bb"), (0, *base[0][1:]), (104, "x", None)]
    df = spark.createDataFrame(base + odd, "doc_id long, text string, lang string")
    out = li.identify(df, li.prototypes(df)).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert len(out) == 47 and got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[103][0] == "aa" and got[None][0] == "bb" and got[104][0] in WORDS
    assert all(0 <= s <= 1 for _, s in got.values())
    assert li.identify(df, li.prototypes(df.limit(0))).select("lang_pred").distinct().collect() == [("und",)]
    assert li.held_out_predictions(df.limit(0)).count() == 0
    assert df.filter(train_fold(F.col("doc_id"))).count() < 47


def plain_vector(text, dims):
    """Bundle of bound letter vectors by loops over the text's letters."""
    letters = [0]
    for ch in text.lower():
        x = ord(ch) if ch.isalpha() else 0
        if x or letters[-1]:
            letters.append(x)
    if letters[-1]:
        letters.append(0)
    out = np.zeros(dims)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if b:
            va, vb, vc = (li.letter_vectors(np.array([x]), dims)[0].astype(int) for x in (a, b, c))
            out += np.roll(va, 2) * np.roll(vb, 1) * vc
    return out


def test_predictions_equal_plain_loops(spark):
    data = rows(60, 8) + [(70, None, "aa"), (71, "12 ?", "bb"), (72, "der x1y haus", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    learn = {r.doc_id for r in df.filter(train_fold(F.col("doc_id"))).collect()}
    sums = {}
    for i, text, lang in data:
        if i in learn and lang and text:
            sums[lang] = sums.get(lang, 0) + plain_vector(text, li.DIMENSIONS)
    unit = {k: v / np.linalg.norm(v) for k, v in sums.items()}
    for r in li.held_out_predictions(df).collect():
        v = plain_vector(data[[x[0] for x in data].index(r.doc_id)][1] or "", li.DIMENSIONS)
        assert r.held_out == (r.doc_id not in learn)
        if not v.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosine = {k: float(v @ u / np.linalg.norm(v)) for k, u in unit.items()}
        assert r.lang_pred == max(sorted(cosine), key=cosine.get) and abs(r.score - max(0.0, cosine[r.lang_pred])) < 1e-4
