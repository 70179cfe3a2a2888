"""Quality classifier: ordinal regression with a cumulative link over hashed text features.

All grades share one weight vector over hashed words and word shapes; ordered thresholds
give P(grade > g) = sigmoid(w x - threshold_g).  The expected grade and the tail
probability P(grade >= target) follow.  It is fitted in numpy on a bounded sample of graded
documents; the cut on the tail probability is set on a part of the sample put aside, so
that few good documents are lost.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import batch_of, text_chunks
from kestrel.llm.sampling import labelled_sample, within_bytes

FEATURES = 1 << 16
PER_GRADE = 5000             # bound of the sample, for each grade
SAMPLE_BYTES = 64 << 20      # bound of the sample's features
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.05, 1e-4
KEEP_GOOD = 0.995            # share of the good documents put aside that the cut must keep
# Byte classes of a word's shape: a for letters (and bytes above ASCII), A for capitals, 9 for digits.
SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b for b in range(256))
REPEATS = re.compile(rb"(.)\1+", re.S)


class Model(NamedTuple):
    weights: np.ndarray      # (FEATURES,)
    thresholds: np.ndarray   # ascending, one between each two grades
    grades: np.ndarray       # ascending values
    cut: float               # least tail probability that is kept


class _Columns(dict):
    """Word to its feature numbers: the word itself and its shape (runs of a class written once)."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) > 300_000:
            self.clear()
        shape = REPEATS.sub(rb"\1", word.translate(SHAPE))
        out = self[word] = (xxhash.xxh3_64_intdigest(word.lower()) % (FEATURES // 2),
                            FEATURES // 2 + xxhash.xxh3_64_intdigest(shape) % (FEATURES // 2 - 1))
        return out


def features(text: bytes, columns: _Columns) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values): root of each feature's share of the words, so the squares of a kind add up to 1."""
    words = text.split()
    if not words:
        return np.array([FEATURES - 1], np.int32), np.ones(1, np.float32)
    at = np.array(list(map(columns.__getitem__, words)), np.int32).ravel()
    index, n = np.unique(at, return_counts=True)
    return index.astype(np.int32), np.sqrt(n / len(words)).astype(np.float32)


def _flat(docs):
    return (np.concatenate([i for i, _ in docs]), np.concatenate([v for _, v in docs]), np.r_[0, np.cumsum([len(i) for i, _ in docs])[:-1]])


def margins(weights: np.ndarray, docs) -> np.ndarray:
    index, value, starts = _flat(docs)
    return np.add.reduceat(weights[index] * value, starts)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_ordinal(docs: list, grade: np.ndarray, levels: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by minibatch Adam on the cumulative-link likelihood.

    Grades are 0 to ``levels`` - 1.  Thresholds are a first one plus positive steps
    (exponentials), so they stay ordered.
    """
    r = np.random.default_rng(seed)
    w, theta = np.zeros(FEATURES), np.zeros(max(levels - 1, 0))
    if levels < 2 or not docs:
        return w, theta
    share = np.array([np.mean(grade > k) for k in range(levels - 1)]).clip(1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    free = np.r_[start[0], np.log(np.maximum(np.diff(start), 1e-2))]
    order = lambda f: f[0] + np.r_[0, np.cumsum(np.exp(f[1:]))]
    params, step = [w, free], 0
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for _ in range(EPOCHS):
        for batch in np.array_split(r.permutation(len(docs)), max(1, len(docs) // BATCH)):
            step += 1
            part, g = [docs[i] for i in batch], grade[batch]
            index, value, starts = _flat(part)
            s = np.add.reduceat(params[0][index] * value, starts)
            theta = order(params[1])
            # P(grade = g) = F(upper) - F(lower), F logistic over threshold - margin
            upper = np.where(g < levels - 1, _sigmoid(np.r_[theta, 0][g] - s), 1.0)
            lower = np.where(g > 0, _sigmoid(np.r_[0, theta][g] - s), 0.0)
            p = np.maximum(upper - lower, 1e-9)
            du, dl = upper * (1 - upper), lower * (1 - lower)
            back = (du - dl) / p / len(batch)                                   # of the loss, by margin
            gw = np.bincount(index, np.repeat(back, np.diff(np.r_[starts, len(index)])) * value, FEATURES) + DECAY * params[0]
            gt = (np.bincount(np.where(g < levels - 1, g, 0), np.where(g < levels - 1, -du / p, 0), levels - 1)[:levels - 1]
                  + np.bincount(np.where(g > 0, g - 1, 0), np.where(g > 0, dl / p, 0), levels - 1)[:levels - 1]) / len(batch)
            tail = np.cumsum(gt[::-1])[::-1]                                    # a step moves every threshold above it
            for q, grad, (m, v) in zip(params, (gw, np.r_[tail[0], tail[1:] * np.exp(params[1][1:])]), moments):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                q -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return params[0], order(params[1])


def tail_probabilities(model: Model, docs: list) -> np.ndarray:
    """(documents, thresholds): P(grade above each threshold)."""
    return _sigmoid(margins(model.weights, docs)[:, None] - model.thresholds[None])


def assess(model: Model, docs: list, target: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and P(grade >= ``target``) (by default the highest grade)."""
    if not len(model.grades):
        return np.zeros(len(docs)), np.ones(len(docs))
    above = tail_probabilities(model, docs)
    expected = model.grades[0] + above @ np.diff(model.grades)
    at = len(model.grades) - 1 if target is None else int(np.searchsorted(model.grades, target))
    tail = np.ones(len(docs)) if at == 0 else above[:, at - 1] if at <= above.shape[1] else np.zeros(len(docs))
    return expected, tail


def train(docs: list, values: np.ndarray, target: int | None = None, seed: int = 11) -> Model:
    """Fit on four fifths; set the cut on the rest: 0.5, or lower to keep ``KEEP_GOOD`` of the good ones."""
    grades = np.unique(values)
    if len(grades) < 2:
        return Model(np.zeros(FEATURES), np.zeros(max(len(grades) - 1, 0)), grades, 0.0)
    order = np.random.default_rng(seed).permutation(len(docs))
    held, fit = order[:len(docs) // 5], order[len(docs) // 5:]
    weights, thresholds = fit_ordinal([docs[i] for i in fit], np.searchsorted(grades, values[fit]), len(grades))
    model = Model(weights, thresholds, grades, 0.5)
    good = [docs[i] for i in held if values[i] >= (grades[-1] if target is None else target)]
    if good:
        model = model._replace(cut=float(min(0.5, np.quantile(assess(model, good, target)[1], 1 - KEEP_GOOD))))
    return model


def _sampled(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("index", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])
    columns = _Columns()
    for part, texts in text_chunks(batches):
        found = [features(t, columns) for t in texts]
        yield batch_of(schema, [part.column(0), part.column(1), [i for i, _ in found], [v for _, v in found]])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", target: int | None = None, id_col: str = "doc_id", text_col: str = "text",
        per_grade: int = PER_GRADE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Model from a sample of graded documents, bounded in rows and in feature bytes: any number of ordered integer grades."""
    sample = labelled_sample(docs, labels, label, per_grade, id_col, text_col)
    found = (sample.select("doc_id", F.col("label").cast("int").alias("label"), "text")
             .mapInArrow(_sampled, "doc_id long, label int, index array<int>, value array<float>"))
    rows = (within_bytes(found, 8 * F.size("index"), sample_bytes).toArrow()
            .sort_by([("doc_id", "ascending"), ("label", "ascending")]))
    found = [(np.asarray(i.values), np.asarray(v.values)) for i, v in zip(rows.column("index"), rows.column("value"))]
    return train(found, np.asarray(rows.column("label").to_pylist(), np.int64), target)


def _judge(batches, shared, text_col: str, target):
    """Batches with two columns more: expected grade and tail probability."""
    model, columns = Model(*shared.value), _Columns()
    for part, texts in text_chunks(batches, text_col):
        expected, tail = assess(model, [features(t, columns) for t in texts], target)
        fields = [*part.schema, pa.field("expected_grade", pa.float64()), pa.field("tail_probability", pa.float64())]
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(expected, pa.float64()), pa.array(tail, pa.float64())], schema=pa.schema(fields))


def quality_scores(docs: DataFrame, model: Model, target: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, expected_grade, tail_probability, kept`` for each whole text.

    Null, empty and blank texts are scored by one feature of their own.  One pass without a
    shuffle; repeated rows and null ids give rows of their own; an empty table gives an empty
    result; other columns are ignored.  A model of fewer than two grades keeps every document.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (src.mapInArrow(lambda it: _judge(it, shared, "text", target), "doc_id long, text string, expected_grade double, tail_probability double")
            .select("doc_id", "expected_grade", "tail_probability", (F.col("tail_probability") >= model.cut).alias("kept")))


def select_good(docs: DataFrame, model: Model, target: int | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected rows; all columns stay, whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain, text = docs.toDF(*names), names[docs.columns.index(text_col)]
    schema = T.StructType([*plain.schema.fields, T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType())])
    judged = plain.mapInArrow(lambda it: _judge(it, shared, text, target), schema)
    return judged.filter(F.col("tail_probability") >= model.cut).select(*names).toDF(*docs.columns)


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's rows: every document judged by a model fitted on the labelled ones."""
    return quality_scores(docs, fit(docs, labels))
