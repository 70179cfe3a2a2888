"""Toxicity classifier: a convolutional network over hashed word embeddings, in numpy.

A word's embedding is the sum of two hashed rows, of the word and of its first letters (so
that inflected forms help each other).  Filters of several widths slide over the words,
each filter's largest response is kept (max pooling over the whole text), and a linear
layer gives the logit.  Embeddings start from the rows' log odds.  All labelled texts are learnt
from: counts are summed by Spark, and the texts are dealt by hash to learners of about
``SHARD_DOCS`` texts, which descend from the same parameters; these are averaged after each
of ``ROUNDS`` rounds.  A threshold is calibrated per language on all of a fifth set aside, where
the language is guessed from the text by a table over the same hashed words; it shifts the
logit so that each language's threshold scores ``CUT``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import batch_of, in_buckets, text_chunks, train_fold
from kestrel.llm.decontaminate import words_of
from kestrel.session import drop_staged, stage_table

BUCKETS = 1 << 15
EMBEDDING, FILTERS, WIDTHS = 12, 12, (1, 2, 3)
SHARD_DOCS, SHARD_WORDS = 6400, 4 << 20    # texts of a learner and their words, about
ROUNDS = 3                   # times that several learners are averaged
LANGUAGES = 100              # commonest languages that are told apart by the guess
HELD_PART = 5                # one text of so many is set aside to calibrate on
UNIT, LOGIT_CELLS, WIDEST = 1 << 24, 256, 32    # whole numbers that averaged parameters are summed in, cells a logit unit and largest logit
BLOCK = 1 << 12              # parameters of a row of sums
EPOCHS, LEAST_STEPS, BATCH, RATE = 6, 300, 64, 0.01
CUT = 0.3
PREFIX = 4                   # letters of the second row
PAD = BUCKETS                # embedding row of the gaps between texts, always zero


class WordRows(dict):
    """Word to its two embedding rows (word, first letters) in one integer; emptied when it grows past its bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        prefix = word.decode("utf-8", "replace")[:PREFIX].encode("utf-8") + b"*"
        own, stem = (xxhash.xxh3_64_intdigest(x) % (BUCKETS // 2) for x in (word, prefix))
        pair = self[word] = own << 32 | stem + BUCKETS // 2
        return pair


class Model(NamedTuple):
    embedding: np.ndarray        # (BUCKETS + 1, EMBEDDING)
    filters: tuple               # per width: (width, EMBEDDING, FILTERS)
    biases: tuple                # per width: (FILTERS,)
    weights: np.ndarray          # (FILTERS * widths,)
    bias: float
    languages: np.ndarray        # (BUCKETS + 1, languages): log shares of the words
    thresholds: np.ndarray       # (languages,): logit at which a text is toxic


def rows_of(text: bytes, rows: WordRows) -> np.ndarray:
    """(words, 2): the embedding rows of each word."""
    words = words_of(text)
    pairs = np.fromiter(map(rows.__getitem__, words), np.int64, len(words))
    return np.column_stack([pairs >> 32, pairs & 0xFFFFFFFF]).astype(np.int32)


def _joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows with gaps after each text, and where the windows of each text start and end.

    A window starts on a word (or on the gap of a text without words) and ends in the gap at the latest.
    """
    gap = np.full((max(WIDTHS) + 1, 2), PAD, np.int32)
    sizes = np.array([len(d) for d in docs])
    starts = np.r_[0, np.cumsum(sizes + len(gap))[:-1]]
    return np.concatenate([x for d in docs for x in (d, gap)]), starts, starts + np.maximum(sizes, 1)


def _pooled(model: Model, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, places: bool = False):
    """Per text the largest response of each filter, and where it stands if asked."""
    best, where = [], []
    cuts = np.column_stack([starts, ends]).ravel()
    for width, w, b in zip(WIDTHS, model.filters, model.biases):
        at = len(rows) - width + 1
        response = np.zeros((at, FILTERS), np.float32)
        for k in range(width):
            seen = model.embedding @ w[k]
            response += seen[rows[k:k + at, 0]] + seen[rows[k:k + at, 1]]
        best.append(np.maximum.reduceat(response, cuts, axis=0)[::2] + b)
        if places:
            where.append(np.array([response[s:e].argmax(axis=0) + s for s, e in zip(starts, ends)]))
    return np.maximum(np.concatenate(best, axis=1), 0), where


def logits(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    return _pooled(model, *_joined(docs))[0] @ model.weights + model.bias


def guess_language(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    rows, starts, _ = _joined(docs)
    return np.add.reduceat(model.languages[rows[:, 0]] + model.languages[rows[:, 1]], starts, axis=0).argmax(axis=1)


def score(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """Probability-like score, ``CUT`` at the threshold of the text's guessed language."""
    shift = np.log(CUT / (1 - CUT)) - model.thresholds[guess_language(model, docs)]
    return 1 / (1 + np.exp(-np.clip(logits(model, docs) + shift, -30, 30)))


def _log_odds(seen: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Smoothed log odds of each row standing in a toxic text, 0 for rows never seen."""
    share = (seen + 0.5) / (labels[:, None] + 1)
    return np.where(seen.sum(axis=0) > 0, np.log(share[1] / share[0]), 0).astype(np.float32)


def _start(odds: np.ndarray, seed: int) -> list[np.ndarray]:
    """Parameters to descend from: embedding, filters and biases of each width, weights, bias."""
    r = np.random.default_rng(seed)
    embedding = r.normal(0, 0.05, (BUCKETS + 1, EMBEDDING)).astype(np.float32)
    embedding[:, 0] = odds / 4
    embedding[PAD] = 0
    filters = [r.normal(0, 0.3, (w, EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w in filters:
        w[:, 0, :FILTERS // 2] = 0.5       # half of the filters start by reading the log odds
    return [embedding, *filters, *[np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            r.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32), np.zeros(1, np.float32)]


def _model(params: list[np.ndarray], table: np.ndarray, thresholds: np.ndarray) -> Model:
    n = len(WIDTHS)
    return Model(params[0], tuple(params[1:1 + n]), tuple(params[1 + n:1 + 2 * n]), params[-2], float(params[-1][0]), table, thresholds)


def train(start: list[np.ndarray], docs: list[np.ndarray], y: np.ndarray, epochs: int, seed: int) -> list[np.ndarray]:
    """Parameters after ``epochs`` of descent (Adam) over a learner's texts."""
    r, params = np.random.default_rng(seed), [p.copy() for p in start]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step, nothing = 0, np.zeros(0, np.float32)
    for _ in range(epochs):
        for batch in np.array_split(r.permutation(len(docs)), max(1, len(docs) // BATCH)):
            model, step = _model(params, nothing, nothing), step + 1
            rows, starts, ends = _joined([docs[i] for i in batch])
            pooled, where = _pooled(model, rows, starts, ends, places=True)
            error = 1 / (1 + np.exp(-np.clip(pooled @ model.weights + model.bias, -30, 30))) - y[batch]
            error = (error / len(batch)).astype(np.float32)
            grads = [np.zeros_like(p) for p in params]
            grads[-1][0], grads[-2][:] = error.sum(), pooled.T @ error
            back = error[:, None] * model.weights * (pooled > 0)
            for n, width in enumerate(WIDTHS):
                g = back[:, n * FILTERS:(n + 1) * FILTERS]
                grads[1 + len(WIDTHS) + n][:] = g.sum(axis=0)
                for k in range(width):
                    at = rows[where[n] + k]                                     # (texts, filters, 2)
                    grads[1 + n][k] = np.einsum("tfre,tf->ef", params[0][at], g)
                    for row in (0, 1):
                        np.add.at(grads[0], at[:, :, row], g[:, :, None] * params[1 + n][k].T[None])
            grads[0][PAD] = 0
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)
    return params


def _features(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("label", pa.int32()), ("rows", pa.list_(pa.int32()))])
    rows = WordRows()
    for part, texts in text_chunks(batches):
        yield batch_of(schema, [*(part.column(k) for k in range(3)), [rows_of(t, rows).ravel() for t in texts]])


def _row_lists(column) -> list[np.ndarray]:
    """The embedding rows of each text, two bytes each."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype(np.uint16).reshape(-1, 2)
    return [values[x // 2:y // 2] for x, y in zip(ends[:-1], ends[1:])]


def _row_counts(batches, names: list[str]):
    """Of (lang, label, held, rows): per label (kinds 0, 1) how many texts to fit hold a row, per language (kinds from 2) how often it occurs."""
    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])
    counts = np.zeros((2 + len(names), BUCKETS + 1), np.int64)
    for part in batches:
        for lang, label, held, doc in zip(*(part.column(k).to_pylist() for k in range(3)), _row_lists(part.column(3))):
            if not held:
                counts[label, np.unique(doc)] += 1
            if lang in names:
                counts[2 + names.index(lang)] += np.bincount(doc.ravel(), minlength=BUCKETS + 1)
    kind, bucket = np.nonzero(counts)
    yield batch_of(schema, [kind.astype(np.int32), bucket.astype(np.int32), counts[kind, bucket]])


def _learn(batches, shared, epochs: int, seed: int):
    """Of (shard, label, rows), a shard's rows one after another: blocks of the sums of the learners' parameters, each as often as it has texts."""
    schema = pa.schema([("block", pa.int32()), ("texts", pa.int64()), ("sums", pa.binary())])
    start, docs, y, current, total, texts = shared.value, [], [], None, 0, 0

    def learnt():
        flat = np.concatenate([p.ravel() for p in train(start, docs, np.array(y, np.float32), epochs, seed + current)])
        return np.round(flat.astype(np.float64) * UNIT).astype(np.int64) * len(docs)

    for part in batches:
        for shard, label, doc in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), _row_lists(part.column(2))):
            if docs and shard != current:
                total, texts, docs, y = total + learnt(), texts + len(docs), [], []
            current = shard
            docs.append(doc)
            y.append(label)
    if docs:
        total, texts = total + learnt(), texts + len(docs)
        cuts = range(0, len(total), BLOCK)
        yield batch_of(schema, [list(range(len(cuts))), [texts] * len(cuts), [total[c:c + BLOCK].tobytes() for c in cuts]])


def _summed(table: pa.Table) -> pa.Table:
    sums = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table.column("sums"))
    return pa.table({"block": table.column("block")[:1], "texts": [sum(table.column("texts").to_pylist())], "sums": pa.array([sums.tobytes()], pa.binary())})


def _averaged(sharded: DataFrame, params: list[np.ndarray], epochs: int, seed: int) -> list[np.ndarray]:
    """Parameters after one round, the mean over the learners' texts.

    Sums are of whole numbers, so they do not depend on which tasks the learners run in.
    """
    shared = sharded.sparkSession.sparkContext.broadcast(params)
    sums = (sharded.mapInArrow(lambda it: _learn(it, shared, epochs, seed), "block int, texts long, sums binary")
            .groupBy("block").applyInArrow(_summed, "block int, texts long, sums binary")).toArrow().sort_by("block")
    flat = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in sums.column("sums")]) / UNIT / sums.column("texts")[0].as_py()
    ends = np.cumsum([p.size for p in params])
    return [x.reshape(p.shape).astype(np.float32) for x, p in zip(np.split(flat, ends[:-1]), params)]


def _cells(batches, shared):
    """Of (label, rows): guessed language, cell of the logit and label of each text."""
    schema = pa.schema([("lang", pa.int32()), ("cell", pa.int32()), ("label", pa.int32())])
    model = Model(*shared.value)
    for part in batches:
        docs, labels = _row_lists(part.column(1)), part.column(0)
        for at in range(0, len(docs), BATCH):
            some = docs[at:at + BATCH]
            cells = np.floor(np.clip(logits(model, some), -WIDEST, WIDEST) * LOGIT_CELLS)
            yield batch_of(schema, [guess_language(model, some).astype(np.int32), cells.astype(np.int32), labels.slice(at, len(some))])


def _calibrated(held: DataFrame, model: Model, languages: int) -> np.ndarray:
    """Per guessed language the logit with the best F1, midway between neighbours; over all texts where a language has few."""
    shared = held.sparkSession.sparkContext.broadcast(tuple(model))
    cells = (held.select("label", "rows").mapInArrow(lambda it: _cells(it, shared), "lang int, cell int, label int")
             .groupBy("lang", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"))).toArrow()
    lang, cell, n, toxic = (cells.column(c).to_numpy().astype(np.int64) for c in ("lang", "cell", "n", "toxic"))
    if not 0 < toxic.sum() < n.sum():
        return np.full(languages, np.log(CUT / (1 - CUT)))

    def best(some):
        places, of = np.unique(-cell[some], return_inverse=True)     # highest cell first
        hits, texts = (np.cumsum(np.bincount(of, x[some])) for x in (toxic, n))
        k = int((2 * hits / (texts + hits[-1])).argmax())
        low = (1 - places[k + 1]) / LOGIT_CELLS if k + 1 < len(places) else -places[k] / LOGIT_CELLS - 1
        return (-places[k] / LOGIT_CELLS + low) / 2

    everywhere = best(np.ones(len(cell), bool))
    return np.array([best(lang == k) if 20 <= toxic[lang == k].sum() < n[lang == k].sum() else everywhere for k in range(languages)])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
        seed: int = 13) -> Model:
    """Model from all labelled documents (label 0 or 1) that have an id and a text; of an id labelled twice with different values both rows are.

    Four fifths, by a hash of the id, are fitted to, thresholds are calibrated on the rest.
    """
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna().distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    features = stage_table(in_buckets(texts.filter(F.col("text").isNotNull()), known, ["doc_id"]).join(known.hint("merge"), "doc_id")
                           .select("doc_id", "lang", "label", "text").mapInArrow(_features, "doc_id long, lang string, label int, rows array<int>")
                           .withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(HELD_PART)) == 0), "toxicity-rows")
    names = sorted(r["lang"] for r in features.filter("lang IS NOT NULL").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()) or [""]
    found = (features.select("lang", "label", "held", "rows").mapInArrow(lambda it: _row_counts(it, names), "kind int, bucket int, n long")
             .groupBy("kind", "bucket").agg(F.sum("n").alias("n"))).toArrow()
    counts = np.zeros((2 + len(names), BUCKETS + 1))
    counts[found.column("kind").to_numpy(), found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    table = counts[2:].T + 0.1
    table = np.log(table / table.sum(axis=0)).astype(np.float32)
    table[PAD] = 0
    fitted = features.filter("NOT held")
    sizes = {r["label"]: r for r in fitted.groupBy("label").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.size("rows")).alias("rows")).collect()}
    per = np.array([sizes[k]["texts"] if k in sizes else 0 for k in (0, 1)], np.int64)
    params = _start(_log_odds(counts[:2], per), seed)
    if per.all():
        shards = int(max(1, -(-per.sum() // SHARD_DOCS), -(-sum(r["rows"] for r in sizes.values()) // (2 * SHARD_WORDS))))
        epochs = max(EPOCHS, -(-LEAST_STEPS // int(max(1, per.sum() // shards // BATCH))))
        sharded = stage_table(fitted.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(shards)).cast("int"))
                              .repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64("doc_id", "label"), "doc_id", "label")
                              .select("shard", "label", "rows"), "toxicity-shards")
        rounds = 1 if shards == 1 else ROUNDS
        for k in range(rounds):
            params = _averaged(sharded, params, epochs * (k + 1) // rounds - epochs * k // rounds, seed + k * shards)
        drop_staged(sharded)
    model = _model(params, table, np.zeros(len(names)))
    model = model._replace(thresholds=_calibrated(features.filter("held"), model, len(names)))
    drop_staged(features)
    return model


def _scores(batches, shared):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    model, rows = Model(*shared.value), WordRows()
    for part, texts in text_chunks(batches):
        yield batch_of(schema, [part.column(0), score(model, [rows_of(t, rows) for t in texts]).astype(np.float64)])


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted``: each whole text scored; predicted is 1 from ``CUT`` on.

    Null and empty texts are scored as texts without words.  One pass without a shuffle;
    repeated rows and null ids give rows of their own; an empty table gives an empty result;
    other columns are ignored.  A model fitted on one class only scores all texts alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (src.mapInArrow(lambda it: _scores(it, shared), "doc_id long, score double")
            .withColumn("predicted", (F.col("score") >= CUT).cast("int")))


def held_out_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's rows: learnt from the training fold's labels, scored for every document."""
    model = fit(docs, labels.filter(train_fold(F.col("doc_id"))))
    return toxicity_scores(docs, model).select("doc_id", (~train_fold(F.col("doc_id"))).alias("held_out"), "score", "predicted")
