"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point.  An n-gram's
vector binds its letters' vectors, each permuted (rotated) by its place, by elementwise
product; a text's vector bundles (adds) its n-grams' vectors.  A language's prototype
bundles its training texts, and a text is given the language of the largest cosine.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import batch_of, text_chunks, train_fold

DIMENSIONS, LETTERS = 1024, 3
MAX_LANGUAGES = 1000          # prototypes sent to the tasks
BLOCK = 8192                  # n-grams whose vectors are held at once
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts) of the lower-cased letters; a run of other characters is one boundary, as are both ends.

    An n-gram packs code points of 21 bits; the boundary is 0 and no n-gram has it in its middle.
    """
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    c = np.concatenate([np.zeros(1, np.uint32), np.where(_letters()[c], c, 0), np.zeros(1, np.uint32)])
    c = c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]].astype(np.uint64)
    if len(c) < LETTERS:
        return c[:0], c[:0].astype(np.int64)
    gram = (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]
    return np.unique(gram[c[1:-1] != 0], return_counts=True)


def letter_vectors(code_points: np.ndarray, dimensions: int) -> np.ndarray:
    """Rows of +1 and -1: bits of a 64-bit mixer over (code point, word), equal in every task."""
    x = (code_points.astype(np.uint64)[:, None] << np.uint64(16)) + np.arange(dimensions // 64, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return np.unpackbits(x.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors of packed n-grams."""
    places = [(grams >> np.uint64(21 * k)) & np.uint64(0x1FFFFF) for k in range(LETTERS)]
    points, at = np.unique(np.concatenate(places), return_inverse=True)
    base = letter_vectors(points, dimensions)
    at = at.reshape(LETTERS, len(grams))
    out = base[at[0]]
    for k in range(1, LETTERS):
        out *= np.roll(base, k, axis=1)[at[k]]
    return out.astype(np.float32)


def bundle(parts: list[tuple[np.ndarray, np.ndarray]], owner: np.ndarray, rows: int, dimensions: int) -> np.ndarray:
    """Bundled vectors: row ``owner[i]`` adds the n-grams of ``parts[i]``."""
    out = np.zeros((rows, dimensions), np.float32)
    if not parts:
        return out
    grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    counts = np.concatenate([n for _, n in parts])
    row = np.repeat(owner, [len(g) for g, _ in parts])
    for low in range(0, len(grams), BLOCK):
        inside = (at >= low) & (at < low + BLOCK)
        width = min(BLOCK, len(grams) - low)
        table = np.bincount(row[inside] * width + at[inside] - low, counts[inside], rows * width).reshape(rows, width)
        out += table.astype(np.float32) @ gram_vectors(grams[low:low + width], dimensions)
    return out


def _profiles(batches, dimensions: int):
    """One row per language and task: the bundle of its texts."""
    schema = pa.schema([("lang", pa.string()), ("bundle", pa.list_(pa.float64()))])
    total: dict[str, np.ndarray] = {}
    for part, texts in text_chunks(batches):
        langs, owner = np.unique(np.array(part.column(0).to_pylist(), object).astype(str), return_inverse=True)
        vectors = bundle([ngrams(t.decode("utf-8")) for t in texts], owner, len(langs), dimensions)
        for lang, v in zip(langs.tolist(), vectors.astype(np.float64)):
            total[lang] = total[lang] + v if lang in total else v
    if total:
        yield batch_of(schema, [list(total), [v.tolist() for v in total.values()]])


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """(languages, matrix of unit prototypes) learnt from all rows with a language and a text.

    Only one vector per language and task is shuffled, and ``MAX_LANGUAGES`` at most reach the driver.
    """
    src = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    rows = (src.mapInArrow(lambda it: _profiles(it, dimensions), "lang string, bundle array<double>")
            .groupBy("lang").agg(vector_to_array(Summarizer.sum(array_to_vector("bundle"))).alias("bundle"))
            .limit(MAX_LANGUAGES + 1).collect())
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    rows = sorted((r["lang"], r["bundle"]) for r in rows if any(r["bundle"]))
    matrix = np.array([r[1] for r in rows], np.float32).reshape(len(rows), dimensions)
    return [r[0] for r in rows], matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def best_languages(texts: list[str], languages: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and cosine (0 at least) of each text; of equal cosines the first language by name."""
    parts = [ngrams(t) for t in texts]
    vectors = bundle(parts, np.arange(len(texts)), len(texts), matrix.shape[1])
    if not languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    cosine = vectors @ matrix.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    best = cosine.argmax(axis=1)
    known = [len(g) > 0 for g, _ in parts]
    return ([languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known)],
            np.where(known, np.clip(cosine[np.arange(len(texts)), best], 0, 1), 0.0).astype(np.float64))


def _predict(batches, model):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    languages, matrix = model.value
    for part, texts in text_chunks(batches):
        yield batch_of(schema, [part.column(0), *best_languages([t.decode("utf-8") for t in texts], languages, matrix)])


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score``: the language of each whole text.

    A null text, or one without a letter, is ``und`` with score 0, as is every text when nothing
    was learnt.  One pass without a shuffle; repeated rows and null ids give rows of their own;
    an empty table gives an empty result; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(lambda it: _predict(it, shared), "doc_id long, lang_pred string, score double")


def held_out_predictions(docs: DataFrame) -> DataFrame:
    """The query's rows: learnt from the training fold, predicted for every document."""
    model = prototypes(docs.filter(train_fold(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", (~train_fold(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")
