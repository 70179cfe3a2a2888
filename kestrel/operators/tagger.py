"""Part-of-speech tagging with context: a bigram hidden Markov model, decoded by Viterbi.

Training is two counts over a tagged corpus, combined map-side: tag after tag, and word with
tag.  Transitions are bounded by the tag set; word probabilities are a table with one row per
word, which is looked up with frequent words split off.  A sentence's best tag sequence is
found in a pandas UDF over its own tokens.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from kestrel.operators.lookup import lookup_join
from kestrel.session import stage_table

MAX_TAGS = 200               # tags of a model: their pairs reach the driver
ADDED = 0.1                  # added to every transition count


class TagModel(NamedTuple):
    """Tags, log probabilities of a tag after another (row 0: at the start), of an unknown word, and of known words (a table)."""
    tags: tuple[str, ...]
    transitions: np.ndarray      # (tags + 1, tags)
    unknown: np.ndarray          # (tags,)
    words: DataFrame             # word, logs: ARRAY<DOUBLE> in the tags' order (null where never seen)


def train_tagger(tagged: DataFrame, sentence: list[str], pos: str = "pos", word: str = "word", tag: str = "tag") -> TagModel:
    """Model from tagged tokens ``(sentence…, pos, word, tag)``; words are lower-cased.

    Transitions have ``ADDED`` added to each count.  An unknown word has a tag with the share of
    that tag's tokens whose word occurs once in the corpus (one token more is supposed).  Tokens
    with a null word or tag are left out.
    """
    tokens = tagged.select(*sentence, pos, F.lower(word).alias("word"), F.col(tag).alias("tag")).dropna(subset=["word", "tag"])
    before = F.lag("tag").over(Window.partitionBy(*sentence).orderBy(pos))   # one sentence's tokens
    pairs = tokens.select(before.alias("before"), "tag").groupBy("before", "tag").agg(F.count(F.lit(1)).alias("n")).limit(MAX_TAGS * (MAX_TAGS + 1) + 1).collect()
    tags = tuple(sorted({r["tag"] for r in pairs}))
    if len(tags) > MAX_TAGS:
        raise ValueError(f"more than {MAX_TAGS} tags")
    at = {t: i for i, t in enumerate(tags)}
    n = np.full((len(tags) + 1, len(tags)), ADDED)
    for r in pairs:
        n[0 if r["before"] is None else at[r["before"]] + 1, at[r["tag"]]] += r["n"]
    transitions = np.log(n / n.sum(axis=1, keepdims=True)) if tags else n
    counts = stage_table(tokens.groupBy("word", "tag").agg(F.count(F.lit(1)).alias("n")), "word-tags")
    single = counts.groupBy("word").agg(F.sum("n").alias("all"), F.max("tag").alias("tag")).filter("all = 1").groupBy("tag").agg(F.count(F.lit(1)).alias("once"))
    totals = {r["tag"]: (r["n"], r["once"] or 0) for r in counts.groupBy("tag").agg(F.sum("n").alias("n")).join(single, "tag", "left").collect()}
    unknown = np.array([math.log((totals[t][1] + 1) / (totals[t][0] + 1)) for t in tags])
    logs = F.array(*[F.max(F.when(F.col("tag") == t, F.ln(F.col("n") / float(totals[t][0])))) for t in tags]) if tags else F.array().cast("array<double>")
    return TagModel(tags, transitions, unknown, counts.groupBy("word").agg(logs.alias("logs")))


def viterbi(emissions: np.ndarray, transitions: np.ndarray) -> list[int]:
    """Most probable state sequence from (tokens, states) log emissions; of equal ones the first state at the last difference."""
    if not len(emissions):
        return []
    best, back = transitions[0] + emissions[0], []
    for row in emissions[1:]:
        through = best[:, None] + transitions[1:]
        came = through.argmax(axis=0)
        back.append(came)
        best = through[came, np.arange(len(came))] + row
    path = [int(best.argmax())]
    for came in reversed(back):
        path.append(int(came[path[-1]]))
    return path[::-1]


def tag_sentences(tokens: DataFrame, sentence: list[str], model: TagModel, pos: str = "pos", word: str = "word") -> DataFrame:
    """``(sentence…, pos, word, tag)``: every token with its tag on the most probable path of its sentence.

    ``tokens`` has a row per token; null words are unknown words.
    """
    rows = stage_table(tokens.select(*sentence, pos, F.col(word).alias("word"), F.lower(word).alias("__key")), "tokens")
    known = lookup_join(rows, model.words.withColumnRenamed("word", "__key"), "__key", "left")
    transitions, unknown, names = model.transitions, model.unknown, np.array(model.tags or ("",), dtype=object)

    @pandas_udf(T.ArrayType(T.StringType()))
    def decode(logs: pd.Series) -> pd.Series:
        out = []
        for sent in logs:
            e = np.array([unknown if x is None else [-np.inf if v is None or v != v else v for v in x] for x in sent], float).reshape(len(sent), -1)
            out.append([names[i] for i in viterbi(e, transitions)] if transitions.size else [None] * len(sent))
        return pd.Series(out)

    whole = known.groupBy(*sentence).agg(F.sort_array(F.collect_list(F.struct(pos, "word", "logs"))).alias("__t"))
    logs = F.transform("__t", lambda t: t["logs"])
    tagged = whole.select(*sentence, "__t", decode(logs).alias("__tags"))
    return tagged.select(*sentence, F.inline(F.zip_with("__t", "__tags", lambda t, g: F.struct(t[pos].alias(pos), t["word"].alias("word"), g.alias("tag")))))
