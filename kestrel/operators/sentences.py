"""Sentence splitting with abbreviations and sentence starters learnt from the text itself.

Unsupervised, after Kiss and Strunk (2006): a word that nearly always stands before a period,
is short and often has periods inside, is an abbreviation; a word that follows clear sentence
ends far more often than chance is a sentence starter.  Both come from counts per word type
(distributed, combined map-side).  A model holds every word found.  A list of up to
``MODEL_ENTRIES`` words is applied as a hash set in column expressions, so splitting is one pass
without a shuffle; a longer one stays a table, which the texts' candidate words are joined with.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.lookup import lookup_join
from kestrel.session import stage_table

# Thresholds of the published method.
ABBREVIATION_SCORE, STARTER_SCORE = 0.3, 30.0
ALWAYS = 0.99                # how often a period follows an abbreviation
MODEL_ENTRIES = 5000         # words of a list that expressions hold; more stay a table
BLANKS = " \n\t\r"
BLANK_RUN = f"[{BLANKS}]+"
CANDIDATE = f"([.!?][{BLANKS}]+)"   # where a sentence may end
MARK = "\u0001"
EDGES = r"^[^\p{L}]+|[^\p{L}]+$"


class SentenceModel(NamedTuple):
    """Words as a tuple, or as a table of distinct ``word`` where they are many."""
    abbreviations: tuple[str, ...] | DataFrame   # lower-cased, without the final period
    starters: tuple[str, ...] | DataFrame        # lower-cased


def _type(token: Column) -> Column:
    """Lower-cased token without its final period."""
    return F.regexp_replace(F.lower(token), r"\.$", "")


def _starter(token: Column) -> Column:
    """Lower-cased token without anything but letters at its ends."""
    return F.regexp_replace(F.lower(token), EDGES, "")


def _likelihood(k: Column, n: Column, p: Column) -> Column:
    """Log of p^k (1-p)^(n-k), terms with a zero count left out."""
    return (F.when(k > 0, k * F.ln(p)).otherwise(F.lit(0.0)) + F.when(n - k > 0, (n - k) * F.ln(1 - p)).otherwise(F.lit(0.0)))


def token_pairs(df: DataFrame, text: str) -> DataFrame:
    """``token, following`` for every blank-separated token (following: null at the end of a text)."""
    tokens = F.filter(F.split(F.col(text), BLANK_RUN), lambda t: t != "")
    t = df.select(tokens.alias("t"))
    pairs = F.arrays_zip(F.col("t").alias("token"), F.slice("t", F.lit(2), F.greatest(F.size("t") - 1, F.lit(0))).alias("following"))
    return t.select(F.inline(pairs))


def abbreviation_scores(pairs: DataFrame) -> DataFrame:
    """``type, with_period, without, score`` of every word type that stands before a period."""
    ends = F.col("token").endswith(".")
    tokens = pairs.groupBy("token").agg(F.count(F.lit(1)).alias("n"))   # patterns run on distinct tokens only
    counts = stage_table(tokens.select(_type(F.col("token")).alias("type"), "n", F.when(ends, F.col("n")).otherwise(0).alias("e")).groupBy("type")
                         .agg(F.sum("e").alias("with_period"), F.sum(F.col("n") - F.col("e")).alias("without")), "period-counts")
    total = counts.agg(F.sum("with_period").alias("p"), F.sum(F.col("with_period") + F.col("without")).alias("n"))
    share = F.col("p") / F.col("n")
    k, n = F.col("with_period"), F.col("with_period") + F.col("without")
    gain = 2 * (_likelihood(k, n, F.lit(ALWAYS)) - _likelihood(k, n, share))
    size = F.length(F.replace("type", F.lit("."), F.lit("")))
    score = gain * F.exp(-size) * (F.length("type") - size + 1) * F.pow(size.cast("double"), -F.col("without").cast("double"))
    return (counts.filter((F.col("with_period") > 0) & F.col("type").rlike(r"\p{L}")).join(F.broadcast(total))  # one row of totals
            .select("type", "with_period", "without", F.when(share < 1, score).otherwise(F.lit(0.0)).alias("score")))


def _single_letter(token: Column) -> Column:
    return token.rlike(r"^\p{L}\.$")


def starter_scores(pairs: DataFrame, abbreviations: tuple[str, ...] | DataFrame) -> DataFrame:
    """``word, after_end, n, score`` of every word that follows a clear sentence end."""
    # the token's last two characters decide what its whole text would: blanks, line ends among them, are not in tokens
    token, pairs = F.col("token"), pairs.filter("following IS NOT NULL")
    loud, dotted = F.right("token", F.lit(2)).rlike(r"[!?]$"), token.endswith(".") & ~_single_letter(token)
    many = isinstance(abbreviations, DataFrame)
    clear = loud if many else loud | (dotted & ~_type(token).isin(list(abbreviations)))
    followers = (pairs.select("following", clear.cast("long").alias("c"))
                 .groupBy("following").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")))   # patterns run on distinct followers only
    if many:
        ends = stage_table(pairs.filter(dotted).groupBy(_type(token).alias("word"), "following").agg(F.count(F.lit(1)).alias("c")), "period-followers")
        ends = lookup_join(ends, abbreviations.select("word", F.lit(True).alias("known")), "word", "left").filter("known IS NULL")
        followers = followers.unionByName(ends.select("following", "c", F.lit(0).alias("n")))
    rows = stage_table(followers.select(_starter(F.col("following")).alias("word"), "c", "n")
                       .groupBy("word").agg(F.sum("c").alias("after_end"), F.sum("n").alias("n")), "start-counts")
    total = rows.agg(F.sum("after_end").alias("ends"), F.sum("n").alias("all"))
    k, m, n, everything = F.col("after_end"), F.col("ends"), F.col("n"), F.col("all")
    even, after, apart = n / everything, k / m, (n - k) / (everything - m)
    score = 2 * (_likelihood(k, m, after) + _likelihood(n - k, everything - m, apart) - _likelihood(k, m, even) - _likelihood(n - k, everything - m, even))
    return (rows.filter((F.col("after_end") > 0) & (F.col("word") != "")).join(F.broadcast(total))  # one row of totals
            .select("word", "after_end", "n", F.when((everything > m) & (after > apart), score).otherwise(F.lit(0.0)).alias("score")))


def learn_sentences(df: DataFrame, text: str = "text", entries: int = MODEL_ENTRIES) -> SentenceModel:
    """Model from all texts of ``df``: every word of either kind that reaches its score; more than ``entries`` words stay a table."""
    pairs = token_pairs(df, text)

    def found(scores: DataFrame, word: str, least: float) -> tuple[str, ...] | DataFrame:
        words = stage_table(scores.filter(F.col("score") >= least).select(F.col(word).alias("word"), "score"), "model-words")
        if words.count() > entries:
            return words.select("word")
        return tuple(r["word"] for r in words.orderBy(F.desc("score"), "word").collect())

    abbreviations = found(abbreviation_scores(pairs), "type", ABBREVIATION_SCORE)
    return SentenceModel(abbreviations, found(starter_scores(pairs, abbreviations), "word", STARTER_SCORE))


def _pieces(text: Column) -> Column:
    return F.split(F.regexp_replace(text, CANDIDATE, f"$1{MARK}"), MARK)


def _with_next(pieces: Column) -> Column:
    """Structs ``p, f``: each piece beside the next one (the last: null), so that pieces are not looked up again for every piece."""
    after = F.concat(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
    return F.arrays_zip(pieces.alias("p"), after.alias("f"))


def _last(piece: Column) -> Column:
    return F.regexp_extract(F.rtrim(F.regexp_replace(piece, BLANK_RUN + "$", "")), f"([^{BLANKS}]+)$", 1)


def _first(piece: Column) -> Column:
    return F.regexp_extract(piece, f"^[{BLANKS}]*([^{BLANKS}]+)", 1)


def _split(text: Column, is_abbreviation, is_starter) -> Column:
    """The sentences of a text; both functions tell of a column of words whether they are of that kind."""
    def ended(piece: Column, following: Column) -> Column:
        last, word = _last(piece), _first(following)
        unsure = last.endswith(".") & (is_abbreviation(_type(last)) | _single_letter(last))
        starts = word.rlike(r"^[^\p{L}]*\p{Lu}") & is_starter(_starter(word))
        return F.when(unsure & ~starts, F.lit("")).otherwise(F.lit(MARK))

    marked = F.transform(_with_next(_pieces(text)),
                         lambda x: F.concat(x["p"], F.when(x["f"].isNull(), F.lit("")).otherwise(ended(x["p"], x["f"]))))
    return F.transform(F.split(F.array_join(marked, ""), MARK), lambda s: F.regexp_replace(s, BLANK_RUN + "$", ""))


def sentences(text: str | Column, model: SentenceModel) -> Column:
    """ARRAY of a text's sentences, without the blanks between them; null for a null text.

    A candidate end is ``.``, ``!`` or ``?`` before blanks.  A period after an abbreviation or a
    single letter ends a sentence only before a capitalised sentence starter.  For a model of
    two tuples; ``split_sentences`` takes any.
    """
    return _split(F.col(text) if isinstance(text, str) else text, lambda w: w.isin(list(model.abbreviations)), lambda w: w.isin(list(model.starters)))


def split_sentences(df: DataFrame, text: str, model: SentenceModel, out: str = "sentences") -> DataFrame:
    """``df`` with the column ``out``, the ``sentences`` of its texts, however many words the model has.

    Where a list is a table, the distinct words of each text that may stand in it (last words
    before candidate ends, first words after them) are joined with it, and what is found is joined back to the text.
    """
    if not any(isinstance(words, DataFrame) for words in model):
        return df.withColumn(out, sentences(text, model))
    free = "_" * (1 + max(map(len, [*df.columns, out])))  # longer than any column's name, so it is none of them
    rows = stage_table(df.withColumn(free, F.monotonically_increasing_id()), "texts")
    ends = F.filter(_with_next(_pieces(F.col(text))), lambda x: x["f"].isNotNull() & _last(x["p"]).endswith("."))
    parts = {"a": lambda x: _type(_last(x["p"])), "s": lambda x: _starter(_first(x["f"]))}
    known, data = {}, rows
    for (kind, word), words in zip(parts.items(), model):
        if not isinstance(words, DataFrame):
            known[kind] = lambda w, words=words: w.isin(list(words))
            continue
        met = stage_table(rows.select(free, F.explode(F.array_distinct(F.transform(ends, word))).alias("word")), "end-words")
        held = lookup_join(met, words, "word").groupBy(free).agg(F.collect_list("word").alias(free + kind))   # one text's words
        data = data.join(held, free, "left")
        known[kind] = lambda w, c=free + kind: F.array_contains(F.coalesce(F.col(c), F.array().cast("array<string>")), w)
    return data.withColumn(out, _split(F.col(text), known["a"], known["s"])).select(*df.columns, out)
