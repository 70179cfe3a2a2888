"""Token normalisers and taggers as vocabulary jobs and lookup joins.

Stemming is a pandas UDF that remembers the words it has met, so each task stems a
distinct token once, where it stands: no token row is shuffled for its stem.  Lemmas are
lookup tables joined on the token, frequent tokens split off.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from kestrel.functions.porter import porter_stem
from kestrel.operators.lookup import lookup_join
from kestrel.session import stage_table

DEFAULT_TAG = "nn"

# Penn Treebank part-of-speech tags and their descriptions.
PENN_TAGS = (
    ("cc", "conjunction, coordinating"), ("cd", "numeral, cardinal"), ("dt", "determiner"),
    ("ex", "existential there"), ("fw", "foreign word"), ("in", "preposition or conjunction, subordinating"),
    ("jj", "adjective or numeral, ordinal"), ("jjr", "adjective, comparative"), ("jjs", "adjective, superlative"),
    ("ls", "list item marker"), ("md", "modal auxiliary"), ("nn", "noun, common, singular or mass"),
    ("nnp", "noun, proper, singular"), ("nnps", "noun, proper, plural"), ("nns", "noun, common, plural"),
    ("pdt", "pre-determiner"), ("pos", "genitive marker"), ("prp", "pronoun, personal"),
    ("prp$", "pronoun, possessive"), ("rb", "adverb"), ("rbr", "adverb, comparative"), ("rbs", "adverb, superlative"),
    ("rp", "particle"), ("sym", "symbol"), ("to", "\"to\" as preposition or infinitive marker"),
    ("uh", "interjection"), ("vb", "verb, base form"), ("vbd", "verb, past tense"),
    ("vbg", "verb, present participle or gerund"), ("vbn", "verb, past participle"),
    ("vbp", "verb, present tense, not 3rd person singular"), ("vbz", "verb, present tense, 3rd person singular"),
    ("wdt", "wh-determiner"), ("wp", "wh-pronoun"), ("wp$", "wh-pronoun, possessive"), ("wrb", "wh-adverb"),
)


class _Stems(dict):
    """Word to its stem; emptied when it grows past its bound."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        stem = self[word] = porter_stem(word)
        return stem


@pandas_udf(T.StringType())
def _stem_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    stems = _Stems()
    for words in batches:
        yield pd.Series([stems[w] for w in words], dtype=object)


def stem_vocabulary(long: DataFrame, term: str = "term") -> DataFrame:
    """``(term, stem)`` for every distinct term (the stemmer runs once per distinct term)."""
    return long.select(term).distinct().withColumn("stem", _stem_udf(F.col(term)))


def stem_tokens(long: DataFrame, term: str = "term", out: str = "stem") -> DataFrame:
    """Add the Porter stem of every token occurrence (one pass, no shuffle; null stays null)."""
    return long.withColumn(out, _stem_udf(F.col(term)))


def lemma_table_from_stems(long: DataFrame, term: str = "term", n: str | None = None) -> DataFrame:
    """A corpus-derived lemma table: every term maps to the most frequent surface form that
    shares its stem (ties → shortest, then smallest).  ``long`` has a row per token, or counts in ``n``."""
    counts = long.groupBy(term).agg((F.sum(n) if n else F.count(F.lit(1))).alias("n"))
    st = stage_table(stem_tokens(counts, term, "stem"), "stems")   # one row per distinct term
    rep = st.groupBy("stem").agg(F.min_by(term, F.struct((-F.col("n")).alias("a"), F.length(term).alias("b"),
                                                         F.col(term).alias("c"))).alias("lemma"))
    return st.join(rep, "stem").select(term, "lemma")


# Suffix and what replaces it, by part of speech, in the order they are tried.
DETACHMENTS = (
    ("noun", "s", ""), ("noun", "ses", "s"), ("noun", "xes", "x"), ("noun", "zes", "z"), ("noun", "ches", "ch"), ("noun", "shes", "sh"),
    ("noun", "men", "man"), ("noun", "ies", "y"),
    ("verb", "s", ""), ("verb", "ies", "y"), ("verb", "es", "e"), ("verb", "es", ""), ("verb", "ed", "e"), ("verb", "ed", ""),
    ("verb", "ing", "e"), ("verb", "ing", ""),
    ("adjective", "er", ""), ("adjective", "est", ""), ("adjective", "er", "e"), ("adjective", "est", "e"),
)
# Irregular forms and their base forms.
IRREGULAR = (
    ("am", "be"), ("are", "be"), ("is", "be"), ("was", "be"), ("were", "be"), ("been", "be"), ("has", "have"), ("had", "have"), ("did", "do"), ("does", "do"),
    ("done", "do"), ("went", "go"), ("gone", "go"), ("goes", "go"), ("said", "say"), ("made", "make"), ("took", "take"), ("taken", "take"), ("came", "come"),
    ("saw", "see"), ("seen", "see"), ("knew", "know"), ("known", "know"), ("got", "get"), ("gave", "give"), ("given", "give"), ("found", "find"), ("told", "tell"),
    ("felt", "feel"), ("left", "leave"), ("kept", "keep"), ("held", "hold"), ("brought", "bring"), ("began", "begin"), ("begun", "begin"), ("wrote", "write"),
    ("written", "write"), ("stood", "stand"), ("heard", "hear"), ("ran", "run"), ("met", "meet"), ("paid", "pay"), ("sat", "sit"), ("spoke", "speak"),
    ("spoken", "speak"), ("grew", "grow"), ("grown", "grow"), ("lost", "lose"), ("fell", "fall"), ("fallen", "fall"), ("sent", "send"), ("built", "build"),
    ("understood", "understand"), ("drew", "draw"), ("drawn", "draw"), ("broke", "break"), ("broken", "break"), ("spent", "spend"), ("rose", "rise"),
    ("risen", "rise"), ("drove", "drive"), ("driven", "drive"), ("bought", "buy"), ("wore", "wear"), ("worn", "wear"), ("chose", "choose"), ("chosen", "choose"),
    ("men", "man"), ("women", "woman"), ("children", "child"), ("feet", "foot"), ("teeth", "tooth"), ("mice", "mouse"), ("geese", "goose"), ("people", "person"),
    ("better", "good"), ("best", "good"), ("worse", "bad"), ("worst", "bad"),
)


def dictionary_lemmas(terms: DataFrame, words: DataFrame, term: str = "term", word: str = "word", exceptions=IRREGULAR, rules=DETACHMENTS) -> DataFrame:
    """``(term, lemma)`` for the distinct lower-cased ``terms``: the base form that the word list ``words`` has.

    In order of preference: the exception list's form; the term itself if it is a word; the form
    of the first rule of ``rules`` (suffix detachment) that gives a word; the term itself.
    Candidates are kept only if the list holds them (semi join), so the list may have any size.
    """
    distinct = stage_table(terms.select(F.lower(term).alias("term")).dropna().distinct(), "terms")
    forms = [F.struct(F.lit(0).alias("rank"), F.col("term").alias("form"))]
    for rank, (_, suffix, base) in enumerate(rules, 1):
        cut = F.concat(F.substr("term", F.lit(1), F.length("term") - len(suffix)), F.lit(base))
        forms.append(F.when(F.col("term").endswith(suffix) & (F.length("term") > len(suffix)), F.struct(F.lit(rank).alias("rank"), cut.alias("form"))))
    candidates = distinct.select("term", F.inline(F.filter(F.array(*forms), lambda f: f.isNotNull())))
    held = candidates.join(words.select(F.lower(word).alias("form")).distinct(), "form", "left_semi")
    found = held.groupBy("term").agg(F.min_by("form", "rank").alias("held"))
    listed = F.broadcast(terms.sparkSession.createDataFrame(list(exceptions) or [("", "")], "term string, listed string").filter("term <> ''"))  # a fixed list
    return (distinct.join(found, "term", "left").join(listed, "term", "left")
            .select("term", F.coalesce("listed", "held", "term").alias("lemma")))


def lemmatise(long: DataFrame, lemmas: DataFrame, term: str = "term", out: str = "lemma") -> DataFrame:
    """Dictionary base form by lookup join; unknown tokens keep their own form."""
    j = lookup_join(long, lemmas.select(F.col(lemmas.columns[0]).alias(term), F.col(lemmas.columns[1]).alias("__lemma")), term, "left")
    return j.withColumn(out, F.coalesce(F.col("__lemma"), F.col(term))).drop("__lemma")


def train_unigram_tagger(tagged: DataFrame, word: str = "word", tag: str = "tag", n: str | None = None) -> DataFrame:
    """Most frequent tag per lower-cased word from a tagged corpus ``(word, tag)``, one row per
    token or with counts in ``n`` (ties → smallest tag)."""
    c = tagged.select(F.lower(word).alias("word"), F.col(tag).alias("tag"), (F.col(n) if n else F.lit(1)).alias("n")) \
              .groupBy("word", "tag").agg(F.sum("n").alias("n"))
    return c.groupBy("word").agg(F.min_by("tag", F.struct((-F.col("n")).alias("a"), F.col("tag"))).alias("tag"))


def tag_tokens(long: DataFrame, model: DataFrame, term: str = "term", default: str = DEFAULT_TAG) -> DataFrame:
    """Tag every token with the model's tag for its lower-cased form, ``default`` if unknown."""
    t = long.withColumn("__w", F.lower(F.col(term)))
    j = t.join(model.select(F.col("word").alias("__w"), F.col("tag").alias("__t")), "__w", "left")
    return j.withColumn("tag", F.coalesce(F.col("__t"), F.lit(default))).drop("__w", "__t")


def tag_descriptions(spark) -> DataFrame:
    return spark.createDataFrame(list(PENN_TAGS), "tag string, description string")


def describe_tags(df: DataFrame, tag: str = "tag") -> DataFrame:
    """Attach the tag description (``upenn_tagset`` lookup) — a fixed 36-row table."""
    d = tag_descriptions(df.sparkSession).withColumnRenamed("tag", tag)
    return df.join(F.broadcast(d), tag, "left")
