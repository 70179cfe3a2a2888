"""Text operators: sentence and word tokens, vocabularies, term counts, TF-IDF.

Token streams are exploded to a long ``(doc_id, pos, term)`` frame; per-document
counts group on ``(doc_id, term)`` (bounded by document length) and document
frequencies group on ``term`` with map-side combine, so a term present in every
document is pre-aggregated before it is shuffled.  Joining the per-term table
back is an equi-join that AQE broadcasts when small and splits when skewed.
Sparse weights stay long (never one column per term).
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, IDF, Tokenizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.stopwords import ENGLISH_STOP_WORDS
from kestrel.operators.lookup import lookup_join
from kestrel.session import stage_table

# Token patterns.
SENTENCE_END = r"([.!?])[ \n\t\r]+"          # a sentence ends at . ! ? followed by blanks
SEP = "\u0001"
ASCII_WORD_OR_PUNCT = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]"
UNICODE_WORD_OR_PUNCT = r"(?U)\w+|[^\w\s]"
ASCII_TERM = r"[a-z0-9_]{2,}"                # words of at least two word characters (lower-cased text)
UNICODE_TERM = r"(?U)\w\w+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentences(text) -> Column:
    """Rule-based sentence split → ARRAY<STRING> (abbreviations are not modelled)."""
    return F.split(F.regexp_replace(_c(text), SENTENCE_END, "$1" + SEP), SEP)


def word_tokens(text, unicode: bool = True) -> Column:
    """Words and punctuation marks as separate tokens."""
    return F.regexp_extract_all(_c(text), F.lit(UNICODE_WORD_OR_PUNCT if unicode else ASCII_WORD_OR_PUNCT), 0)


def terms(text, unicode: bool = True) -> Column:
    """Lower-cased terms of at least two word characters (vectoriser token rule)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(UNICODE_TERM if unicode else ASCII_TERM), 0)


def whitespace_lower_tokens(text) -> Column:
    """Lower-case, split on single whitespace characters (keeps empty tokens between blanks)."""
    return F.split(F.lower(_c(text)), r"\s")


def remove_stop_words(tokens, stop_words=None) -> Column:
    """Drop stop words from a token array (case-insensitive on lower-cased tokens)."""
    sw = list(stop_words if stop_words is not None else ENGLISH_STOP_WORDS)
    return F.filter(_c(tokens), lambda t: ~F.lower(t).isin(sw))


def explode_tokens(df: DataFrame, doc: str, tokens, term: str = "term") -> DataFrame:
    """``(doc, pos, term)`` rows, one per token."""
    return df.select(doc, F.posexplode(_c(tokens)).alias("pos", term))


def distinct_tokens(df: DataFrame, doc: str, tokens, term: str = "term") -> DataFrame:
    """``(doc, term)`` rows, one per distinct token of a row's text."""
    return explode_tokens(df, doc, F.array_distinct(_c(tokens)), term).select(doc, term)


def vocabulary(long: DataFrame, term: str = "term", top: int | None = None) -> DataFrame:
    """Corpus frequency per term, most frequent first (ties by term); ``top`` keeps the
    ``top`` most frequent (a distributed top-k, no global sort)."""
    v = long.groupBy(term).agg(F.count(F.lit(1)).alias("n"))
    if top is not None:
        v = v.orderBy(F.desc("n"), F.asc(term)).limit(top)
    return v


def term_counts(long: DataFrame, doc: str, term: str = "term", min_df: int = 1, max_df: int | float | None = None,
                max_features: int | None = None, n_docs: int | None = None) -> DataFrame:
    """Long count matrix ``(doc, term, n)`` with document-frequency limits and a vocabulary
    cap by corpus frequency.  An integer ``max_df`` is an absolute document count
    (terms in more documents are dropped); a float is a share of ``n_docs``."""
    dt = stage_table(long.groupBy(doc, term).agg(F.count(F.lit(1)).alias("n")), "term-counts")
    stats = dt.groupBy(term).agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("tf"))
    keep = stats.filter(F.col("df") >= min_df)
    if max_df is not None:
        lim = max_df if isinstance(max_df, int) else max_df * n_docs
        keep = keep.filter(F.col("df") <= F.lit(lim))
    if max_features is not None:
        keep = keep.orderBy(F.desc("tf"), F.asc(term)).limit(max_features)
    return dt.join(keep.select(term), term, "left_semi").select(doc, term, "n")


def tfidf_long(long: DataFrame, doc: str, n_docs: int, term: str = "term", smooth: bool = True,
               sublinear: bool = False, normalise: bool = True) -> DataFrame:
    """Vectoriser-style TF-IDF in long form: ``idf = ln((1+N)/(1+df)) + 1`` (smooth),
    weight = count · idf, then L2-normalised per document → ``(doc, term, weight)``."""
    # staged: the texts are read and tokenised once for the document frequencies and the weights
    dt = stage_table(long.groupBy(doc, term).agg(F.count(F.lit(1)).alias("n")), "term-counts")
    df_ = dt.groupBy(term).agg(F.count(F.lit(1)).alias("df"))
    if smooth:
        idf = F.ln((F.lit(1.0 + n_docs)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    else:
        idf = F.ln(F.lit(float(n_docs)) / F.col("df")) + F.lit(1.0)
    tf = (F.ln(F.col("n")) + 1) if sublinear else F.col("n").cast("double")
    w = lookup_join(dt, df_.select(term, idf.alias("idf")), term).select(doc, term, (tf * F.col("idf")).alias("w"))
    if not normalise:
        return w.withColumnRenamed("w", "weight")
    # the norm is a window over one document's terms (bounded by its length): one shuffle
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc)))
    return w.select(doc, term, (F.col("w") / norm).alias("weight"))


# MLlib stages (vector form) for model pipelines
def tokenizer(inp: str, out: str = "words") -> Tokenizer:
    return Tokenizer(inputCol=inp, outputCol=out)


def hashing_tf(inp: str, out: str = "tf", num_features: int = 20) -> HashingTF:
    return HashingTF(inputCol=inp, outputCol=out, numFeatures=num_features)


def idf(inp: str = "tf", out: str = "features") -> IDF:
    return IDF(inputCol=inp, outputCol=out)
