"""Queries for the text operators (whole documents, every row)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kestrel.operators import sentences as st
from kestrel.operators import text as tx
from kestrel.operators import features as fe
from kestrel.plans.registry import register
from kestrel.session import stage_table
from kestrel.sources.tables import load

R = 6


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


@register("document_sentences", sql="""
WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])[ \\n\\t\\r]+', '\\1' || chr(1), 'g'), chr(1)) AS ss FROM documents)
SELECT doc_id, CAST(len(ss) AS INTEGER) AS n_sentences, CAST(list_max(list_transform(ss, lambda x: length(x))) AS INTEGER) AS longest
FROM s
""")
def document_sentences(spark, sf):
    """Sentences per document."""
    d = load(spark, sf, "documents").select("doc_id", tx.sentences("text").alias("ss"))
    return d.select("doc_id", F.size("ss").alias("n_sentences"),
                    F.array_max(F.transform("ss", lambda s: F.length(s))).alias("longest"))


# Statistics and decisions of the learnt splitter, from the same counts.
LEARNT_SQL = r"""
WITH toks AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \n\t\r]+'), lambda t: t <> '') AS t FROM documents),
pairs AS (SELECT unnest(t) AS token, unnest(list_append(t[2:], NULL)) AS following FROM toks WHERE len(t) > 0),
counts AS (SELECT regexp_replace(lower(token), '\.$', '') AS type, sum((suffix(token, '.'))::INTEGER) AS k, count(*) AS n FROM pairs GROUP BY 1),
total AS (SELECT sum(k) / sum(n) AS p FROM counts),
abbr AS (SELECT type, k, n, 2 * ((CASE WHEN k > 0 THEN k * ln(0.99) ELSE 0 END + CASE WHEN n > k THEN (n - k) * ln(1 - 0.99) ELSE 0 END)
                                 - (CASE WHEN k > 0 THEN k * ln(p) ELSE 0 END + CASE WHEN n > k THEN (n - k) * ln(1 - p) ELSE 0 END))
              * exp(-length(replace(type, '.', ''))) * (length(type) - length(replace(type, '.', '')) + 1)
              * pow(length(replace(type, '.', '')), k - n) AS score
         FROM counts, total WHERE k > 0 AND regexp_matches(type, '\pL')),
kept AS (SELECT type, k, n, score FROM abbr WHERE score >= 0.3 ORDER BY score DESC, type LIMIT 5000),
clear AS (SELECT regexp_replace(lower(following), '^[^\pL]+|[^\pL]+$', '', 'g') AS word,
                 regexp_matches(token, '[!?]$') OR (suffix(token, '.') AND regexp_replace(lower(token), '\.$', '') NOT IN (SELECT type FROM kept)
                                                    AND NOT regexp_matches(token, '^\pL\.$')) AS c FROM pairs WHERE following IS NOT NULL),
words AS (SELECT word, sum(c::INTEGER) AS k, count(*) AS n FROM clear GROUP BY 1),
ends AS (SELECT sum(k) AS m, sum(n) AS a FROM words),
gain AS (SELECT word, k, n, k / m AS p1, (n - k) / (a - m) AS p2, 2 * (
    k * ln(k / m) + CASE WHEN m > k THEN (m - k) * ln(1 - k / m) ELSE 0 END
    + CASE WHEN n > k THEN (n - k) * ln((n - k) / (a - m)) ELSE 0 END + CASE WHEN a - m > n - k THEN (a - m - n + k) * ln(1 - (n - k) / (a - m)) ELSE 0 END
    - k * ln(n / a) - CASE WHEN m > k THEN (m - k) * ln(1 - n / a) ELSE 0 END
    - CASE WHEN n > k THEN (n - k) * ln(n / a) ELSE 0 END - CASE WHEN a - m > n - k THEN (a - m - n + k) * ln(1 - n / a) ELSE 0 END) AS score
    FROM words, ends WHERE k > 0 AND word <> ''),
starters AS (SELECT word, score FROM gain WHERE p1 > p2 AND score >= 30 ORDER BY score DESC, word LIMIT 5000)
"""


def _stand_in_abbreviations(d):
    """The given texts with an abbreviation after every word ``the``, ``der`` or ``le`` (they hold none of their own)."""
    text = F.col("text")
    for word in ("the", "der", "le"):
        text = F.replace(text, F.lit(f" {word} "), F.lit(f" {word} abb. "))
    return d.select("doc_id", text.alias("text"))


STAND_IN_SQL = """documents AS (SELECT doc_id,
    replace(replace(replace(text, ' the ', ' the abb. '), ' der ', ' der abb. '), ' le ', ' le abb. ') AS text FROM main.documents),"""


@register("sentence_abbreviations", sql=LEARNT_SQL.replace("WITH toks", "WITH " + STAND_IN_SQL + " toks") + """
SELECT type, CAST(k AS BIGINT) AS with_period, CAST(n - k AS BIGINT) AS without, round(score, 6) AS score FROM kept
""")
def sentence_abbreviations(spark, sf):
    """Abbreviations learnt from the texts, with their counts and scores."""
    pairs = st.token_pairs(_stand_in_abbreviations(load(spark, sf, "documents")), "text")
    scores = st.abbreviation_scores(pairs).filter(F.col("score") >= st.ABBREVIATION_SCORE).orderBy(F.desc("score"), "type").limit(st.MODEL_ENTRIES)
    return scores.withColumn("score", F.round("score", R))


# Every word that reaches its score decides, however many there are.
WHOLE_SQL = LEARNT_SQL.replace(" ORDER BY score DESC, type LIMIT 5000", "").replace(" ORDER BY score DESC, word LIMIT 5000", "")


@register("document_learnt_sentences", sql=WHOLE_SQL.replace("WITH toks", "WITH " + STAND_IN_SQL + " toks") + r""",
pieces AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?][ \n\t\r]+)', '\1' || chr(1), 'g'), chr(1)) AS ps FROM documents),
each AS (SELECT doc_id, len(ps) AS total, unnest(range(1, len(ps) + 1)) AS i, unnest(ps) AS piece, unnest(list_append(ps[2:], NULL)) AS nxt FROM pieces),
seen AS (SELECT *, regexp_extract(regexp_replace(piece, '[ \n\t\r]+$', ''), '([^ \n\t\r]+)$', 1) AS last, regexp_extract(nxt, '^[ \n\t\r]*([^ \n\t\r]+)', 1) AS word FROM each),
judged AS (SELECT doc_id, i, piece, CASE WHEN nxt IS NULL THEN '' WHEN suffix(last, '.')
        AND (regexp_replace(lower(last), '\.$', '') IN (SELECT type FROM kept) OR regexp_matches(last, '^\pL\.$'))
        AND NOT (regexp_matches(word, '^[^\pL]*\p{Lu}') AND regexp_replace(lower(word), '^[^\pL]+|[^\pL]+$', '', 'g') IN (SELECT word FROM starters)) THEN '' ELSE chr(1) END AS mark FROM seen),
joined AS (SELECT doc_id, string_split(string_agg(piece || mark, '' ORDER BY i), chr(1)) AS ss FROM judged GROUP BY 1),
clean AS (SELECT doc_id, list_transform(ss, lambda s: regexp_replace(s, '[ \n\t\r]+$', '')) AS ss FROM joined)
SELECT doc_id, CAST(len(ss) AS INTEGER) AS n_sentences, CAST(list_max(list_transform(ss, lambda x: length(x))) AS INTEGER) AS longest FROM clean
""")
def document_learnt_sentences(spark, sf):
    """Sentences per document where abbreviations and sentence starters learnt from all texts decide."""
    d = _stand_in_abbreviations(load(spark, sf, "documents"))
    ss = st.split_sentences(d, "text", st.learn_sentences(d), "ss")
    return ss.select("doc_id", F.size("ss").alias("n_sentences"), F.array_max(F.transform("ss", lambda s: F.length(s))).alias("longest"))


@register("document_word_tokens", sql="""
WITH t AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]') AS tok FROM documents)
SELECT doc_id, CAST(len(tok) AS INTEGER) AS n_tokens, CAST(len(list_distinct(tok)) AS INTEGER) AS n_distinct,
       CAST(coalesce(list_max(list_transform(tok, lambda x: length(x))), 0) AS INTEGER) AS longest_token
FROM t
""")
def document_word_tokens(spark, sf):
    """Word and punctuation tokens per document, distinct tokens, longest token."""
    d = load(spark, sf, "documents").select("doc_id", tx.word_tokens("text", unicode=False).alias("tok"))
    return d.select("doc_id", F.size("tok").alias("n_tokens"), F.size(F.array_distinct("tok")).alias("n_distinct"),
                    F.coalesce(F.array_max(F.transform("tok", lambda s: F.length(s))), F.lit(0)).alias("longest_token"))


@register("corpus_vocabulary_top", sql="""
WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9_]{2,}')) AS term FROM documents)
SELECT term, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY 1 ORDER BY n DESC, term LIMIT 1000
""", headline=True)
def corpus_vocabulary_top(spark, sf):
    """The 1000 most frequent terms of the corpus (vocabulary cap, O5, A10)."""
    d = load(spark, sf, "documents")
    long = tx.explode_tokens(d, "doc_id", tx.terms("text", unicode=False))
    return tx.vocabulary(long, top=1000)


@register("document_term_counts", sql="""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]{2,}')) AS term FROM documents),
dt AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY 1, 2),
st AS (SELECT term, count(*) AS df, sum(n) AS tf FROM dt GROUP BY 1),
keep AS (SELECT term FROM st WHERE df >= 1 AND df <= 3 ORDER BY tf DESC, term LIMIT 1000)
SELECT doc_id, term, CAST(n AS BIGINT) AS n FROM dt WHERE term IN (SELECT term FROM keep)
""")
def document_term_counts(spark, sf):
    """Long count matrix with df limits (min 1, max 3 documents) and a 1000-term cap."""
    d = load(spark, sf, "documents")
    long = tx.explode_tokens(d, "doc_id", tx.terms("text", unicode=False))
    return tx.term_counts(long, "doc_id", min_df=1, max_df=3, max_features=1000)


@register("document_tfidf", sql="""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]{2,}')) AS term FROM documents),
dt AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM dt GROUP BY 1),
nd AS (SELECT count(*) AS n_docs FROM documents),
w AS (SELECT doc_id, dt.term, n * (ln((1.0 + n_docs) / (1.0 + df)) + 1.0) AS w FROM dt JOIN df ON dt.term = df.term, nd),
nr AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1)
SELECT w.doc_id, term, round(w / norm, 6) AS weight FROM w JOIN nr ON w.doc_id = nr.doc_id
""", headline=True)
def document_tfidf(spark, sf):
    """Smoothed TF-IDF with +1 idf and L2 row norm, long form."""
    d = load(spark, sf, "documents")
    n_docs = d.count()
    # the texts are shuffled, not their tokens: a document's are counted where they are
    long = tx.explode_tokens(d.select("doc_id", "text").repartition("doc_id"), "doc_id", tx.terms("text", unicode=False))
    return tx.tfidf_long(long, "doc_id", n_docs).withColumn("weight", F.round("weight", R))


def stopword_filtered_text(spark, sf):
    """Lower-case whitespace tokens, stop words removed, re-joined to one string."""
    d = load(spark, sf, "documents")
    toks = tx.remove_stop_words(tx.whitespace_lower_tokens("text"))
    return d.select("doc_id", F.size(toks).alias("n_kept"), F.length(F.array_join(toks, " ")).alias("joined_len"))


def _stopword_sql() -> str:
    return f"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\\s'), lambda x: x NOT IN ({_sql_list(tx.ENGLISH_STOP_WORDS)})) AS k
           FROM documents)
SELECT doc_id, CAST(len(k) AS INTEGER) AS n_kept, CAST(length(array_to_string(k, ' ')) AS INTEGER) AS joined_len FROM t
"""


@register("hashed_tfidf_norms")
def hashed_tfidf_norms(spark, sf):
    """Tokenizer → HashingTF(20 buckets) → IDF, fitted on the corpus; per-document L1 norm of
    the weights (N3, N8, N9).  Murmur3 bucket ids have no SQL twin: rows-only check."""
    d = load(spark, sf, "documents").select("doc_id", "text")
    p = Pipeline(stages=[tx.tokenizer("text", "words"), tx.hashing_tf("words", "tf", 20), tx.idf("tf", "features")])
    out = p.fit(d).transform(d)
    a = vector_to_array("features")
    return out.select("doc_id", F.round(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.abs(x)), R).alias("l1"))


register("stopword_filtered_text", sql=_stopword_sql())(stopword_filtered_text)


# ---------------------------------------------------------------- normalisers
from kestrel.operators import normalise as nz  # noqa: E402


# Surface rules that tag the training tokens (first match), and the tag of all others.
TAG_RULES = (("[0-9].*", "cd"), (".*ly", "rb"), (".*ing", "vbg"), (".*ed", "vbd"), ("[A-Z].*", "nnp"))


def _tag_sql() -> str:
    rules = " ".join(f"WHEN regexp_full_match(word, '{p}') THEN '{t}'" for p, t in TAG_RULES)
    names = " ".join(f"WHEN '{t}' THEN '{d.replace(chr(39), chr(39) * 2)}'" for t, d in nz.PENN_TAGS)
    return f"""
WITH t AS (SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS word FROM documents),
g AS (SELECT word, CASE {rules} ELSE '{nz.DEFAULT_TAG}' END AS tag FROM t),
c AS (SELECT lower(word) AS w, tag, count(*) AS n FROM g GROUP BY 1, 2),
m AS (SELECT w, tag FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY n DESC, tag) AS rk FROM c) WHERE rk = 1)
SELECT m.tag, CASE m.tag {names} END AS description, CAST(count(*) AS BIGINT) AS n FROM t JOIN m ON lower(t.word) = m.w GROUP BY 1
"""


@register("document_tag_counts", sql=_tag_sql())
def document_tag_counts(spark, sf):
    """Tokens tagged by surface rules train a most-frequent-tag tagger, which tags every token;
    tokens per tag with the tag's description (N12, N13)."""
    d = load(spark, sf, "documents")
    tokens = stage_table(d.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9]+"), 0)).alias("term"))
                         .groupBy("term").agg(F.count(F.lit(1)).alias("n")), "token-counts")
    tag = F.lit(nz.DEFAULT_TAG)
    for pattern, name in reversed(TAG_RULES):
        tag = F.when(F.col("term").rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(tag)
    model = nz.train_unigram_tagger(tokens.withColumn("tag", tag), "term", "tag", "n")
    counts = nz.tag_tokens(tokens, model).groupBy("tag").agg(F.sum("n").alias("n"))
    return nz.describe_tags(counts).select("tag", "description", "n")


@register("document_stem_counts")
def document_stem_counts(spark, sf):
    """Porter stems of every token, computed once per distinct term of a task;
    distinct terms and stems per document (N10).  Python stemmer: rows-only check."""
    d = load(spark, sf, "documents")
    s = nz.stem_tokens(tx.distinct_tokens(d, "doc_id", tx.terms("text", unicode=False)))
    # one shuffle: the steps below find a document's terms together (a stem depends on its term alone)
    per_stem = s.repartition("doc_id").groupBy("doc_id", "stem", "term").agg(F.lit(1).alias("one")).groupBy("doc_id", "stem").agg(F.count(F.lit(1)).alias("n"))
    return per_stem.groupBy("doc_id").agg(F.sum("n").alias("n_terms"), F.count(F.lit(1)).alias("n_stems"))


@register("document_lemma_counts")
def document_lemma_counts(spark, sf):
    """Lemmatisation by lookup join against a lemma table derived from the corpus (each
    term → most frequent form of its stem class); distinct lemmas per document (N11)."""
    d = load(spark, sf, "documents")
    # the texts are shuffled, not their tokens: a document's are counted where they are
    counts = stage_table(tx.explode_tokens(d.select("doc_id", "text").repartition("doc_id"), "doc_id", tx.terms("text", unicode=False))
                         .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    lem = nz.lemmatise(counts, nz.lemma_table_from_stems(counts, n="n"))
    per_lemma = lem.select("doc_id", "lemma", "n").repartition("doc_id").groupBy("doc_id", "lemma").agg(F.sum("n").alias("n"))
    return per_lemma.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lemmas"), F.sum("n").alias("n_tokens"))


# ---------------------------------------------------------------- tagger with context, dictionary lemmas
from kestrel.operators import tagger as tg  # noqa: E402


def _tagged_tokens(spark, sf):
    """Stand-in for a tagged corpus: the words of each document's sentences, tagged by surface rules in their original case."""
    d = load(spark, sf, "documents").select("doc_id", F.posexplode(tx.sentences("text")).alias("sentence", "s"))
    tag = F.lit(nz.DEFAULT_TAG)
    for pattern, name in reversed(TAG_RULES):
        tag = F.when(F.col("word").rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(tag)
    words = F.regexp_extract_all("s", F.lit("[A-Za-z0-9]+"), 0)
    return d.select("doc_id", "sentence", F.posexplode(words).alias("pos", "word")).withColumn("tag", tag)


@register("document_context_tags")
def document_context_tags(spark, sf):
    """Words (case folded) of held-out documents tagged by the hidden Markov model that the other
    documents trained, and by the most frequent tag of each word: tokens and right ones per tag (N12)."""
    every = stage_table(fe.split_by_hash(_tagged_tokens(spark, sf), "doc_id", 0.25, seed=21), "tagged")
    train, test, sentence = every.filter("NOT is_test"), every.filter("is_test").drop("is_test"), ["doc_id", "sentence"]
    found = tg.tag_sentences(test, sentence, tg.train_tagger(train, sentence)).withColumnRenamed("tag", "context_tag").drop("word")
    plain = nz.tag_tokens(test, nz.train_unigram_tagger(train), "word").withColumnRenamed("tag", "plain_tag").drop("word")
    both = test.withColumnRenamed("tag", "true_tag").join(found, [*sentence, "pos"]).join(plain.select(*sentence, "pos", "plain_tag"), [*sentence, "pos"])
    return both.groupBy(F.col("true_tag").alias("tag")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("context_tag") == F.col("true_tag")).cast("long")).alias("right_by_context"),
        F.sum((F.col("plain_tag") == F.col("true_tag")).cast("long")).alias("right_by_word"))


def _lemma_sql() -> str:
    forms = ", ".join(f"({rank}, '{suffix}', '{base}')" for rank, (_, suffix, base) in enumerate(nz.DETACHMENTS, 1))
    listed = ", ".join(f"('{a}', '{b}')" for a, b in nz.IRREGULAR)
    return f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]{{2,}}')) AS term FROM documents),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM t GROUP BY 1),
words AS (SELECT term AS form FROM df WHERE df >= 3),
rules(rank, suffix, base) AS (VALUES {forms}),
listed(term, lemma) AS (VALUES {listed}),
c AS (SELECT term, 0 AS rank, term AS form FROM df UNION ALL
      SELECT term, rank, substr(term, 1, length(term) - length(suffix)) || base FROM df, rules WHERE suffix(term, suffix) AND length(term) > length(suffix)),
held AS (SELECT term, arg_min(form, rank) AS form FROM c WHERE form IN (SELECT form FROM words) GROUP BY 1)
SELECT df.term, coalesce(l.lemma, h.form, df.term) AS lemma FROM df LEFT JOIN held h ON h.term = df.term LEFT JOIN listed l ON l.term = df.term
""".replace("suffix(term, suffix)", "ends_with(term, suffix)")


@register("document_dictionary_lemmas", sql=_lemma_sql())
def document_dictionary_lemmas(spark, sf):
    """Base form of every term by exceptions and suffix rules; the word list is the terms of three documents or more."""
    long = load(spark, sf, "documents").select("doc_id", F.explode(F.array_distinct(tx.terms("text", unicode=False))).alias("term"))
    words = long.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter("df >= 3").select(F.col("term").alias("word"))
    return nz.dictionary_lemmas(long, words)
