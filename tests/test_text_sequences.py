import math
from collections import Counter

from pyspark.sql import functions as F

from kestrel.functions.porter import porter_stem
from kestrel.operators import normalise as nz
from kestrel.operators import sequences as sq
from kestrel.operators import text as tx


def test_sentences_and_tokens(spark):
    df = spark.createDataFrame([("Hi there. How are you?  Fine!",), ("",)], "t string")
    r = df.select(tx.sentences("t").alias("s"), tx.word_tokens("t").alias("w")).collect()
    assert r[0]["s"] == ["Hi there.", "How are you?", "Fine!"]
    assert r[0]["w"] == ["Hi", "there", ".", "How", "are", "you", "?", "Fine", "!"]
    assert r[1]["w"] == []


def test_tfidf_matches_brute_force(spark):
    docs = {1: "the cat sat on the mat", 2: "the dog sat", 3: "a cat and a dog"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    long = tx.explode_tokens(df, "doc_id", tx.terms("text"))
    got = {(r["doc_id"], r["term"]): r["weight"] for r in tx.tfidf_long(long, "doc_id", 3).collect()}
    toks = {d: [w for w in t.split() if len(w) >= 2] for d, t in docs.items()}
    dfreq = Counter(w for ws in toks.values() for w in set(ws))
    for d, ws in toks.items():
        c = Counter(ws)
        raw = {w: n * (math.log(4 / (1 + dfreq[w])) + 1) for w, n in c.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        for w, v in raw.items():
            assert abs(got[(d, w)] - v / norm) < 1e-12


def test_term_counts_df_limit(spark):
    df = spark.createDataFrame([(i, "common rare%d" % i) for i in range(5)], "doc_id long, text string")
    long = tx.explode_tokens(df, "doc_id", tx.terms("text"))
    terms = {r["term"] for r in tx.term_counts(long, "doc_id", max_df=3).collect()}
    assert "common" not in terms and len(terms) == 5


def test_stop_words_are_the_published_list():
    sw = tx.ENGLISH_STOP_WORDS
    assert len(sw) > 150 and "the" in sw


def test_porter_published_examples():
    cases = {"caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
             "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
             "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
             "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
             "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
             "rational": "ration", "valenci": "valenc", "digitizer": "digit", "conformabli": "conform",
             "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog",
             "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
             "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
             "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
             "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope",
             "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
             "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
             "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
             "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ",
             "angulariti": "angular", "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
             "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll"}
    bad = {w: (porter_stem(w), s) for w, s in cases.items() if porter_stem(w) != s}
    assert not bad


def test_stemming_lemmas_and_tagging(spark):
    df = spark.createDataFrame([(1, "connect connected connecting connection connect")], "doc_id long, text string")
    long = tx.explode_tokens(df, "doc_id", tx.terms("text"))
    stems = {r["term"]: r["stem"] for r in nz.stem_tokens(long).collect()}
    assert set(stems.values()) == {"connect"}
    lem = {r["term"]: r["lemma"] for r in nz.lemmatise(long, nz.lemma_table_from_stems(long)).collect()}
    assert set(lem.values()) == {"connect"}
    tagged = spark.createDataFrame([("python", "nn"), ("run", "vb"), ("run", "vb"), ("run", "nn")], "word string, tag string")
    model = nz.train_unigram_tagger(tagged)
    q = spark.createDataFrame([(1, 0, "Run"), (1, 1, "zebra")], "doc_id long, pos int, term string")
    got = {r["term"]: r["tag"] for r in nz.tag_tokens(q, model).collect()}
    assert got == {"Run": "vb", "zebra": "nn"}
    d = nz.describe_tags(spark.createDataFrame([("vb",)], "tag string")).first()
    assert d["description"] == "verb, base form"


def test_windows_vocab_padding(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c"), (3, "")], "doc_id long, text string")
    w = sq.ngram_windows(df, "doc_id", F.split("text", " "), 5).collect()
    assert len(w) == 2 and w[0]["context"] == "a b c d e" and w[0]["next"] == "f"
    s = df.select(sq.sliding_windows(F.split("text", " "), 6).alias("w")).collect()
    assert [len(r["w"]) for r in s] == [2, 0, 0]
    vocab = sq.frequency_vocabulary(spark.createDataFrame([(1, "b a b c")], "doc_id long, text string"),
                                    "doc_id", sq.keras_words("text"))
    assert {r["word"]: r["id"] for r in vocab.collect()} == {"b": 1, "a": 2, "c": 3}
    v = sq.sorted_vocabulary(spark.createDataFrame([("x",), ("a",)], "word string"), extra=[sq.START, sq.END])
    ids = {r["word"]: r["id"] for r in v.collect()}
    assert ids["START_"] < ids["_END"] < ids["a"] < ids["x"] and min(ids.values()) == 1
    p = sq.encode_and_pad(spark.createDataFrame([(1, "a x")], "k long, t string"), "k", F.split("t", " "), v, 4)
    assert p.first()["ids"] == [ids["a"], ids["x"], 0, 0]


def test_prompt_reply_pairs(spark):
    c = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"),
                               (1, 3, "user", "q2"), (2, 0, "user", "q3")], "conv_id long, turn long, role string, text string")
    got = [(r["input"], r["output"]) for r in sq.prompt_reply_pairs(c).collect()]
    assert got == [("q1", "a1")]


def test_replies_are_retrieved_for_every_conversation_from_all(spark, tmp_path):
    from kestrel.plans import REGISTRY
    turns = [(c, 2 * p + t, ("user", "assistant")[t], f"w{c % 7} turn{p} same" if t == 0 else f"reply {c} {p}") for c in range(0, 230, 5) for p in range(2) for t in (0, 1)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {x["prompt"]: (x["nearest_prompt"], x["score"]) for x in REGISTRY["retrieved_replies"][0](spark, str(tmp_path)).collect()}
    assert sorted(got) == [c * 1048576 + t for c in range(0, 230, 5) for t in (0, 2)]
    for prompt, (nearest, score) in got.items():   # the smallest other prompt of the same words
        c, t = divmod(prompt, 1048576)
        assert nearest == min(x * 1048576 + t for x in range(0, 230, 5) if x % 7 == c % 7 and x != c) and score == 1.0
