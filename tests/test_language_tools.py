import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import lookup as lk
from kestrel.operators import normalise as nz
from kestrel.operators import retrieval as rt
from kestrel.operators import sentences as st
from kestrel.operators import sequences as sq
from kestrel.operators import tagger as tg


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_equals_a_plain_join(spark, how):
    r = random.Random(4)
    rows = [(i, r.choice(["hot"] * 9 + [f"k{r.randrange(400)}", None])) for i in range(4000)] + [(5000, "absent"), (5001, None)]
    df = spark.createDataFrame(rows, "i long, k string")
    table = spark.createDataFrame([(f"k{j}", j) for j in range(0, 400, 2)] + [("hot", -1), (None, 7)], "k string, v long")
    got = sorted((tuple(x) for x in lk.lookup_join(df, table, "k", how, least=50).select("i", "k", "v").collect()), key=str)
    assert got == sorted((tuple(x) for x in df.join(table, "k", how).select("i", "k", "v").collect()), key=str)
    assert lk.lookup_join(df.limit(0), table, "k", how).count() == 0


def test_one_key_in_most_rows_stays_where_it_is(spark):
    """Rows per task after the join: the frequent key's rows are spread as the input is."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(0, 40_000, 1, 8).select("id", F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
        table = df.select("k").distinct().withColumn("v", F.length("k"))
        sizes = lambda d: sorted(r["count"] for r in d.groupBy(F.spark_partition_id().alias("p")).count().collect())
        plain, split = sizes(df.join(table, "k")), sizes(lk.lookup_join(df, table, "k"))
        assert sum(plain) == sum(split) == 40_000
        assert plain[-1] > 30_000 and split[-1] <= 40_000 / 8
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_encode_and_decode_round_trip_without_padding_rows(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c", "new"]), (3, []), (4, None)], "k long, t array<string>")
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "word string, id long")
    ids = sq.encode_and_pad(df, "k", "t", vocab, 5)
    assert dict(tuple(r) for r in ids.collect()) == {1: [1, 2, 1, 0, 0], 2: [3, 0, 0, 0, 0], 3: [0] * 5, 4: [0] * 5}
    back = sq.decode_ids(ids, "k", "ids", vocab)
    assert dict(tuple(r) for r in back.collect()) == {1: ["a", "b", "a"], 2: ["c"], 3: [], 4: []}


def chatter(n, seed):
    """Texts of random sentences; their words stand anywhere, ``Dr.`` and ``Mr.`` before names."""
    r = random.Random(seed)
    plain = "noon late left today shut once began first wet home so end street train shop room meeting rain spoke".split()
    out = []
    for _ in range(n):
        sents = []
        for _ in range(r.randint(1, 5)):
            words = [r.choice(["The", "He"])] + r.choices(plain, k=r.randint(3, 9))
            if r.random() < 0.4:
                words.insert(r.randint(1, len(words) - 1), r.choice(["Dr.", "Mr."]) + " " + r.choice(["Adams", "Brown", "Jones"]))
            sents.append(" ".join(words) + r.choice("..!"))
        out.append(" ".join(sents))
    return out


def test_learnt_sentence_ends_survive_abbreviations(spark):
    from kestrel.operators.text import sentences as by_pattern
    docs = spark.createDataFrame(list(enumerate(chatter(400, 3))), "doc long, text string")
    model = st.learn_sentences(docs)
    assert set(model.abbreviations) == {"dr", "mr"} and set(model.starters) == {"the", "he"}
    probe = ["Yesterday Dr. Adams spoke. The room was full.  He left early! Mr. Jones stayed.", None, "", "no end", "He met J. Smith. He ran.", "She saw the Dr. The man left."]
    out = [r.s for r in spark.createDataFrame([(i, t) for i, t in enumerate(probe)], "i long, text string").select("i", st.sentences("text", model).alias("s"),
                                                                                                                   by_pattern("text").alias("p")).orderBy("i").collect()]
    assert out[0] == ["Yesterday Dr. Adams spoke.", "The room was full.", "He left early!", "Mr. Jones stayed."]
    assert out[1] is None and out[2] == [""] and out[3] == ["no end"]
    assert out[4] == ["He met J. Smith.", "He ran."] and out[5] == ["She saw the Dr.", "The man left."]
    plain = spark.createDataFrame([(probe[0],)], "text string").select(by_pattern("text").alias("p")).first().p
    assert "Yesterday Dr." in plain  # where the pattern fails
    assert st.learn_sentences(docs.limit(0)) == st.SentenceModel((), ())


def test_words_above_a_models_entries_decide_too(spark):
    learnt = spark.createDataFrame(list(enumerate(chatter(400, 3))), "doc long, text string")
    rows = [(i, t) for i, t in enumerate([*chatter(40, 4), "Yesterday Dr. Adams spoke. The room was full.  He left early! Mr. Jones stayed.", "She saw the Dr. The man left.",
                                          "She saw the Mr. He left.", "He met J. Smith. He ran.", "no end", "", None])]
    docs = spark.createDataFrame([*rows, (7, "Dr. Adams left. He ran."), (None, "Mr. Brown left. The end.")], "doc long, text string")
    want = sorted((tuple(r) for r in st.split_sentences(docs, "text", st.learn_sentences(learnt), "s").collect()), key=str)
    whole = st.learn_sentences(learnt, entries=1)     # both lists have two words
    assert sorted(r.word for r in whole.abbreviations.collect()) == ["dr", "mr"] and sorted(r.word for r in whole.starters.collect()) == ["he", "the"]
    mixed = [st.SentenceModel(whole.abbreviations, ("the", "he")), st.SentenceModel(("dr", "mr"), whole.starters)]
    for model in (whole, *mixed):
        assert sorted((tuple(r) for r in st.split_sentences(docs, "text", model, "s").collect()), key=str) == want


def test_viterbi_is_the_best_of_all_paths():
    r = np.random.default_rng(2)
    for _ in range(60):
        k, n = int(r.integers(1, 5)), int(r.integers(0, 6))
        e, t = np.log(r.dirichlet(np.ones(k), size=max(n, 1)))[:n], np.log(r.dirichlet(np.ones(k), size=k + 1))
        e[r.random(e.shape) < 0.2] = -np.inf
        total = lambda path: sum(e[i, s] + t[0 if i == 0 else path[i - 1] + 1, s] for i, s in enumerate(path))
        best = max((total(p) for p in itertools.product(range(k), repeat=n)), default=0)
        got = tg.viterbi(e, t)
        assert len(got) == n and (n == 0 or math.isclose(total(got), best) or total(got) == best)


def tagged_corpus(n, seed):
    """``can`` is a noun after an article and a verb after a pronoun; ``run`` likewise."""
    r = random.Random(seed)
    rows = []
    for s in range(n):
        words = []
        for _ in range(r.randint(1, 4)):
            if r.random() < 0.5:
                words += [(r.choice(["the", "a"]), "dt"), (r.choice(["can", "run", "dog"]), "nn")]
            else:
                words += [(r.choice(["we", "they"]), "prp"), (r.choice(["can", "run", "go"]), "vb")]
        rows += [(s, i, w, t) for i, (w, t) in enumerate(words)]
    return rows


def test_context_beats_the_most_frequent_tag_on_held_out_sentences(spark):
    train = spark.createDataFrame(tagged_corpus(200, 1), "s long, pos int, word string, tag string")
    test = spark.createDataFrame(tagged_corpus(80, 2) + [(900, 0, None, "nn"), (901, 0, "Unseen", "nn")], "s long, pos int, word string, tag string")
    model = tg.train_tagger(train, ["s"])
    assert model.tags == ("dt", "nn", "prp", "vb") and np.allclose(np.exp(model.transitions).sum(axis=1), 1)
    got = {(r["s"], r["pos"]): r["tag"] for r in tg.tag_sentences(test, ["s"], model).collect()}
    plain = {(r["s"], r["pos"]): r["tag"] for r in nz.tag_tokens(test, nz.train_unigram_tagger(train), "word").collect()}
    true = {(s, i): t for s, i, _, t in tagged_corpus(80, 2)}
    right = sum(got[k] == t for k, t in true.items())
    assert len(got) == len(true) + 2 and right == len(true) > sum(plain[k] == t for k, t in true.items())


def test_tags_of_short_sentences_equal_brute_force(spark):
    train = spark.createDataFrame(tagged_corpus(60, 5), "s long, pos int, word string, tag string")
    model = tg.train_tagger(train, ["s"])
    logs = {r["word"]: r["logs"] for r in model.words.collect()}
    sents = {0: ["we", "can", "the", "run"], 1: ["Can"], 2: ["run", "unknown", "dog"], 3: ["the", "go"]}
    test = spark.createDataFrame([(s, i, w) for s, ws in sents.items() for i, w in enumerate(ws)], "s long, pos int, word string")
    got = {s: [r["tag"] for r in sorted(rows, key=lambda r: r["pos"])] for s, rows in itertools.groupby(sorted(tg.tag_sentences(test, ["s"], model).collect()), key=lambda r: r["s"])}
    for s, words in sents.items():
        def total(path):
            out = 0.0
            for i, (w, k) in enumerate(zip(words, path)):
                e = logs.get(w.lower())
                p = model.unknown[k] if e is None else e[k] if e[k] is not None else -math.inf
                out += p + model.transitions[0 if i == 0 else path[i - 1] + 1, k]
            return out
        best = max(itertools.product(range(len(model.tags)), repeat=len(words)), key=total)
        assert math.isclose(total([model.tags.index(t) for t in got[s]]), total(best))


def test_dictionary_lemmas(spark):
    words = spark.createDataFrame([(w,) for w in "box church city make play run big hope hop bus lens man".split()], "word string")
    terms = "boxes churches cities making played plays bigger hoping was lens xyzing men buses Runs women".split()
    got = dict(tuple(r) for r in nz.dictionary_lemmas(spark.createDataFrame([(t,) for t in terms + [None, "boxes"]], "term string"), words).collect())
    assert got == {"boxes": "box", "churches": "church", "cities": "city", "making": "make", "played": "play", "plays": "play", "bigger": "bigger", "hoping": "hope",
                   "was": "be", "lens": "lens", "xyzing": "xyzing", "men": "man", "buses": "bus", "runs": "run", "women": "woman"}


def test_smoothed_probabilities_add_up_to_one(spark):
    r = random.Random(9)
    docs = spark.createDataFrame([(" ".join(r.choices("abcdefg", weights=[9, 5, 4, 3, 2, 1, 1], k=40)),) for _ in range(6)], "text string")
    tables = sq.kneser_ney(docs, F.split("text", " "))
    vocabulary = [x["next"] for x in tables[0].collect()]
    best = sq.smoothed_next(tables, top=len(vocabulary)).collect()
    sums, counts = {}, {}
    for x in best:
        sums[x["context"]] = sums.get(x["context"], 0) + x["p"]
        counts[x["context"]] = counts.get(x["context"], 0) + 1
    assert set(counts.values()) == {len(vocabulary)} and all(math.isclose(s, 1) for s in sums.values())
    top = {(x["context"], x["rank"]): (x["next"], x["p"]) for x in sq.smoothed_next(tables, top=2).collect()}
    for x in best:
        if x["rank"] <= 2:
            assert top[x["context"], x["rank"]] == (x["next"], x["p"])


@pytest.mark.parametrize("others_only", [True, False])
def test_nearest_equals_comparing_all(spark, others_only):
    r = random.Random(12)
    vocab, rows = [f"w{k}" for k in range(60)], []
    for i in range(150):
        words = r.choices(vocab, weights=[1 / (k + 1) for k in range(60)], k=r.randint(1, 12))
        if i % 10 == 9:
            words = texts[-1]  # an equal text
        texts = rows and [x[1] for x in rows] or []
        texts.append(words)
        rows.append((i, words))
    rows.append((500, ["alone"]))

    def unit(words):
        n = {w: words.count(w) * (1 + vocab.index(w) if w in vocab else 1) for w in words}
        size = math.sqrt(sum(x * x for x in n.values()))
        return {w: x / size for w, x in n.items()}

    vectors = {i: unit(w) for i, w in rows}
    long = spark.createDataFrame([(i, t, w) for i, v in vectors.items() for t, w in v.items()], "id long, term string, weight double")
    asked = long.filter("id % 3 = 0 OR id = 500")
    got = {x["id"]: (x["nearest_id"], x["score"], x["n_scored"]) for x in rt.nearest(asked, long, "id", "id", others_only=others_only).collect()}
    want, pairs = {}, 0
    for i, v in vectors.items():
        if i % 3 and i != 500:
            continue
        scored = [(-round(sum(x * vectors[j].get(t, 0) for t, x in v.items()), 9), j) for j in vectors if not (others_only and i == j) and set(v) & set(vectors[j])]
        pairs += len(scored)
        if scored:
            want[i] = min(scored)
    assert set(got) == set(want) and all(got[i][0] == j and abs(got[i][1] + s) < 2e-9 for i, (s, j) in want.items())
    assert sum(n for _, _, n in got.values()) < pairs / 2


def test_nearest_takes_queries_in_parts(spark, monkeypatch):
    r = random.Random(5)
    vectors = {i: {w: 1 / math.sqrt(5) for w in r.sample([f"w{k}" for k in range(30)], 5)} for i in range(80)}
    long = spark.createDataFrame([(i, t, w) for i, v in vectors.items() for t, w in v.items()], "id long, term string, weight double")
    names, stage = [], rt.stage_table
    monkeypatch.setattr(rt, "stage_table", lambda df, name: names.append(name) or stage(df, name))
    whole = sorted(map(tuple, rt.nearest(long, long, "id", "id", others_only=True).collect()))
    assert names.count("open-pairs") == 1
    assert sorted(map(tuple, rt.nearest(long, long, "id", "id", others_only=True, part_rows=1500).collect())) == whole and len(whole) == 80
    assert names.count("open-pairs") > 2
