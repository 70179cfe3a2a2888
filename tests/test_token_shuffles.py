"""Token jobs shuffle texts or counts, not token rows again and again."""

import re
from collections import Counter

import pytest

from kestrel.functions.porter import porter_stem
from kestrel.operators import normalise as nz
from kestrel.operators import sentences as st
from kestrel.operators import text as tx
from kestrel.plans import text as plans
from kestrel.session import stage_table

ROWS = [(1, "Running runs run the walker walks"), (1, "run walking, ran the the"), (2, "a b"), (3, None), (4, ""), (None, "null ids nulled"),
        (None, "null id"), (5, "caresses ponies cats the the")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def texts(spark):
    return stage_table(spark.createDataFrame(ROWS, "doc_id long, text string"), "token-test")


def words_of_ids():
    out = {}
    for i, text in ROWS:
        for w in (text or "").lower().replace(",", " ").split():
            if len(w) > 1:
                out.setdefault(i, Counter())[w] += 1
    return out


def test_stems_need_no_shuffle(spark, texts):
    long = tx.distinct_tokens(texts, "doc_id", tx.terms("text", unicode=False))
    assert "Exchange" not in plan(nz.stem_tokens(long)) and "Join" not in plan(nz.stem_tokens(long))


def test_stem_counts(spark, texts, monkeypatch):
    monkeypatch.setattr(plans, "load", lambda *a: texts)
    out = plans.document_stem_counts(spark, "")
    assert plan(out).count("Exchange hashpartitioning") == 1
    got = {r["doc_id"]: (r["n_terms"], r["n_stems"]) for r in out.collect()}
    assert got == {i: (len(c), len({porter_stem(w) for w in c})) for i, c in words_of_ids().items()}


def test_lemma_counts(spark, texts, monkeypatch):
    monkeypatch.setattr(plans, "load", lambda *a: texts)
    out = plans.document_lemma_counts(spark, "")
    assert plan(out).count("Exchange hashpartitioning(doc_id") == 1
    of_ids, total, best = words_of_ids(), Counter(), {}
    for c in of_ids.values():
        total.update(c)
    for w in sorted(total, key=lambda w: (-total[w], len(w), w)):
        best.setdefault(porter_stem(w), w)
    got = {r["doc_id"]: (r["n_lemmas"], r["n_tokens"]) for r in out.collect()}
    assert got == {i: (len({best[porter_stem(w)] for w in c}), sum(c.values())) for i, c in of_ids.items()}


def test_tfidf_of_repeated_ids(spark, texts, monkeypatch):
    """Rows of one id are one document; texts are brought together by id, and their tokens counted there."""
    monkeypatch.setattr(plans, "load", lambda *a: texts)
    seen = []
    real = tx.tfidf_long
    monkeypatch.setattr(tx, "tfidf_long", lambda long, *a, **k: (seen.append(plan(long.groupBy("doc_id", "term").count())), real(long, *a, **k))[1])
    got = {(r["doc_id"], r["term"]) for r in plans.document_tfidf(spark, "").collect() if r["doc_id"] is not None}
    assert re.findall(r"Exchange hashpartitioning\(([a-z_]+)#\d+L?, \d+\)", seen[0]) == ["doc_id"] and seen[0].count("Exchange") == 1
    assert got == {(i, w) for i, c in words_of_ids().items() for w in c if i is not None}


def test_sentence_statistics_run_patterns_on_distinct_tokens(spark, monkeypatch):
    rows = ["He met Dr. Smith. The end! The day? It ended. The", "Dr. Dr. who?! The  end. ", None, "", "one"]
    df = stage_table(spark.createDataFrame([(t,) for t in rows], "text string"), "sentence-test")
    pairs = st.token_pairs(df, "text")
    tokens = [(t or "").split() for t in rows]
    assert sorted((r["token"], r["following"] or "") for r in pairs.collect()) == sorted(p for t in tokens for p in zip(t, [*t[1:], ""]))
    plans_seen = []
    monkeypatch.setattr(st, "stage_table", lambda d, name: (plans_seen.append(plan(d)), stage_table(d, name))[1])
    st.abbreviation_scores(pairs).collect()
    got = {r["word"]: (r["after_end"], r["n"]) for r in st.starter_scores(pairs, ("dr",)).collect()}
    assert all(p.count("Exchange hashpartitioning") == 2 for p in plans_seen)     # tokens are combined before any pattern
    follow = [(p, f) for t in tokens for p, f in zip(t, t[1:])]
    ends = lambda t: t[-1] in "!?" or t[-1] == "." and t.lower() != "dr."
    words = {f.lower().strip(".!?") for _, f in follow}
    want = {w: (sum(ends(p) for p, f in follow if f.lower().strip(".!?") == w), sum(f.lower().strip(".!?") == w for _, f in follow)) for w in words}
    assert got == {w: x for w, x in want.items() if x[0]}
