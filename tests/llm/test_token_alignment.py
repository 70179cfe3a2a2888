import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kestrel.llm import token_alignment as ta
from kestrel.llm.common import read_table
from tests.conftest import SF

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
with open(PATHS[0], "rb") as a, open(PATHS[1], "rb") as b:
    ENCODER = ta.Encoder(a.read(), b.read())
FIRST, SECOND = ENCODER.sides
TEXTS = st.text(max_size=80) | st.text(alphabet="ab 1.é▁\n\t한<>s/", max_size=60)


def library_ids(text):
    return A.encode(" " + text, add_special_tokens=False).ids, B.encode(text, num_threads=1)


def plain_groups(text):
    """Groups of (a ids, b ids) between common ends, from the libraries' ids and sets of offsets."""
    if not text:
        return []
    a, b = library_ids(text)
    want = (" " + text).encode()
    words = [FIRST.bytes[i] for i in a], [SECOND.bytes[i] for i in b]
    if any(b"".join(w) != want for w in words):
        return []
    ends = [np.cumsum([len(x) for x in w]).tolist() for w in words]
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(cut) + 1, ends[1].index(cut) + 1
        groups.append((a[i:p], b[j:q]))
        i, j = p, q
    return groups


def brute(texts):
    """The query's columns by plain loops over all links."""
    grouped = [plain_groups(t) for t in texts]
    pairs = [Counter((x, y) for xs, ys in g for x in xs for y in ys) for g in grouped]
    count = Counter(p for c in pairs for p in c)
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for g, c in zip(grouped, pairs):
        said = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                    sum(n for (x, y), n in c.items() if count[x, y] == top[x]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return out


@pytest.fixture(scope="module")
def shared(spark):
    return ta.tokenizers(spark, *PATHS)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS.filter(len), max_size=4))
def test_ids_equal_the_libraries(texts):
    for text, ids in zip(texts, ENCODER.encode(texts)):
        want = library_ids(text)
        same = all(ENCODER.bytes_of(k, x) == (" " + text).encode() for k, x in enumerate(want))
        assert [x.tolist() for x in ids] == list(want) if same else ids is None


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(ta, "MEMO", 2)
    texts = ["one two three four", "one two ▁ three", "w" * 500 + " two one", "▁" * 500]
    first = ENCODER.encode(texts)
    again = ENCODER.encode(texts)
    assert [x and [y.tolist() for y in x] for x in first] == [x and [y.tolist() for y in x] for x in again]
    assert first[1] is None and first[3] is None and len(ENCODER.memo[0]) < 8 and not any(len(w) > 64 for w in ENCODER.unlike | set(ENCODER.memo[1]))


def test_every_character_has_the_same_ids_in_both_libraries():
    for start in range(0, 0x110000, 0x800):
        probe = "".join(f" a{chr(c)}a1{chr(c)}1 {chr(c)}!{chr(c)}  {chr(c)}" for c in range(start, start + 0x800) if not 0xD800 <= c < 0xE000)
        if probe:
            assert FIRST.fast.encode_ordinary(probe) == A.encode(probe, add_special_tokens=False).ids, hex(start)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.lists(st.integers(1, 4), min_size=1, max_size=30)), min_size=1, max_size=5))
def test_cuts_are_all_common_ends(texts):
    sides = []
    for xs, ys in texts:  # both sides of a text are as long as each other
        gap = sum(xs) - sum(ys)
        sides.append((xs + [-gap] * (gap < 0), ys + [gap] * (gap > 0)))
    a, b = (np.cumsum(np.concatenate([s[k] for s in sides])) for k in (0, 1))
    stops = [np.cumsum([len(s[k]) for s in sides]) for k in (0, 1)]
    cut_a, cut_b = ta.shared_cuts(a, b, *stops)
    common = np.intersect1d(a, b)
    assert np.array_equal(a[cut_a - 1], common) and np.array_equal(b[cut_b - 1], common)


def test_long_stretches_without_a_cut():
    rng = random.Random(3)
    a = np.r_[np.arange(1, 200_000, 2), 200_000, 200_000 + np.cumsum([rng.randint(1, 3) for _ in range(1000)])]
    b = np.unique(np.r_[np.arange(2, 200_001, 2), 200_000 + np.cumsum([rng.randint(1, 3) for _ in range(1000)])])
    end = max(a[-1], b[-1])
    a, b = np.unique(np.r_[a, end]), np.unique(np.r_[b, end])
    cut_a, cut_b = ta.shared_cuts(a, b, np.array([len(a)]), np.array([len(b)]))
    assert np.array_equal(a[cut_a - 1], np.intersect1d(a, b)) and np.array_equal(b[cut_b - 1], np.intersect1d(a, b))


ROWS = ["Hello world, naïve café", None, "", " ", "a", "</s>[INST] <|endoftext|> <s>", "x▁y is not x y", "한국어 텍스트 and more", "\x00\t\x85 　 \n\n  z",
        "Hello world, naïve café", "=" * 400 + "-" * 300 + "한" * 50, "z" * 3000 + " end ", "ab" * 700]


@pytest.mark.parametrize("frequent", [0, 3, 1 << 18])
def test_documents_against_plain_loops(spark, shared, frequent):
    docs = spark.createDataFrame([(i if i % 5 else 7, t, "p", 1) for i, t in enumerate(ROWS)], "doc_id long, text string, pair string, row long")
    got = sorted(tuple(r) for r in ta.link_statistics(docs, shared, frequent=frequent).collect())
    assert got == sorted((i if i % 5 else 7, *x) for i, x in enumerate(brute(ROWS)))


def test_wide_groups_count_equal_ids(monkeypatch):
    texts = [(t or "").encode() for t in ROWS]
    whole = ta.align_texts(texts, ENCODER)
    monkeypatch.setattr(ta, "WIDE_GROUP", 0)
    counted = ta.align_texts(texts, ENCODER)
    assert all(np.array_equal(whole[k], counted[k]) for k in whole)
    assert whole["n_links"].sum() == whole["times"].sum()


def test_given_documents_and_empty_table(spark, shared):
    docs = read_table(spark, SF, "documents")
    rows = docs.orderBy("doc_id").collect()
    got = [tuple(r) for r in ta.link_statistics(docs, shared, frequent=1000).orderBy("doc_id").collect()]
    assert got == [(r["doc_id"], *x) for r, x in zip(rows, brute([r["text"] for r in rows]))]
    assert ta.link_statistics(docs.filter(F.lit(False)), shared).count() == 0


def test_null_ids_are_documents_of_their_own(spark, shared):
    docs = spark.createDataFrame([(None, "some words"), (None, "some words"), (1, "some")], "doc_id long, text string")
    got = sorted((tuple(r) for r in ta.link_statistics(docs, shared).collect()), key=str)
    assert got == sorted([(i, *x) for i, x in zip((None, None, 1), brute(["some words", "some words", "some"]))], key=str)
