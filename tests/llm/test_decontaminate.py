import hashlib
import random
import re

import pytest

from kestrel.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def want(docs, bench):
    windows = {}
    for item, text in bench:
        w = words(text)
        size = min(13, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for i, text in docs:
        w, hit, items = words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                found = windows.get(tuple(w[k:k + size]))
                if found:
                    hit.update(range(k, k + size))
                    items |= found
        items = sorted(str(x) for x in items if x is not None)
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def data(seed):
    r = random.Random(seed)
    vocab = [f"W{k}é" if k % 7 == 0 else f"w{k}" for k in range(300)]
    bench = [(k, " ".join(r.choices(vocab, k=r.choice([1, 4, 12, 13, 14, 30])))) for k in range(25)]
    bench += [(90, bench[0][1]), (91, None), (92, ""), (93, "-- !"), (None, " ".join(vocab[40:60]))]
    docs = []
    for k in range(200):
        w = r.choices(vocab, k=r.choice([0, 3, 40, 300, 3000]))
        for _ in range(r.choice([0, 1, 3])):
            piece = (r.choice(bench)[1] or "").split()
            at, cut = r.randrange(len(w) + 1), r.choice([0, 0, 1])
            w[at:at] = piece[cut:]
        docs.append((k, r.choice([" ", ", ", "\n"]).join(w)))
    return docs + [(500, None), (501, ""), (502, "x" * 10 ** 6), (503, docs[0][1])], bench


@pytest.mark.parametrize("max_windows", [200_000, 60])
def test_equal_brute_force_in_one_block_and_in_several(spark, max_windows):
    docs, bench = data(3)
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_hit int")
    b = spark.createDataFrame(bench, "item_id long, text string")
    assert sorted(tuple(r) for r in dc.verdicts(dc.scan(d, b, max_windows=max_windows)).collect()) == want(docs, bench)
    kept = dc.decontaminate(d, b, max_windows=max_windows)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in want(docs, bench) if not r[-1]]


@pytest.mark.parametrize("max_windows", [200_000, 60])
def test_removed_spans_shorten_only_hit_texts(spark, max_windows):
    docs, bench = data(4)
    bench = [x for x in bench if len(words(x[1])) >= 12]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    clean = {r.doc_id: r.text for r in dc.decontaminate(d, b, mode="spans", max_windows=max_windows).collect()}
    before = {r[0]: r for r in want(docs, bench)}
    for i, text in docs:
        if before[i][2] == 0:
            assert clean[i] == text
        else:
            assert len(words(clean[i])) >= before[i][1] - before[i][2] - 2 * before[i][3]  # words joined at a cut count once
            assert len(clean[i]) < len(text)


def test_empty_tables_and_modes(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in dc.verdicts(dc.scan(d, b)).collect()] == [0]
    assert dc.scan(d.limit(0), b).count() == 0 and dc.decontaminate(d, b).count() == 1
    with pytest.raises(ValueError):
        dc.decontaminate(d, b, mode="other")


def hit_words(text, windows):
    w = words(text)
    return {p for size in {len(x) for x in windows} for k in range(len(w) - size + 1) if tuple(w[k:k + size]) in windows for p in range(k, k + size)}


@pytest.mark.parametrize("max_windows", [200_000, 100, 20])  # one block, a few, and more than are chained without staging
def test_removed_spans_are_the_same_in_one_block_and_in_several(spark, max_windows):
    docs, bench = data(5)
    bench = [x for x in bench if len(words(x[1])) >= 12]
    windows = {tuple(w[k:k + 13]) for w in (words(t) for _, t in bench) for k in range(max(1, len(w) - 12))}
    assert len(windows) > 20 * dc.CHAINED
    rows = [(i, t, [f"{i}"]) for i, t in docs]
    d = spark.createDataFrame(rows, "doc_id long, text string, spans array<string>")
    b = spark.createDataFrame(bench, "item_id long, text string")
    kept = dc.decontaminate(d, b, mode="spans", max_windows=max_windows)
    assert kept.schema == d.schema
    got = {r.doc_id: (r.text, r.spans) for r in kept.collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        hit = hit_words(text, windows)
        assert words(got[i][0]) == [w for k, w in enumerate(words(text)) if k not in hit] and got[i][1] == [f"{i}"]
        assert hit or got[i][0] == text


@pytest.mark.parametrize("max_windows", [200_000, 3])
def test_rows_are_judged_one_by_one_whatever_their_id(spark, max_windows):
    item = " ".join(f"b{k}" for k in range(20))
    bad, clean = f"x {item} y", " ".join(f"c{k}" for k in range(22))
    rows = [(None, bad, 1), (None, clean, 2), (7, bad, 3), (7, clean, 4), (None, clean, 5), (8, bad, 6), (8, bad, 7), (9, None, 8)]
    d = spark.createDataFrame(rows, "doc_id long, text string, row int")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = [tuple(r) for r in dc.verdicts(dc.scan(d, b, max_windows=max_windows)).collect()]
    assert sorted(got, key=str) == sorted((want([r[:2]], [(1, item)])[0] for r in rows), key=str)
    assert sorted(r.row for r in dc.decontaminate(d, b, max_windows=max_windows).collect()) == [2, 4, 5, 8]
