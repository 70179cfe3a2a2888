import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from kestrel.llm import line_dedup as ld

BLANK = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(BLANK).translate(FOLD)


def want(rows):
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("heavy", [4, 256, 10 ** 6])
def test_equal_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(ld, "HEAVY_ROWS", heavy)
    r = random.Random(heavy)
    lines = [f"shared line number {k} of the corpus" for k in range(30)] + ["short", "", "  Shared Line Number 3 of the corpus \t", "é" * 20, "é" * 19, "\x0b" + "É" * 20]
    texts = ["\n".join(r.choices(lines, k=r.randrange(0, 9))) for _ in range(150)]
    texts += ["\n".join(["the very common line of all documents", f"own line of document number {k}"] * 2) for k in range(300)]
    texts += [None, "", "\n", "y" * 200000, "\n".join(["common in one document only, many times"] * 5000)]
    ids = r.sample(range(10 ** 6), len(texts))
    df = spark.createDataFrame([(i, t, 9) for i, t in zip(ids, texts)], "doc_id long, text string, n_lines int")
    assert sorted(tuple(x) for x in ld.line_dedup_digest(df).collect()) == want(list(zip(ids, texts)))


def test_bitmaps_and_texts(spark):
    a, b = "a line that is long enough to count", "another line that is long enough"
    df = spark.createDataFrame([(1, f"{a}\n{b}\nx"), (2, a), (3, f"{a}\n{a}"), (3, f"{a}\n{a}"), (None, a)], "doc_id long, text string")
    _, bitmaps = ld.keep_bitmaps(df)
    got = {r.doc_id: ld.unpack_bitmap(r.keep_bitmap, r.n_lines).tolist() for r in bitmaps.collect()}
    assert got == {1: [False, True, True], 2: [False]}
    assert {r.doc_id: r.kept_text for r in ld.kept_texts(df, bitmaps).collect()} == {1: f"{b}\nx", 2: ""}
    digest = ld.line_dedup_digest(df).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in digest) == [(0, 0), (1, 1), (2, 1), (3, 0), (3, 0)]
    assert ld.line_dedup_digest(df.limit(0)).count() == 0


def test_stream_marks_do_not_depend_on_batches():
    r = np.random.default_rng(1)
    rows = np.column_stack([r.integers(0, 12, 400), r.integers(0, 2, 400), r.integers(0, 9, 400), r.integers(0, 50, 400)])
    rows = rows[np.lexsort((rows[:, 3], -rows[:, 2], rows[:, 1], rows[:, 0]))]

    def run(size):
        batches = (pa.RecordBatch.from_arrays([pa.array(c) for c in rows[k:k + size].T], names=list("abcd")) for k in range(0, len(rows), size))
        return sorted(x for b in ld._stream_marks(batches, 3) for x in zip(*(c.to_pylist() for c in b.columns)))

    assert run(1) == run(7) == run(400) and len(run(400)) > 100


@pytest.mark.parametrize("heavy", [2, 10 ** 6])
def test_rows_of_one_id_keep_their_own_lines(spark, monkeypatch, heavy):
    monkeypatch.setattr(ld, "HEAVY_ROWS", heavy)
    common, other = "a line that many documents hold", "another line that many documents hold"
    rows = [(1, f"own first line of a text\n{common}"), (1, "short\nunique line of the second text\nx"), (1, f"{other}\n{common}\n{common}"), (1, None)]
    rows += [(k, f"{common}\n{other}") for k in (2, 3, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in ld.line_dedup_digest(df).collect()) == want(rows)
