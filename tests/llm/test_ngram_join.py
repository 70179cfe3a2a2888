import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kestrel.llm import common
from kestrel.llm import ngram_join as nj
from kestrel.llm.components import connected_components
from kestrel.session import stage_table


def brute(rows, width, num, den):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    comp = {i: i for i, _ in rows}
    find = lambda x: x if comp[x] == x else find(comp[x])
    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x], sets[y]
            if a and b and den * len(a & b) >= num * len(a | b):
                p, q = sorted((find(rows[x][0]), find(rows[y][0])))
                comp[q] = p
    return sorted((i, len(s), find(i)) for (i, _), s in zip(rows, sets))


def corpus(seed, docs, hot):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(4000)]
    passage = r.choices(vocab, k=60)
    rows = []

    def edited(words, edits):
        words = list(words)
        for _ in range(edits):
            words[r.randrange(len(words))] = r.choice(vocab)
        return words

    base = r.choices(vocab, k=150)
    rows += [edited(base, r.randrange(0, 6)) for _ in range(hot)]
    while len(rows) < docs:
        words = r.choices(vocab, k=r.choice([1, 2, 3, 5, 9, 12, 20, 40, 80, 200, 600]))
        if r.random() < 0.3:
            words[len(words) // 2:len(words) // 2] = passage
        rows.append(words)
        for _ in range(r.choice([0, 0, 1, 4])):
            words = edited(words, r.randrange(0, 1 + max(1, len(words) // 40)))
            rows.append(words + r.choices(vocab, k=r.choice([0, 0, 1, 3])))
    texts = [" ".join(w) for w in rows] + ["", " \t\n", None, "A b\x0bC", "a B c", "x" * 5000]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed,docs,hot,width,num,large", [(1, 400, 0, 3, 90, 4), (2, 500, 120, 5, 80, 1 << 14), (2, 500, 120, 5, 80, 8), (3, 300, 0, 1, 50, 40)])
def test_components_equal_brute_force(spark, monkeypatch, seed, docs, hot, width, num, large):
    monkeypatch.setattr(nj, "SMALL_HUB", 4)
    monkeypatch.setattr(nj, "BLOCK", 16)
    monkeypatch.setattr(common, "KEY_BUCKETS", 3 if seed == 1 else 1 << 20)
    monkeypatch.setattr(nj, "LARGE_HUB", large)
    rows = corpus(seed, docs, hot)
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n long")
    got = sorted(tuple(r) for r in nj.linked_components(df, width=width, num=num, den=100).collect())
    assert got == brute(rows, width, num, 100)


def test_segment_keys_lose_no_linked_pair():
    """Two sets at the threshold always share a key, whatever their sizes and weak segments."""
    r = np.random.default_rng(5)
    for num in (50, 80, 90, 95):
        scheme = nj.Scheme(num, 100)
        for _ in range(300):
            n = int(r.integers(1, 400))
            common = r.integers(0, 2 ** 63, n).astype(np.uint64)
            spare = max(0, (100 - num) * n // num)
            left = int(r.integers(0, spare + 1))
            a = np.unique(np.r_[common, r.integers(0, 2 ** 63, left).astype(np.uint64)])
            b = np.unique(np.r_[common, r.integers(0, 2 ** 63, spare - left).astype(np.uint64)])
            assert 100 * n >= num * (len(a) + len(b) - n)
            assert np.array_equal(a, b) or set(scheme.keys(a).tolist()) & set(scheme.keys(b).tolist())


def test_bitmap_bound_never_below_overlap():
    r = np.random.default_rng(6)
    for top in (300, 5000):
        for _ in range(60):
            pool = np.unique(r.integers(0, 2 ** 63, top).astype(np.uint64))
            a, b = (np.sort(r.choice(pool, int(r.integers(1, len(pool))), replace=False)) for _ in range(2))
            common = len(np.intersect1d(a, b))
            assert nj.overlap(a, b) == common
            assert nj.overlap_bound(nj.bitmap(a), nj.bitmap(b), len(a) + len(b)) >= 2 * common


def test_known_tiles_keep_every_member():
    """A tile that many sets of a batch share leaves no member out, and one row on the shared route."""
    texts = [" ".join(f"w{k}" for k in range(40)) + f" end{i}" for i in range(20)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(20)), "text": texts, "mark": [0] * 20})
    tiles = {}
    for b in nj._scan([batch], 3, 80, 100):
        for r in b.to_pylist():
            for t in r["tiles"]:
                tiles.setdefault(t["key"], []).append((r["d1"], t["route"]))
    hot = [t for t in tiles.values() if len(t) >= nj.KNOWN]
    assert hot and all(sum(r == 0 for _, r in t) == 1 and len({n for n, r in t if r}) == len({n for n, _ in t}) for t in hot)


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(5000, 5000), (None, 3), (7000, 6999), (7000, 6999)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1300)} | {5000: 5000, 7000: 6999, 6999: 6999}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_null_and_repeated_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (None, "a b c d e f"), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in nj.linked_components(df).collect())
    assert got == [(0, 0, None), (0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    assert nj.linked_components(df.limit(0)).count() == 0
    assert sorted(r.doc_id or 0 for r in nj.keep_one(df).collect()) == [0, 1, 1, 3]


A, B, C = ("one two three four five six seven", "a quite different text of eight words altogether", "third text that has nothing in common with them")


def test_rows_of_one_id_are_one_document(spark):
    rows = [(5, A), (5, B), (3, B), (8, C), (5, "x y"), (9, "x  y"), (7, None), (7, C)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in nj.linked_components(df).collect())
    assert got == sorted([(5, 3, 3), (5, 4, 3), (3, 4, 3), (8, 5, 7), (5, 1, 3), (9, 1, 3), (7, 0, 7), (7, 5, 7)])


def test_a_text_stays_unless_one_linked_with_it_does(spark):
    """Rows that repeat an id are judged by their texts: against brute force over all subsets of such rows."""
    near = C + " words"
    rows = [(5, A), (5, B), (3, B), (8, C), (8, near), (8, A + "\t"), (9, None), (9, ""), (None, B), (None, "only one without id"), (2, near), (2, near)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, mark long")
    kept = [(r.doc_id, r.text) for r in nj.keep_one(df).collect()]
    place = {t: comp for _, t, comp in ((i, t, c) for (i, t), (_, _, c) in zip(enumerate({t: 0 for _, t in rows}), _text_components(list({t: 0 for _, t in rows}))))}
    want = []
    for i, t in rows:
        mates = [(j is None, j or 0, u) for j, u in rows if place[u] == place[t] and (u or "").split()]
        if not (t or "").split() or (i is None, i or 0) == min(m[:2] for m in mates) and sum(1 for m in {m for m in mates if m[:2] == (i is None, i or 0)}) == 1:
            want.append((i, t))
    assert sorted(kept, key=str) == sorted(want, key=str)
    # near texts under one id: exactly one of them stays
    twice = spark.createDataFrame([(1, C), (1, near), (4, C)], "doc_id long, text string")
    assert [r.doc_id for r in nj.keep_one(twice).collect()] == [1]


def _text_components(texts):
    return brute(list(enumerate(texts)), 5, 80, 100)


def _sharing(sets, own=60):
    """Sets that share 100 words and have some of their own: one hub of all, in which none links."""
    return [(i, " ".join(f"c{k}" for k in range(100)) + " " + " ".join(f"w{i}x{k}" for k in range(own))) for i in range(sets)]


def test_rows_dealt_to_blocks_do_not_grow_with_the_square_of_a_hub(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 16)
    dealt, block_groups = [], nj._block_groups

    def spy(rows, *rest):
        blocks = F.when(F.col("comp") == F.col("main"), F.col("s")).otherwise(F.col("s") + F.col("s_main"))
        dealt.append(rows.agg(F.coalesce(F.sum(blocks), F.lit(0))).first()[0])
        return block_groups(rows, *rest)

    monkeypatch.setattr(nj, "_block_groups", spy)
    rows = _sharing(400)
    out = nj.linked_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in out.collect()} == {(i, i) for i, _ in rows}
    assert sum(dealt) <= 2 * len(rows)


def test_links_inside_a_hub_of_many_sets_are_kept(spark):
    """Near copies of some members of a large hub are linked with them."""
    rows = _sharing(60)
    rows += [(100 + i, text + f" more{i}") for i, text in rows[::7]]
    want = brute(rows, 5, 80, 100)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in nj.linked_components(df).collect()) == want
    assert any(i != c for i, _, c in want)


def test_rarest_shingles_of_linked_sets_meet_whatever_the_counts():
    class Counts:
        pass

    r, words = random.Random(3), [f"w{k}" for k in range(300)]
    for num in (50, 80, 90):
        Counts.value = np.array([r.randrange(4) for _ in range(nj.SHINGLE_BUCKETS)], np.int32)
        for _ in range(40):
            a = r.choices(words, k=r.randrange(1, 60))
            b = list(a)
            for _ in range(r.randrange(0, 4)):
                b[r.randrange(len(b))] = r.choice(words)
            texts = [" ".join(x) for x in (a, b)]
            x, y = (nj.shingle_hashes(t.encode(), 1, nj.WordHashes()) for t in texts)
            common_hashes = nj.overlap(x, y)
            keys = [set(k) for p in nj._rarest([pa.RecordBatch.from_pydict({"text": texts})], 1, num, 100, Counts) for k in p.to_pydict()["keys"]]
            assert 100 * common_hashes < num * (len(x) + len(y) - common_hashes) or keys[0] & keys[1]


def test_shuffle_files_go_when_a_table_is_staged(spark):
    """Disk of a stage: not all of its shuffles at once, and its tiles part by part."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {n for n in disk.getAllFiles().mkString(" ").split() if "/shuffle_" in n}
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", held()
    setting = spark.conf.get(key)
    table = stage_table(spark.range(0, 50_000, 1, 4).groupBy((F.col("id") % 977).alias("k")).count(), "shuffled")
    for _ in range(50):
        if not held() - before:
            break
        time.sleep(0.1)
    assert not held() - before and table.count() == 977 and spark.conf.get(key) == setting


def test_tiles_are_gathered_in_parts(spark):
    rows = [(i, [{"key": k, "route": 0} for k in range(-20, 20) if (k + i) % 3 == 0] + ([{"key": 99, "route": 1 + i}] if i < 3 else [])) for i in range(9)] + [(50, [{"key": 1000, "route": 0}])]
    sets = stage_table(spark.createDataFrame(rows, "d1 long, tiles array<struct<key:long,route:int>>"), "tile-test")
    parts = [sorted(map(tuple, p.collect())) for p in nj._shared_tiles(sets)]
    assert len(parts) == nj.TILE_PASSES > 1 and all(len({k % nj.TILE_PASSES for k, _ in p}) == 1 for p in parts)
    assert sorted(sum(parts, [])) == sorted((t["key"], d) for d, tiles in rows[:-1] for t in tiles)
