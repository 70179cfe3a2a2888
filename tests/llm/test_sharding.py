import random
import zlib
from itertools import accumulate, combinations

from kestrel.llm import sharding as sh


def best(sizes, shards):
    """Smallest possible largest part over all ways to cut."""
    n = len(sizes)
    ends = [0, *accumulate(sizes)]
    return min(max(ends[b] - ends[a] for a, b in zip((0, *cut), (*cut, n))) for k in range(min(shards, n)) for cut in combinations(range(1, n), k))


def test_capacity_is_the_minimax():
    r = random.Random(2)
    for _ in range(200):
        sizes = [r.choice([0, 1, 2, 5, 30]) for _ in range(r.randrange(1, 9))]
        shards = r.randrange(1, 6)
        cap = sh.smallest_capacity(sizes, shards)
        assert cap == max(best(sizes, shards), 0)
        cuts = sh.balanced_cuts(sizes, shards)
        assert len(cuts) == shards - 1 and cuts == sorted(cuts)
        bounds = [0, *cuts, len(sizes)]
        assert max(sum(sizes[a:b]) for a, b in zip(bounds, bounds[1:])) <= cap
    assert sh.smallest_capacity([], 3) == 0 and sh.balanced_cuts([], 3) == [0, 0]


def test_cuts_are_even_beside_a_giant():
    sizes = [10] * 400 + [3000] + [10] * 400
    bounds = [0, *sh.balanced_cuts(sizes, 11), len(sizes)]
    parts = [sum(sizes[a:b]) for a, b in zip(bounds, bounds[1:])]
    rest = sorted(parts)[:-1]
    assert max(parts) <= 3000 + 800 and max(rest) <= 1.3 * min(rest)


def test_heavy_items_do_not_unbalance():
    r = random.Random(9)
    for heavy in ([400] * 7, [3000, 900, 900, 333, 250], [100] * 35, []):
        sizes = [r.randrange(1, 5) for _ in range(4000)] + heavy
        r.shuffle(sizes)
        totals = [0] * 40
        for size, k in zip(sizes, sh.shard_of_items(sizes, 40)):
            totals[k] += size
        rest = [t for t in totals if t not in heavy]        # a shard of one heavy item cannot be smaller
        assert sum(totals) == sum(sizes) and max(rest) <= 1.06 * min(rest)
    assert sorted(sh.item_order([5, 1, 1, 9], 2)) == [0, 1, 2, 3] and sh.shard_of_items([], 3) == []


def test_shards_are_even_whole_and_gapless(spark):
    r = random.Random(4)
    texts = [f"text {k} " * r.randrange(1, 40) for k in range(3000)] + ["hot " * 5] * 700 + [None, "", None, "é"] * 3
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(None, "x", 1), (7, texts[7], 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    out = sh.shard_documents(df, shards=10).collect()
    assert len(out) == len(rows)
    by_text, totals, slots = {}, {}, {}
    text_of = {i: t for i, t, _ in rows}
    for x in out:
        t = text_of[x.doc_id] if x.doc_id is not None else "x"
        assert x.size == len((t or "").encode()) + 16 and x.text_crc32 == zlib.crc32((t or "").encode())
        by_text.setdefault(t or "", set()).add(x.shard)
        totals[x.shard] = totals.get(x.shard, 0) + x.size
        slots.setdefault(x.shard, []).append(x.slot)
        assert x.law == "bytes" and x.grown_shard is None
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(totals) == set(range(10)) and max(totals.values()) < 1.25 * min(totals.values())
    assert sh.shard_documents(df.limit(0), shards=10).count() == 0
    assert {x.shard for x in sh.shard_documents(df.limit(1), shards=1).collect()} == {0}
