import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kestrel.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, c string, depth string, node string"


def brute(rows, spark):
    """The trie by dictionaries of whole prefixes; ties of a turn are ordered by the hashes that the operator names."""
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    if not rows:
        return []
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "c long, turn long, role string, text string, i long")
    order = [r["i"] for r in df.orderBy("c", F.asc_nulls_first("turn"), F.xxhash64(F.lit(1), "role", "text"), F.xxhash64(F.lit(2), "role", "text")).collect()]
    own = defaultdict(list)
    for i in order:
        own[rows[i][0]].append(rows[i][2:])
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, ms in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(ms) - 1) * (len(k[-1][1]) if k else 0)
    return sorted((ms[0], len(k), members[k[:-1]][0] if k else None, len(ms), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in ms if len(rebuilt[c]) == len(k)).encode()).hexdigest()) for k, ms in members.items())


def check(spark, rows, **how):
    df = spark.createDataFrame([(*r, "a", "b", "d") for r in rows], SCHEMA).repartition(5)
    out = pt.prefix_trie(df, **how)
    got = sorted(tuple(r) for r in out.collect())
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got == brute(rows, spark)


def talk(rng, c, n, words="abc"):
    return [(c, t, rng.choice(["user", "assistant", None]), rng.choice([*words, "", None])) for t in range(n)]


def test_random_conversations(spark):
    rng = random.Random(5)
    rows = [r for c in [*range(0, 130), *range(305, 330), -1, -105, -100, 10 ** 15 + 7] for r in talk(rng, c, rng.randint(1, 9))]
    rows += [(3, None, "user", "early"), (3, None, "user", "early"), (4, 0, "user", "tied"), (4, 0, "user", "other"), (None, 0, "user", "lost"), (7, 1, "x", "é" * 5000)]
    check(spark, rows)


@pytest.mark.parametrize("height, block", [(2, 3), (3, 1024), (16, 7)])
def test_deep_conversations_over_many_bands_and_blocks(spark, height, block):
    rng = random.Random(height)
    long = talk(rng, 200, 90)
    rows = long + [(201, *r[1:]) for r in long] + [(302, *r[1:]) for r in long[:70]] + talk(rng, 303, 40) + [(c, t, "user", "same") for c in (500, 501, 1000) for t in range(30)]
    check(spark, rows, height=height, block=block)


def test_one_text_for_all(spark):
    check(spark, [(c, t, "user", "hello") for c in range(100, 2300, 1) for t in range(2)])


def test_bases_absent_and_short(spark):
    rows = [(c, t, "user", f"{c}-{t}") for c in range(101, 140) for t in range(c % 7 + 1)] + [(200, 0, "user", "only")] + \
        [(c, t, "user", f"{c}-{t}") for c in range(201, 240) for t in range(8)]
    check(spark, rows)


def test_empty_table(spark):
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert pt.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", "", "", "")], SCHEMA)).count() == 0
