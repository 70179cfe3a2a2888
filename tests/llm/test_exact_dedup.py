import hashlib
import random

import pytest

from kestrel.llm import exact_dedup as ed


def want(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("heavy_rows", [2, 20, 10 ** 6])
def test_equal_brute_force_on_both_paths(spark, heavy_rows):
    r = random.Random(heavy_rows)
    texts = ["hot"] * 200 + ["warm"] * 15 + [f"t{r.randrange(60)}" for _ in range(80)] + ["", None, "é", "é ", "x" * 100000] * 2
    rows = list(zip(r.sample(range(10 ** 6), len(texts)), texts)) + [(None, "hot"), (None, "alone")]
    rows += [rows[0], rows[-3]]                       # repeated rows
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, group_size int")
    got = ed.exact_duplicates(df, buckets=4, per_bucket=2, tracked=16, heavy_rows=heavy_rows)
    assert sorted((tuple(x) for x in got.collect()), key=str) == want(rows)
    left = ed.drop_exact_duplicates(df, buckets=4, per_bucket=2, tracked=16, heavy_rows=heavy_rows).collect()
    assert {x.text or "" for x in left} == {t or "" for _, t in rows} and left[0].group_size == 1


def test_empty_and_normalised(spark):
    df = spark.createDataFrame([(1, "A"), (2, "a")], "doc_id long, text string")
    from pyspark.sql import functions as F
    assert {r.group_size for r in ed.exact_duplicates(df, normalise=F.lower).collect()} == {2}
    assert ed.exact_duplicates(df.limit(0)).count() == 0 and ed.drop_exact_duplicates(df.limit(0)).count() == 0


def test_a_lost_text_takes_no_other_text_of_its_id(spark):
    df = spark.createDataFrame([(5, "A", "x"), (5, "B", "y"), (9, "A", "z"), (5, None, "n"), (None, "B", "w")], "doc_id long, text string, text_sha256 string")
    left = ed.drop_exact_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.text_sha256 for r in left.collect()) == ["n", "w", "y", "z"]
    from pyspark.sql import functions as F
    lower = spark.createDataFrame([(5, "A"), (5, "B"), (9, "a")], "doc_id long, text string")
    assert sorted(tuple(r) for r in ed.drop_exact_duplicates(lower, normalise=F.lower).collect()) == [(5, "B"), (9, "a")]
