import random

import corpus_pipeline as cp
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

from kestrel.llm import bpe, quality
from tests.conftest import SF

STAGES = dict(cp.STAGES)


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"word{k}" for k in range(800)]
    bench = [(k, " ".join(r.choices(vocab, k=20))) for k in range(5)]
    rows = []
    for k in range(120):
        text = " ".join(r.choices(vocab, k=120))
        rows.append(text)
        if k % 10 == 0:
            rows += [text, text + " tail"]                                  # exact and near copies
        if k % 15 == 0:
            rows.append(" ".join(r.choices(vocab, k=60)) + " " + r.choice(bench)[1])
    junk = [" ".join(r.choices(["AAA!!", "***", "|", "$$$"], k=60)) for _ in range(40)]
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(rows + junk)]
    labels = [(i, int(i < len(rows)), 0) for i in range(len(docs))]
    return docs, labels, bench


def test_each_stage_drops_what_it_should(spark, tmp_path):
    docs, labels, bench = corpus(1)
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows, schema in (("documents", docs, columns), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", bench, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    sf, frame = str(tmp_path), spark.read.parquet(f"{tmp_path}/documents.parquet")
    text = {i: t for i, t, *_ in docs}
    good = {i for i, q, _ in labels if q}

    frame_1 = STAGES["quality classifier"](spark, frame, sf)
    ids = {r.doc_id for r in frame_1.collect()}
    assert frame_1.columns == frame.columns and len(ids ^ good) <= 2

    frame_2 = STAGES["exact dedup"](spark, frame_1, sf)
    left = {r.doc_id for r in frame_2.collect()}
    assert frame_2.columns == frame.columns
    assert left == {max(j for j in ids if text[j] == text[i]) for i in ids}

    frame_3 = STAGES["n-gram Jaccard join"](spark, frame_2, sf)
    near = {r.doc_id for r in frame_3.collect()}
    shingles = {i: {tuple(text[i].split()[k:k + 5]) for k in range(len(text[i].split()) - 4)} for i in left}
    linked = lambda i, j: 100 * len(shingles[i] & shingles[j]) >= 80 * len(shingles[i] | shingles[j])
    assert frame_3.columns == frame.columns
    assert near == {i for i in left if not any(j < i and linked(i, j) for j in left)}

    frame_4 = STAGES["benchmark decontamination"](spark, frame_3, sf)
    clean = {r.doc_id for r in frame_4.collect()}
    assert frame_4.columns == frame.columns
    assert clean == {i for i in near if not any(t in text[i] for _, t in bench)}

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert {r.doc_id: r.ids for r in STAGES["byte-level BPE"](spark, frame_4, sf).collect()} == {i: library.encode_ordinary(text[i]) for i in clean}
    assert {r.doc_id for r in cp.run(spark, sf).collect()} == clean


def test_runs_over_the_given_tables_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = docs.count()
    out = cp.run(spark, SF)
    assert 0 < out.count() < whole
    odd = spark.createDataFrame([(None, None, None, None, None), (10 ** 9, "", None, None, 0), (10 ** 9, "", None, None, 0)], docs.schema)
    every = docs.unionByName(odd).withColumns({"n": F.lit("clash"), "rep": F.lit(1), "expected_grade": F.lit(None).cast("string")})
    for name, stage in cp.STAGES[:-1]:
        every = stage(spark, every, SF)
        assert every.columns[-3:] == ["n", "rep", "expected_grade"]
    assert cp.STAGES[-1][1](spark, every, SF).count() > 0
    none = docs.limit(0)
    for name, stage in cp.STAGES:
        none = stage(spark, none, SF)
    assert none.count() == 0


def test_five_stages_in_order():
    assert [name for name, _ in cp.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]
    assert cp.ORACLE_SQL is None and quality.KEEP_GOOD > 0.9
