import base64
import hashlib
import struct

import public_tokenizers as P
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import bpe

RANKS = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
TABLE = bpe.PerfectHash(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids_of(text):
    return [i for piece in regex.findall(P.PATTERN, text) for i in bpe.encode_piece(piece.encode(), TABLE, RANKS)]


def test_hash_is_perfect_and_minimal():
    assert len(TABLE.keys) == len(RANKS) and sorted(TABLE.values) == sorted(RANKS.values())
    assert all(TABLE.get(k) == v for k, v in RANKS.items())
    assert TABLE.get(b"no such token at all") == -1 and bpe.PerfectHash({}).get(b"x") == -1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"]), max_size=60) | st.text(alphabet="ab'se \n\t\x85\x1c é٣", max_size=60))
def test_same_ids_as_the_library(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_long_pieces():
    for text in ("a" * 5000, "abc" * 3000, "é" * 999, "!?" * 2000, " " * 3000 + "x"):
        assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_documents(spark):
    texts = ["Hello world", None, "", "naïve café\n\n  x <|endoftext|>", "Hello world", "z" * 20000, "\x00\x85 　"]
    rows = [(i if i else None, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    shared = bpe.tokenizer(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip_digest(df, shared).collect())
    for (i, n, ids_sha, sha), text in zip(got, texts):
        ids = LIBRARY.encode_ordinary(text or "")
        assert n == len(ids) and ids_sha == hashlib.sha256(struct.pack(f"<{n}I", *ids)).hexdigest()
        assert sha == hashlib.sha256((text or "").encode()).hexdigest()
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(bpe.encode_documents(df, shared), shared).collect()}
    assert all(back[i or None] == (t or "") for i, t in enumerate(texts))
    assert bpe.encode_documents(df.limit(0), shared).count() == 0


def test_ranks_file(tmp_path):
    f = tmp_path / "ranks"
    f.write_bytes(base64.b64encode(b"ab") + b" 7\n\n")
    assert bpe.load_ranks(str(f)) == {b"ab": 7}
