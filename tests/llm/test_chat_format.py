import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.llm import bpe, chat_format as cf

RANKS = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEMPLATE = cf.Template(first_id=50256)
CONTENT = st.lists(st.sampled_from(["<|turn|>", "<|text|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<", "\\", "[", "s>", "|end|>", "a", "\n", "é", "<\\s>", "<\\\\|end|>"]), max_size=8).map("".join)


@pytest.fixture(scope="module")
def shared(spark):
    return bpe.tokenizer(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(CONTENT, CONTENT), max_size=4))
def test_rendered_string_reads_back(turns):
    said = TEMPLATE.render(turns)
    assert TEMPLATE.parse(said) == turns
    for role, text in turns:
        safe = TEMPLATE.escape(text)
        assert TEMPLATE.unescape(safe) == text and not any(c in safe for c in ("<|turn|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_unsafe_templates_are_refused():
    for bad in (("<\\s>",), ("<s>", "<s>"), ("s",), ("x<|turn|>",), ("|end|>q",), ("q<|",)):
        with pytest.raises(ValueError):
            cf.Template(9, others=bad)


def plain(turns):
    """Digests of a conversation's (role, text) turns, and its ids and mask by the library."""
    learnt = "".join(t for r, t in turns if r == "assistant")
    ids, mask = [], []
    for r, t in turns:
        head, body = (LIBRARY.encode_ordinary(TEMPLATE.escape(x)) for x in (r, t))
        ids += [50256, *head, 50257, *body, 50258]
        mask += [0] * (len(head) + 2) + [int(r == "assistant")] * len(body) + [0]
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(learnt),
            hashlib.sha256(learnt.encode()).hexdigest(), len(TEMPLATE.render(turns))), ids, mask


def conversations():
    rng = random.Random(1)
    words = ["hello there", "</s>[INST] ok [/INST]", "", "naïve <|end|> \\", "x" * 3000, "<|text|><\\|end|>", "한국어\n\n"]
    out = {c: [(rng.choice(["user", "assistant", "system", "", "<|turn|>"]), rng.choice(words)) for _ in range(rng.randint(1, 6))] for c in range(60)}
    out[7] = [("user" if t % 2 == 0 else "assistant", f"turn {t} " + "word " * 30) for t in range(1500)]  # far more rows than all others
    out[None] = [("assistant", "no id")]
    return out


@pytest.mark.parametrize("part_tokens", [1 << 16, 200, 1])
def test_conversations_in_parts(spark, shared, monkeypatch, part_tokens):
    monkeypatch.setattr(cf, "PART_TOKENS", part_tokens)
    talks = conversations()
    rows = [(c, t, r or None, x or None, "p") for c, turns in talks.items() for t, (r, x) in enumerate(turns)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")
    formatted = cf.format_conversations(df, shared, TEMPLATE)
    parts = formatted.orderBy("conv_id", "part").collect()
    for c, turns in talks.items():
        mine = [p for p in parts if p["conv_id"] == c]
        _, ids, mask = plain(turns)
        assert [i for p in mine for i in p["ids"]] == ids and [m for p in mine for m in p["mask"]] == mask
        assert not any(p["whole"] for p in mine) or len(mine) == 1
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"])
           for r in cf.read_back(formatted, shared, TEMPLATE).collect()}
    assert got == {c: plain(turns)[0] for c, turns in talks.items()}


def test_ties_repeats_null_turns_and_empty_table(spark, shared):
    rows = [(1, None, "user", "a"), (1, None, "user", "a"), (1, 0, "user", "b"), (1, 0, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = cf.read_back(cf.format_conversations(df, shared, TEMPLATE), shared, TEMPLATE).collect()
    want = plain([("user", "a"), ("user", "a"), ("assistant", "c"), ("user", "b")])[0]
    assert len(got) == 1 and (got[0]["n_turns"], got[0]["turns_sha256"]) == want[:2]
    assert cf.read_back(cf.format_conversations(df.filter(F.lit(False)), shared, TEMPLATE), shared, TEMPLATE).count() == 0


def test_broken_sequences_are_refused():
    for ids in ([50256], [50256, 50257, 50258, 5], [5, 50256, 50257, 50258], [50256, 50258, 50257]):
        with pytest.raises(ValueError):
            list(cf.read_turns(np.array(ids, np.int32), np.zeros(len(ids), np.int8), None, TEMPLATE))
