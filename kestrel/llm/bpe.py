"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash (hash and displace) over the vocabulary resolves a whole
pre-token that is itself a token.  Tier 2: any other pre-token is merged by rank with a
heap over a linked list of its bytes, with the ranks of merged pairs in a dictionary.
The vocabulary is a fixed table of about 50,000 entries, so it is broadcast.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import batch_of, text_chunks

MAX_VOCABULARY = 1_000_000   # entries that may be broadcast
MEMO = 500_000               # pre-tokens whose ids a worker remembers
MEMO_BYTES = 256             # longer pre-tokens are not remembered
MASK = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash of byte strings: every key has a slot of its own, none is free.

    A key's hash picks a bucket; the bucket's displacement, mixed in, gives the slot.  Large
    buckets are placed first, single keys take the slots left over (stored as -slot - 1).
    """

    def __init__(self, ids: dict[bytes, int]):
        n = len(ids)
        if n > MAX_VOCABULARY:
            raise ValueError(f"a vocabulary of {n} entries is above the bound of {MAX_VOCABULARY}")
        self.n, self.buckets = n, max(1, n // 3)
        self.keys, self.values, self.shifts = [b""] * n, array("l", [-1]) * n, array("l", [0]) * self.buckets
        groups: dict[int, list] = {}
        for key in ids:
            h = xxhash.xxh3_64_intdigest(key)
            groups.setdefault(h % self.buckets, []).append((h, key))
        taken = bytearray(n)
        order = sorted(groups.items(), key=lambda x: -len(x[1]))
        free = None
        for bucket, members in order:
            if len(members) == 1:
                free = free if free is not None else iter([s for s in range(n) if not taken[s]])
                slots = [next(free)]
                self.shifts[bucket] = -slots[0] - 1
            else:
                shift = 0
                while True:
                    slots = [self._slot(h, shift) for h, _ in members]
                    if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                        break
                    shift += 1
                self.shifts[bucket] = shift
            for slot, (_, key) in zip(slots, members):
                taken[slot] = 1
                self.keys[slot], self.values[slot] = key, ids[key]

    def _slot(self, h: int, shift: int) -> int:
        x = (h + shift * 0x9E3779B97F4A7C15) & MASK
        x = ((x ^ (x >> 31)) * 0x94D049BB133111EB) & MASK
        return (x >> 17) % self.n

    def get(self, key: bytes) -> int:
        """The key's id, or -1."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shifts[h % self.buckets]
        slot = -shift - 1 if shift < 0 else self._slot(h, shift)
        return self.values[slot] if self.keys[slot] == key else -1


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece that is no token itself: lowest rank first, of equal ranks the leftmost.

    Node i spans piece[i:after[i]]; pair[i] is the rank of joining it with its successor (-1:
    none).  Heap entries are rank and node in one integer; one whose rank is no longer the
    node's is out of date.
    """
    n, get = len(piece), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n))
    pair = [get(piece[i:i + 2], -1) for i in range(n - 1)] + [-1]
    heap = [rank << 32 | i for i, rank in enumerate(pair) if rank >= 0]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        i = entry & 0xFFFFFFFF
        if pair[i] != entry >> 32:
            continue
        gone = after[i]
        after[i] = stop = after[gone]
        pair[gone] = -1
        rank = -1
        if stop < n:
            before[stop] = i
            rank = get(piece[i:after[stop]], -1)
            if rank >= 0:
                heappush(heap, rank << 32 | i)
        pair[i] = rank
        left = before[i]
        if left >= 0:
            pair[left] = rank = get(piece[left:stop], -1)
            if rank >= 0:
                heappush(heap, rank << 32 | left)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


def encode_piece(piece: bytes, table: PerfectHash, ranks: dict[bytes, int]) -> list[int]:
    whole = table.get(piece)
    return [whole] if whole >= 0 else merge_bytes(piece, ranks)


class _Memo(dict):
    """Pre-token to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, table: PerfectHash, ranks: dict[bytes, int]):
        self.table, self.ranks = table, ranks

    def __missing__(self, token: str) -> bytes:
        piece = token.encode("utf-8")
        ids = array("I", encode_piece(piece, self.table, self.ranks)).tobytes()
        if len(piece) <= MEMO_BYTES:
            if len(self) >= MEMO:
                self.clear()
            self[token] = ids
        return ids


def _codec(shared):
    """Encoder and decoder built from the broadcast tables, once per worker: its later tasks find them there."""
    state = shared.value
    if "codec" in state:
        return state["codec"]
    table = PerfectHash.__new__(PerfectHash)
    table.__dict__.update(state["hash"])
    split, memo = regex.compile(state["pattern"]).findall, _Memo(table, state["ranks"])
    tokens = dict(zip(table.values, table.keys))

    def encode(text: str) -> bytes:
        return b"".join(map(memo.__getitem__, split(text)))

    def decode(ids: bytes) -> bytes:
        return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    state["codec"] = encode, decode
    return state["codec"]


def _encode(batches, shared):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    encode, _ = _codec(shared)
    for part, texts in text_chunks(batches):
        packed = [encode(t.decode("utf-8")) for t in texts]
        ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)))
        yield batch_of(schema, [part.column(0), ids])


def _digest(batches, shared):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    encode, decode = _codec(shared)
    for part, texts in text_chunks(batches):
        packed = [encode(t.decode("utf-8")) for t in texts]
        yield batch_of(schema, [part.column(0), [len(p) // 4 for p in packed], [hashlib.sha256(p).hexdigest() for p in packed],
                                [hashlib.sha256(decode(p)).hexdigest() for p in packed]])


def _decode(batches, shared):
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    _, decode = _codec(shared)
    for b in batches:
        texts = [decode(np.asarray(ids or [], "<u4").tobytes()).decode("utf-8", "replace") for ids in b.column(1).to_pylist()]
        yield batch_of(schema, [b.column(0), texts])


def tokenizer(spark, ranks_path: str, pattern: str):
    """Broadcast of the perfect hash over the ranks in a file (read on the driver) and the pre-token pattern."""
    ranks = load_ranks(ranks_path)
    return spark.sparkContext.broadcast({"hash": vars(PerfectHash(ranks)), "ranks": ranks, "pattern": pattern})


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode_documents(docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: each whole text encoded, without special tokens.

    Null and empty texts have no ids; a null id stays null; repeated rows are separate rows;
    an empty table gives an empty result; other columns are ignored.
    """
    return _source(docs, id_col, text_col).mapInArrow(lambda it: _encode(it, shared), T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode_documents(encoded: DataFrame, shared) -> DataFrame:
    """``doc_id, text`` from the rows of ``encode_documents``; null ids decode to an empty text."""
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(lambda it: _decode(it, shared), "doc_id long, text string")


def round_trip_digest(docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the bytes decoded from them."""
    return _source(docs, id_col, text_col).mapInArrow(
        lambda it: _digest(it, shared), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
