"""Alignment of the tokens of two tokenizers, and corpus-wide counts of the id pairs it links.

1. Every text is encoded by both tokenizers; where a token of each ends at the same byte
   offset, there is a shared cut.  Cuts are found by divide and conquer: of an interval, the
   common end nearest to its middle is located by bisecting the other side's ends, and both
   halves are cut again; an interval without a common end is one leaf group.  All intervals
   of a chunk of texts are halved together, so a level costs a few array operations.
2. Per text the distinct linked id pairs and how often each is linked are staged; pairs are
   counted over all documents with map-side combining.
3. Counts go back to the links by a split lookup: pairs at or above a count that at most
   ``FREQUENT`` pairs reach are broadcast and resolved where the links are; only links of
   rarer pairs, of which none is in more documents than that count, are shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import batch_of, text_chunks
from kestrel.session import stage_table

FREQUENT = 1 << 18           # pairs that may be broadcast (a long and two values each)
CHUNK_BYTES = 1 << 20        # text whose tokens and links are held at once, besides one text of any length
MEMO, MEMO_CHARS = 250_000, 64   # words whose ids a worker remembers, and their longest
LONG_WORD = 200_000          # above it the slower library encodes a word
WIDE_GROUP = 64              # links of a group above which equal ids are counted instead of written out

# Fixed value: the pre-token pattern of byte-level vocabularies of this file format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# A single blank between two words: byte-level tokens never hold a blank but in front, nor does
# any piece of a vocabulary without blanks inside.  So the ids of a text are those of its words.
BETWEEN_WORDS = re.compile(r"(?<=[\w!-~]) (?=\S)")


# Tokenizers ----------------------------------------------------------------------------

def _byte_alphabet() -> dict[str, int]:
    """Character to byte: printable Latin-1 characters are themselves, the other bytes follow from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Byte-level BPE from a vocabulary in JSON; ids of blank + text."""

    def __init__(self, blob: bytes):
        spec = json.loads(blob)
        alphabet, vocab = _byte_alphabet(), spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes = [b""] * size
        for entry, i in vocab.items():
            self.bytes[i] = entry.encode() if entry in special else bytes(map(alphabet.__getitem__, entry))
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        self.blob, self.fast = blob, None
        if merged == sorted(merged):  # the order of ids is the order of merges: the quicker library gives the same ids
            import tiktoken

            ranks = {self.bytes[i]: i for entry, i in vocab.items() if entry not in special}
            self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def whole(self):
        """The vocabulary's own library; large, so it is only loaded where a word needs it."""
        from tokenizers import Tokenizer

        out = Tokenizer.from_str(self.blob.decode())
        out.encode_special_tokens = True  # their strings in a text are plain text
        return out

    def encode(self, words: list[str]) -> list[list[int]]:
        if not self.fast:
            return [e.ids for e in self.whole.encode_batch([" " + w for w in words], add_special_tokens=False)]
        return [self.fast.encode_ordinary(" " + w) if len(w) <= LONG_WORD else self.whole.encode(" " + w, add_special_tokens=False).ids for w in words]


class Pieces:
    """Sentence pieces with byte fallback; the model itself puts a blank in front."""

    def __init__(self, blob: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes = [b"" if self.model.is_control(i) or self.model.is_unknown(i)
                      else bytes([int(name[3:5], 16)]) if self.model.is_byte(i)
                      else name.replace("▁", " ").encode() for i, name in enumerate(names)]
        self.inner_blank = any("▁" in name.lstrip("▁") for name in names)

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.model.encode(words, num_threads=1)


class Encoder:
    """Both tokenizers; the ids of words met before are remembered.  A blank goes in front of every text."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        self.sides = ByteLevel(byte_level), Pieces(pieces)
        self.sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in self.sides]
        marks = (",", "|"), (",", ";")
        self.said = [f"{i}{mark}" for side, ends in zip(self.sides, marks) for mark in ends for i in range(len(side.bytes))]
        self.split = (lambda text: [text]) if self.sides[1].inner_blank else BETWEEN_WORDS.split
        self.memo: tuple[dict, dict] = ({}, {})
        self.unlike: set[str] = set()  # words whose tokens' bytes are not blank + word

    def bytes_of(self, side: int, ids) -> bytes:
        return b"".join(map(self.sides[side].bytes.__getitem__, ids))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of each text by both, None where the tokens' bytes are not blank + text."""
        if len(self.memo[0]) > MEMO:
            self.memo[0].clear(), self.memo[1].clear(), self.unlike.clear()
        split = [self.split(t) for t in texts]
        new = list(set().union(*split).difference(self.memo[0]))
        for side in (0, 1):
            found = self.sides[side].encode(new)
            self.memo[side].update(zip(new, (array("i", ids).tobytes() for ids in found)))
            if self.bytes_of(side, chain.from_iterable(found)) != b"".join(b" " + w.encode() for w in new):
                self.unlike.update(w for w, ids in zip(new, found) if self.bytes_of(side, ids) != b" " + w.encode())
        out = []
        for text, words in zip(texts, split):
            a, b = (np.frombuffer(b"".join(map(m.__getitem__, words)), np.int32).astype(np.int64) for m in self.memo)
            same = self.unlike.isdisjoint(words) or all(self.bytes_of(k, x.tolist()) == b" " + text.encode() for k, x in ((0, a), (1, b)))
            out.append((a, b) if same else None)
        for w in new:
            if len(w) > MEMO_CHARS:
                del self.memo[0][w], self.memo[1][w]
                self.unlike.discard(w)
        return out


def tokenizers(spark: SparkSession, byte_level: str, pieces: str):
    """Broadcast of the two vocabulary files (read on the driver; about 2 MB)."""
    with open(byte_level, "rb") as a, open(pieces, "rb") as b:
        return spark.sparkContext.broadcast({"a": a.read(), "b": b.read()})


def _encoder(shared) -> Encoder:
    """The encoder, built once per worker."""
    state = shared.value
    if "encoder" not in state:
        state["encoder"] = Encoder(state["a"], state["b"])
    return state["encoder"]


# Alignment -----------------------------------------------------------------------------

def _near_middle(a_ends, b_ends, lo, hi):
    """For each interval of a-tokens lo..hi-1: the common end nearest to the middle of its inner ends (lo..hi-2).

    Returns its index in ``a_ends`` (-1: none) and in ``b_ends``.  Windows around the middle double, so an
    interval costs what its nearest common end is away.
    """
    at_a, at_b = np.full(len(lo), -1), np.full(len(lo), -1)
    middle, left = (lo + hi - 2) // 2, np.arange(len(lo))
    start, width, away = 0, 1, np.zeros(1, np.int64)
    while len(left):
        probe = middle[left, None] + away
        inside = (probe >= lo[left, None]) & (probe <= hi[left, None] - 2)
        row, col = np.nonzero(inside)
        ends = probe[row, col]
        place = np.searchsorted(b_ends, a_ends[ends])
        common = b_ends[place] == a_ends[ends]
        row, ends, place = row[common], ends[common], place[common]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
        at_a[left[row[first]]], at_b[left[row[first]]] = ends[first], place[first]
        start, width = start + width, start + width
        away = (np.arange(start, start + width)[:, None] * np.array([1, -1])).ravel()
        more = inside.any(axis=1)
        more[row[first]] = False
        left = left[more]
    return at_a, at_b


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_stops: np.ndarray, b_stops: np.ndarray):
    """Groups of tokens between common ends, by divide and conquer.

    ``a_ends`` and ``b_ends`` are ascending byte offsets over texts laid end to end; text i
    holds a-tokens up to ``a_stops[i]`` and b-tokens up to ``b_stops[i]``, and both end at one
    offset.  Returns the a-token and the b-token at which each group stops, in order.
    """
    lo_a, hi_a, lo_b, hi_b = np.r_[0, a_stops[:-1]], a_stops, np.r_[0, b_stops[:-1]], b_stops
    stops_a, stops_b = [a_stops], [b_stops]
    while True:
        inner = (hi_a - lo_a > 1) & (hi_b - lo_b > 1)
        lo_a, hi_a, lo_b, hi_b = lo_a[inner], hi_a[inner], lo_b[inner], hi_b[inner]
        if not len(lo_a):
            break
        at_a, at_b = _near_middle(a_ends, b_ends, lo_a, hi_a)
        cut = at_a >= 0  # the others are leaves
        at_a, at_b = at_a[cut] + 1, at_b[cut] + 1
        stops_a.append(at_a)
        stops_b.append(at_b)
        lo_a, hi_a = np.column_stack([lo_a[cut], at_a]).ravel(), np.column_stack([at_a, hi_a[cut]]).ravel()  # halves in order
        lo_b, hi_b = np.column_stack([lo_b[cut], at_b]).ravel(), np.column_stack([at_b, hi_b[cut]]).ravel()
    return np.sort(np.concatenate(stops_a)), np.sort(np.concatenate(stops_b))


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenation of ``starts[i] .. starts[i] + sizes[i] - 1``."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _links(a, b, text_of, a_from, a_n, b_from, b_n, n_a: int, n_b: int):
    """Distinct (text, a id, b id) as one number each, ascending, and how many token pairs each stands for."""
    narrow = a_n * b_n <= WIDE_GROUP
    an, bn = a_n[narrow], b_n[narrow]
    token = _spans(a_from[narrow], an)
    partners = np.repeat(bn, an)
    other = _spans(np.repeat(b_from[narrow], an), partners)
    keys = [(np.repeat(np.repeat(text_of[narrow], an) * n_a + a[token], partners)) * n_b + b[other]]
    if narrow.all():
        return np.unique(keys[0], return_counts=True)
    times = [np.ones(len(keys[0]), np.int64)]
    for g in np.flatnonzero(~narrow):
        x, n_x = np.unique(a[a_from[g]:a_from[g] + a_n[g]], return_counts=True)
        y, n_y = np.unique(b[b_from[g]:b_from[g] + b_n[g]], return_counts=True)
        keys.append((((text_of[g] * n_a + x) * n_b)[:, None] + y).ravel())
        times.append((n_x[:, None] * n_y).ravel())
    keys, times = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else keys
    return keys[first], np.add.reduceat(times, first) if len(keys) else times


def align_texts(texts: list[bytes], encoder: Encoder) -> dict[str, list | np.ndarray]:
    """Per text the counts, the digest of its groups, and its distinct links (``a``, ``b``, ``times`` with ``ends``)."""
    size_a, size_b = encoder.sizes
    n = len(texts)
    used = [i for i, raw in enumerate(texts) if raw]
    both = encoder.encode([texts[i].decode("utf-8") for i in used])
    used = [i for i, x in zip(used, both) if x]
    ids_a, ids_b = zip(*filter(None, both)) if used else ((), ())
    out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")} | {"sha": [""] * n}
    if not used:
        return out | {k: np.zeros(0, np.int64) for k in ("a", "b", "times")} | {"ends": np.zeros(n + 1, np.int64)}
    used = np.array(used)
    len_a, len_b = (np.array([len(x) for x in ids]) for ids in (ids_a, ids_b))
    a, b = np.concatenate(ids_a), np.concatenate(ids_b)
    stops_a, stops_b = np.cumsum(len_a), np.cumsum(len_b)
    cut_a, cut_b = shared_cuts(np.cumsum(size_a[a]), np.cumsum(size_b[b]), stops_a, stops_b)
    from_a, from_b = np.r_[0, cut_a[:-1]], np.r_[0, cut_b[:-1]]
    a_n, b_n = cut_a - from_a, cut_b - from_b
    text_of = np.searchsorted(stops_a, cut_a)

    # Ids in the order of the groups: a-tokens of a group, then its b-tokens.
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[cut_a - 1] = last_b[cut_b - 1] = 1
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.repeat(from_b, a_n)] = a + last_a * len(size_a)
    order[np.arange(len(b)) + np.repeat(cut_a, b_n)] = 2 * len(size_a) + b + last_b * len(size_b)
    at = 0
    for k, i in enumerate(used):
        upto = stops_a[k] + stops_b[k]
        out["sha"][i] = hashlib.sha256("".join(map(encoder.said.__getitem__, order[at:upto].tolist()))[:-1].encode()).hexdigest()
        at = upto

    out["n_a"][used], out["n_b"][used] = len_a, len_b
    out["n_groups"][used] = np.bincount(text_of, minlength=len(used))
    links = np.zeros(len(used), np.int64)
    np.add.at(links, text_of, a_n * b_n)
    out["n_links"][used] = links
    keys, times = _links(a, b, used[text_of], from_a, a_n, from_b, b_n, len(size_a), len(size_b))
    pair = keys % (len(size_a) * len(size_b))
    ends = np.searchsorted(keys, np.arange(n + 1) * (len(size_a) * len(size_b)))
    return out | {"a": pair // len(size_b), "b": pair % len(size_b), "times": times, "ends": ends}


FIELDS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, times array<long>"


def _align(batches, shared):
    schema = pa.schema([("doc_id", pa.int64()), *((k, pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()),
                        ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("times", pa.list_(pa.int64()))])
    encoder = _encoder(shared)
    for part, texts in text_chunks(batches, max_bytes=CHUNK_BYTES):
        x = align_texts(texts, encoder)
        ends = pa.array(x["ends"], pa.int32())
        yield batch_of(schema, [part.column(0), x["n_a"], x["n_b"], x["n_groups"], x["n_links"], x["sha"],
                                *(pa.ListArray.from_arrays(ends, pa.array(x[k].astype(t))) for k, t in (("a", np.int32), ("b", np.int32), ("times", np.int64)))])


def align_documents(docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256`` and the distinct linked id pairs ``a, b`` with their ``times``.

    One row per row of ``docs``: rows that repeat an id, or have none, are documents of their
    own.  A null or empty text, or one whose tokens' bytes are not blank + text, has no
    tokens: zeros, '' and empty arrays.  An empty table gives an empty result; other columns
    are ignored, whatever their names.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(lambda it: _align(it, shared), FIELDS)


# Corpus-wide counts --------------------------------------------------------------------

def _frequent_from(counts: DataFrame, most: int) -> int:
    """Smallest power of two that at most ``most`` pairs' counts reach (from a histogram of at most 64 rows)."""
    bins = counts.groupBy((F.length(F.bin("n_docs")) - 1).alias("bin")).count().collect()
    above, least = 0, 1 << (1 + max((r["bin"] for r in bins), default=0))
    for r in sorted(bins, key=lambda r: -r["bin"]):
        above += r["count"]
        if above > most:
            break
        least = 1 << r["bin"]
    return least


def link_statistics(docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """``align_documents`` without the pairs, and ``n_best, count_sum`` per document.

    A pair's count is the number of documents (rows) that link it; ``n_best`` counts links
    whose count is the highest of their a id, ties included; ``count_sum`` adds the counts of
    all links.  Texts are encoded once, their links staged in the shared folder.
    """
    aligned = stage_table(align_documents(docs, shared, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = aligned.select("row", F.inline(F.arrays_zip("a", "b", "times"))).withColumn("pair", F.shiftleft(F.col("a").cast("long"), 32) + F.col("b"))
    counts = stage_table(links.groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs")), "pair-counts")
    a_id = F.shiftright("pair", 32).alias("a")
    best = counts.groupBy(a_id).agg(F.max("n_docs").alias("most"))  # a row per vocabulary entry at most
    scored = (counts.withColumn("a", a_id).join(F.broadcast(best), "a")
              .select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")))

    least = _frequent_from(counts, frequent)
    known = F.broadcast(scored.filter(F.col("n_docs") >= least))  # at most ``frequent`` rows
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"), F.sum(F.col("times") * F.col("n_docs")).alias("count_sum")]
    common = links.join(known, "pair").groupBy("row").agg(*sums)
    rare = (links.join(known.select("pair"), "pair", "left_anti").select("pair", "row", "times")
            .join(scored.filter(F.col("n_docs") < least).hint("merge"), "pair").groupBy("row").agg(*sums))
    totals = common.unionByName(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return (aligned.drop("a", "b", "times").join(totals.hint("merge"), "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
