"""Benchmark decontamination by a broadcast set of word windows.

The benchmark's distinct windows (``WINDOW`` consecutive words; a shorter item is one
window) are counted first.  Up to ``max_windows`` of them form one broadcast block; a
larger benchmark is cut to several blocks by window hash, scanned for in turn over the same
rows, which carry the hits of the blocks before.  A scan rolls a 64-bit hash over the word hashes, looks it
up in a bit table, and verifies what remains by comparing the words themselves.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import batch_of, text_chunks
from kestrel.session import stage_table

WINDOW = 13
MAX_WINDOWS = 200_000      # windows broadcast at once: about 100 bytes each
CHAINED = 4                # blocks a task scans for at once; rows are staged in between
MIN_SHARE = 20             # contaminated: 20 * n_hit >= n_words
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")   # bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing
# A-Z to a-z, word bytes kept, every other byte to a blank.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
TABLE_BITS = 22
BASE = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2**64
SCAN = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                     T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
                     T.StructField("items", T.ArrayType(T.StringType()))])


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text."""
    return text.translate(TO_WORDS).split()


class WordHashes(dict):
    """Word to 64-bit hash, filled as words are met; emptied when it grows past its bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def hash_words(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def rolled(words: np.ndarray, length: int, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Hash of every run of ``length`` words, the same wherever the run stands."""
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=sums[1:])
    return (sums[length:] - sums[:-length]) * down[:len(words) - length + 1]


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _windows(batches, length: int):
    schema = pa.schema([("item", pa.string()), ("size", pa.int32()), ("window", pa.binary())])
    for part, texts in text_chunks(batches):
        rows = []
        for item, text in zip(part.column(0).to_pylist(), texts):
            words = words_of(text)
            size = min(length, len(words))
            rows += [(item, size, b" ".join(words[i:i + size])) for i in range(len(words) - size + 1) if size]
        yield batch_of(schema, [list(c) for c in zip(*rows)] or [[], [], []])


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", length: int = WINDOW) -> DataFrame:
    """``window, size, items``: the distinct windows of the benchmark and the items that hold them."""
    src = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return (src.mapInArrow(lambda it: _windows(it, length), "item string, size int, window binary")
            .groupBy("window", "size").agg(F.collect_set("item").alias("items")))


def _block(rows) -> dict:
    """Lookup structures of one block: window bytes to items, the sizes, and a table of hash buckets."""
    windows = {bytes(r["window"]): tuple(r["items"]) for r in rows}
    sizes, table, hashes = sorted({r["size"] for r in rows}), np.zeros(1 << TABLE_BITS, bool), WordHashes()
    up, down = powers(max(sizes, default=1))
    for w in windows:
        words = hash_words(w.split(b" "), hashes)
        table[_bucket(rolled(words, len(words), up, down))] = True
    return {"windows": windows, "sizes": sizes, "table": np.packbits(table)}


def _scan_texts(texts: list[bytes], block: dict, hashes: WordHashes, table: np.ndarray):
    """Per text: its number of words, a mask of those inside an occurrence, and the items found (None: no occurrence)."""
    per_text = [words_of(t) for t in texts]
    ends = np.cumsum([len(w) for w in per_text])
    words = [w for ws in per_text for w in ws]
    hashed = hash_words(words, hashes)
    up, down = powers(len(words))
    hit = np.zeros(len(words) + 1, np.int64)
    found: dict[int, set] = {}
    for size in block["sizes"]:
        if size > len(words):
            continue
        places = np.flatnonzero(table[_bucket(rolled(hashed, size, up, down))])
        owner = np.searchsorted(ends, places, side="right")
        inside = places + size <= ends[owner]
        for i, k in zip(places[inside].tolist(), owner[inside].tolist()):
            items = block["windows"].get(b" ".join(words[i:i + size]))
            if items is not None:
                hit[i] += 1
                hit[i + size] -= 1
                found.setdefault(k, set()).update(items)
    mask = np.cumsum(hit[:-1]) > 0
    return [(len(ws), mask[end - len(ws):end], found.get(k)) for k, (ws, end) in enumerate(zip(per_text, ends.tolist()))]


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def broadcast_blocks(benchmark: DataFrame, max_windows: int = MAX_WINDOWS, **columns):
    """Yield broadcasts of the benchmark's windows, each of ``max_windows`` on average at most.

    One is built and sent at a time; a task holds ``CHAINED`` of them at most.
    """
    spark = benchmark.sparkSession
    windows = benchmark_windows(benchmark, **columns)
    blocks = max(1, -(-windows.count() // max_windows))
    for k in range(blocks):
        rows = windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).collect()
        yield blocks, spark.sparkContext.broadcast(_block(rows))


def _marks(batches, block, text_col: str, first: bool):
    """Per slice its own columns, its texts, and per text the number of words, the spans and the items of
    this block and of those before it (the last two columns, unless it is the ``first``)."""
    block, hashes = block.value, WordHashes()
    table = np.unpackbits(block["table"]).astype(bool)
    for part, texts in text_chunks(batches, text_col):
        own = part if first else part.select(list(range(part.num_columns - 2)))
        before = [[()] * len(texts)] * 2 if first else [c.to_pylist() for c in part.columns[-2:]]
        marks = []
        for (count, mask, found), spans, items in zip(_scan_texts(texts, block, hashes, table), *before):
            for s in spans:
                mask[s["start"]:s["end"]] = True
            marks.append((count, runs(mask) if spans or found is not None else [], sorted({*items, *(found or ())})))
        yield own, texts, marks


def _columns(marks) -> list[pa.Array]:
    """Spans and items of one slice."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    spans = [[{"start": a, "end": b} for a, b in m[1]] for m in marks]
    return [pa.array(spans, span), pa.array([m[2] for m in marks], pa.list_(pa.string()))]


def _carry(marked, names: list[str]):
    """The slices' own columns, untouched, with spans and items behind them."""
    for own, _, marks in marked:
        yield pa.RecordBatch.from_arrays([*own.columns, *_columns(marks)], names=names)


def _chain(src: DataFrame, text_col: str, finish, schema: T.StructType, benchmark: DataFrame, max_windows: int, columns: dict) -> DataFrame:
    """``finish`` over the rows of ``src`` and their marks of all blocks.

    Every block scans the same rows with their untouched texts; the marks grow in two more
    columns.  Rows are staged after every ``CHAINED`` blocks, as each block is a Python worker of the task.
    """
    free = "_" * (1 + max(map(len, src.columns)))  # longer than any column's name, so it is none of them
    carried = T.StructType([*src.schema.fields, *(T.StructField(free + f.name, f.dataType) for f in SCAN.fields[2:])])
    out = src
    for k, (blocks, block) in enumerate(broadcast_blocks(benchmark, max_windows, **columns), 1):
        if k == blocks:
            return out.mapInArrow(lambda it: finish(_marks(it, block, text_col, blocks == 1)), schema)
        out = out.mapInArrow(lambda it, block=block, first=k == 1: _carry(_marks(it, block, text_col, first), carried.names), carried)
        if k % CHAINED == 0:
            out = stage_table(out, "marked")


def _scan(marked):
    for own, _, marks in marked:
        yield pa.RecordBatch.from_arrays([own.column(0), pa.array([m[0] for m in marks], pa.int64()), *_columns(marks)], names=SCAN.names)


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", length: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per document ``doc_id, n_words, spans, items``: runs of words inside occurrences of benchmark windows.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null and
    empty texts have none.  Items without words match nothing; an item with a null id marks
    words but is not listed; equal items are all listed.  With an empty benchmark nothing is
    hit; an empty document table gives an empty result; other columns are ignored.  Rows that
    repeat an id and rows with a null id are separate rows, in one block and in several.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _chain(src, "text", _scan, SCAN, benchmark, max_windows, dict(id_col=item_col, text_col=item_text_col, length=length))


def verdicts(scanned: DataFrame) -> DataFrame:
    """Counts, item digest and the contamination rule on the rows of ``scan``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return (scanned.withColumn("n_hit", n_hit)
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (MIN_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")))


def remove_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between those words."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, text[at:]])


def _clean(marked, text_col: str, mode: str):
    for part, texts, marks in marked:
        if mode == "documents":
            hits = [sum(b - a for a, b in spans) for _, spans, _ in marks]
            yield part.filter(pa.array([not (h > 0 and MIN_SHARE * h >= m[0]) for h, m in zip(hits, marks)]))
        elif any(m[1] for m in marks):
            at = part.schema.get_field_index(text_col)
            old = part.column(at)
            new = [remove_spans(t, m[1]).decode("utf-8", "replace") if m[1] else o.as_py() for t, m, o in zip(texts, marks, old)]
            yield part.set_column(at, part.schema.field(at), pa.array(new, old.type))
        else:
            yield part


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", length: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` without contaminated documents (``mode="documents"``) or without hit spans (``"spans"``).

    All columns stay.  One pass and no shuffle while the benchmark fits one block.  Beyond
    that, every block scans the same rows with their untouched texts; each row is judged, or
    the union of its spans removed, once at the end, whatever its id.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(mode)
    return _chain(docs, text_col, lambda marked: _clean(marked, text_col, mode), docs.schema, benchmark, max_windows,
                  dict(id_col=item_col, text_col=item_text_col, length=length))


SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, CAST(least(13, len(w)) AS BIGINT) AS size FROM bw WHERE len(w) > 0),
bwin AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
         FROM (SELECT item_id, w, size, unnest(range(1, CAST(len(w) AS BIGINT) - size + 2)) AS i FROM bs)),
sizes AS (SELECT DISTINCT size FROM bwin),
dwin AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
         FROM (SELECT doc_id, w, size, unnest(range(1, CAST(len(w) AS BIGINT) - size + 2)) AS i FROM dw, sizes WHERE len(w) >= size)),
h AS (SELECT doc_id, i, dwin.size, item_id FROM dwin JOIN bwin ON dwin.win = bwin.win AND dwin.size = bwin.size),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY 1),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id
"""
