"""Line deduplication across documents.

1. Scan: per document its line count, the digest of its whole text, and for each long line
   a 128-bit key hash with its position; staged as one row per document, without text.
2. Frequent-items sketches over the hashes, one for each of a few hundred hash buckets, name very
   frequent lines; these are counted exactly with map-side combining and their winners (a
   bounded table) are broadcast.
3. All other hashes are range-partitioned with a secondary sort by document (largest first)
   and position; one streaming pass per partition marks every line after the first
   document's once the hash is seen in enough documents.
4. Marks are gathered per document and text to a compressed bitmap of lines to keep.
5. Texts that lose a line are found again by merging with the bitmaps, by id and digest; other
   texts are thinned out before, map-side, by the bounded set of hash buckets that the
   bitmaps fall into.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import SPACE_BYTES, batch_of, in_buckets, text_chunks
from kestrel.operators.lookup import frequent_hashes
from kestrel.session import stage_table

MIN_CHARS, MIN_DOCS = 20, 3
HEAVY_ROWS = 256             # a line that the sketches count below this is left to the ordinary sort

LINES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_lines", T.LongType()), T.StructField("sha", T.StringType()),
    T.StructField("lines", T.ArrayType(T.StructType([
        T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("pos", T.IntegerType())])))])


def line_key(line: bytes) -> bytes:
    """The line stripped of ASCII blanks at both ends, A-Z lower-cased."""
    return line.strip(SPACE_BYTES).lower()


def _code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def _hash_lines(batches, min_chars: int):
    line = pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("pos", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("sha", pa.string()), ("lines", pa.list_(line))])
    for part, texts in text_chunks(batches):
        counts, shas, hashes, places, ends = [], [], [], [], [0]
        for text in texts:
            lines = text.split(b"\n")
            for pos, raw in enumerate(lines):
                if len(raw) >= min_chars:
                    key = line_key(raw)
                    if len(key) >= min_chars and _code_points(key) >= min_chars:
                        hashes.append(xxhash.xxh3_128_digest(key))
                        places.append(pos)
            counts.append(len(lines))
            shas.append(hashlib.sha256(text).hexdigest())
            ends.append(len(places))
        h = np.frombuffer(b"".join(hashes), dtype=">i8").astype(np.int64).reshape(-1, 2)
        items = pa.StructArray.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(places, pa.int32())], fields=list(line))
        yield batch_of(schema, [part.column(0), counts, shas, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)])


def _stream_marks(batches, min_docs: int):
    """(doc_id, pos) of every line to drop, from rows sorted by hash, document (descending) and position;
    a fifth column, the row of the document, is handed on.

    Holds one Arrow batch, and of the last hash in it only the rows seen before it is known
    to be frequent: those of fewer than ``min_docs`` documents.
    """
    fields = [pa.field("doc_id", pa.int64()), pa.field("pos", pa.int32()), pa.field("row", pa.int64())]
    held = None
    frequent = None  # (h1, h2, first document) of an unfinished hash already known to be frequent

    def marks(rows: np.ndarray):
        """Lines to drop of complete hashes, and per row its hash's number and document rank."""
        new_hash = np.r_[True, (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])]
        new_doc = new_hash | np.r_[True, rows[1:, 2] != rows[:-1, 2]]
        group, start = np.cumsum(new_hash) - 1, np.flatnonzero(new_hash)
        rank = np.cumsum(new_doc) - np.cumsum(new_doc)[start][group]
        docs = np.maximum.reduceat(rank, start) + 1
        return rank, docs[group], start

    def dropped(rows: np.ndarray):
        return batch_of(pa.schema(fields[:rows.shape[1] - 2]), [c.astype(np.int32) if i == 1 else c for i, c in enumerate(rows[:, 2:].T)])

    for b in batches:
        rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
        if frequent is not None:
            same = (rows[:, 0] == frequent[0]) & (rows[:, 1] == frequent[1])
            drop = rows[same & (rows[:, 2] != frequent[2])]
            if len(drop):
                yield dropped(drop)
            rows = rows[~same]
            if len(rows):
                frequent = None
        rows = rows if held is None else np.concatenate([held, rows])
        held = rows[:0]
        if not len(rows):
            continue
        rank, docs, start = marks(rows)
        drop = rows[(rank > 0) & (docs >= min_docs)]
        if len(drop):
            yield dropped(drop)
        if docs[-1] >= min_docs:
            frequent = tuple(rows[start[-1], :3])
        else:
            held = rows[start[-1]:].copy()


def pack_bitmap(dropped, n_lines: int) -> bytes:
    """zlib-compressed little-endian bitmap, bit 1 for a line that stays."""
    keep = np.ones(n_lines, dtype=bool)
    keep[np.asarray(dropped, dtype=np.int64)] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6)


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Boolean array of the lines that stay."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines, bitorder="little").astype(bool)


def _pack(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("sha", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("keep_bitmap", pa.binary())])
    for b in batches:
        ids, shas, counts, drops = (b.column(i).to_pylist() for i in range(4))
        yield batch_of(schema, [ids, shas, counts, [len(d) for d in drops], [pack_bitmap(d, n) for d, n in zip(drops, counts)]])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS):
    """``(lines, bitmaps)``: per document ``doc_id, n_lines, sha`` and long-line hashes; and for
    each text of a document that loses lines ``doc_id, sha, n_lines, n_dropped, keep_bitmap``.

    Lines are split at ``\\n``; null or empty text is one empty line.  A line whose key (ends
    stripped of ASCII blanks, A-Z lower-cased) has ``min_chars`` code points and occurs in
    ``min_docs`` documents is kept only in the largest id that holds it, there wherever it
    stands.  Rows that repeat an id are one document: its lines are those of all the rows,
    and each row gets its own result (texts of one id are told apart by 64 bits of their digest's
    hash).  Rows with a null id count as one document that loses to every other and their
    lines are never dropped, as no result could name them.  An empty table gives empty results.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lines = stage_table(src.mapInArrow(lambda it: _hash_lines(it, min_chars), LINES), "lines")
    row = F.xxhash64("sha").alias("row")
    long = lines.select(F.coalesce("doc_id", F.lit(-(2 ** 63))).alias("doc"), row, F.inline("lines"))

    candidates = frequent_hashes(lines.select(F.explode("lines.h1").alias("h1")), "h1", HEAVY_ROWS)
    heavy = stage_table(
        long.join(F.broadcast(candidates), "h1", "left_semi")
        .groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.max("doc").alias("winner"), F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs), "heavy-lines")
    heavy_marks = (long.join(F.broadcast(heavy), ["h1", "h2"]).filter(F.col("doc") != F.col("winner"))
                   .select(F.col("doc").alias("doc_id"), "pos", "row"))
    light = long.join(F.broadcast(heavy.select("h1", "h2")), ["h1", "h2"], "left_anti").select("h1", "h2", "doc", "pos", "row")
    ordered = (light.repartitionByRange(F.col("h1"), F.col("h2"))
               .sortWithinPartitions("h1", "h2", F.desc("doc"), "pos"))
    light_marks = ordered.mapInArrow(lambda it: _stream_marks(it, min_docs), "doc_id long, pos int, row long")

    marks = (heavy_marks.unionByName(light_marks).filter(F.col("doc_id") != -(2 ** 63))
             .groupBy("doc_id", "row").agg(F.collect_set("pos").alias("dropped")))  # one text's lines
    sizes = lines.groupBy("doc_id", row).agg(F.max("sha").alias("sha"), F.max("n_lines").alias("n_lines"))
    bitmaps = sizes.join(marks, ["doc_id", "row"]).select("doc_id", "sha", "n_lines", F.sort_array("dropped").alias("dropped")).mapInArrow(
        _pack, "doc_id long, sha string, n_lines long, n_dropped long, keep_bitmap binary")
    return lines, stage_table(bitmaps, "keep-bitmaps")


def _apply(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("sha", pa.string()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])
    for part, texts in text_chunks(batches):
        bitmaps = part.column(3)
        out = []
        for text, bitmap in zip(texts, bitmaps):
            lines = text.split(b"\n")
            keep = unpack_bitmap(bitmap.as_py(), len(lines))
            out.append(b"\n".join(x for x, k in zip(lines, keep) if k))
        yield batch_of(schema, [part.column(0), part.column(1),
                                [x.decode("utf-8") for x in out], [hashlib.sha256(x).hexdigest() for x in out]])


def kept_texts(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, sha, kept_text, kept_sha256`` of the documents that lose lines (``sha``: of the whole text).

    The documents that lose a line grow with the input, so the bitmaps are never broadcast:
    texts and bitmaps are sorted and merged by id and digest at every size, texts in none of
    the bitmaps' hash buckets before that left out.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    near = in_buckets(src, bitmaps.select("doc_id", "sha"), ["doc_id", "sha"])
    return (near.join(bitmaps.select("doc_id", "sha", "keep_bitmap").hint("merge"), ["doc_id", "sha"])
            .mapInArrow(_apply, "doc_id long, sha string, kept_text string, kept_sha256 string"))


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """The query's rows: ``doc_id, n_lines, n_dropped, kept_sha256`` for every document."""
    lines, bitmaps = keep_bitmaps(docs)
    changed = kept_texts(docs, bitmaps).select("doc_id", "sha", "kept_sha256").distinct()
    return (lines.select("doc_id", "n_lines", "sha")
            .join(bitmaps.select("doc_id", "sha", "n_dropped"), ["doc_id", "sha"], "left").join(changed, ["doc_id", "sha"], "left")
            .select("doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                    F.coalesce("kept_sha256", "sha").alias("kept_sha256")))


SQL = r"""
WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM raw),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, pos, line, keep IS NOT NULL AND keep <> k.doc_id AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
