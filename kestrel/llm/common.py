"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The blanks of the contracts.
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])

#: Hash buckets of keys that may be broadcast (a long each).
KEY_BUCKETS = 1 << 20

#: Most documents and text bytes that a Python helper holds at once, besides one text of any length.
CHUNK_DOCS, CHUNK_BYTES = 512, 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_buckets(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without most of those whose ``on`` columns are not in ``keys``, map-side.

    Keys grow with the input and are never broadcast; the hash buckets that they fall into
    are, ``KEY_BUCKETS`` numbers at most.  A join must follow.
    """
    bucket = F.pmod(F.xxhash64(*on), F.lit(KEY_BUCKETS))
    name = "_" * (1 + max(map(len, rows.columns)))
    return rows.withColumn(name, bucket).join(F.broadcast(keys.select(bucket.alias(name)).distinct()), name, "left_semi").drop(name)


def having_ids(rows: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id is among ``ids`` (one column of that name), whatever their number."""
    return in_buckets(rows, ids, [id_col]).join(ids.hint("merge"), id_col, "left_semi")


def train_fold(doc_id: Column) -> Column:
    """True for documents whose labels may be learnt from: crc32(doc_id as text) mod 4 is not 2 (a null id: False)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def text_chunks(batches, text: str = "text", max_bytes: int = CHUNK_BYTES):
    """Cut Arrow batches to slices of bounded documents and bytes: yields (slice, list of texts).

    Texts are ``bytes`` in UTF-8, null as empty; a slice has one text at least, so a very
    long one is handled alone.
    """
    for b in batches:
        col = b.column(b.schema.get_field_index(text))
        at = 0
        while at < b.num_rows:
            size, end = 0, at
            while end < b.num_rows and end - at < CHUNK_DOCS and size < max_bytes:
                v = col[end]
                size += len(v.as_buffer()) if v.is_valid else 0
                end += 1
            part = b.slice(at, end - at)
            texts = [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in col.slice(at, end - at)]
            yield part, texts
            at = end


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """Record batch from column values in the schema's order."""
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) if not isinstance(c, pa.Array) else c
                                       for c, f in zip(columns, schema)], schema=schema)
