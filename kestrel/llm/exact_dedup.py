"""Exact deduplication by a heavy-hitter split (DataFrame functions only).

1. Scan: one digest row ``(doc_id, sha)`` per document, staged in the shared folder; texts
   are read once.
2. Misra-Gries type frequent-items sketches over the digests' hashes (``approx_top_k``, one for
   each of a few hundred hash buckets, merged by as many tasks) name a bounded number of
   candidates (``lookup.frequent_hashes``).
3. Candidates are verified exactly (counted, winner found) with map-side combining, and
   those with at least ``heavy_rows`` rows become the winners table, which is broadcast.
4. Documents of a winner get their row that stays map-side, without a shuffle.  The other
   digests are shuffled; the sketches bound how many rows one of them can hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.lookup import frequent_hashes
from kestrel.session import stage_table

HEAVY_ROWS = 64         # a verified digest below this is left to the ordinary shuffle


def _digest(text_col: str, normalise):
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.sha2(normalise(text) if normalise else text, 256)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=None,
                     heavy_rows: int = HEAVY_ROWS, **sketch) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their digests (SHA-256 of the UTF-8 text after ``normalise``, by
    default unchanged) are equal.  Null text counts as empty.  The largest id of a group
    stays; a null id loses to any other.  Rows that repeat an id are separate rows of the
    group, and all rows with the staying id are kept.  An empty table gives an empty
    result; columns besides the two named are ignored, whatever their names.  ``sketch``:
    ``lookup.frequent_hashes``' sizes; they bound the winners, 16,384 by default.
    """
    rows = stage_table(docs.select(F.col(id_col).alias("doc_id"), _digest(text_col, normalise).alias("text_sha256")), "digests")

    hashed = rows.withColumn("h", F.xxhash64("text_sha256"))
    candidates = frequent_hashes(hashed, "h", heavy_rows, **sketch)
    winners = stage_table(
        hashed.join(F.broadcast(candidates), "h", "left_semi")
        .groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") >= heavy_rows), "winners")

    heavy = rows.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    rest = (rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
            .withColumns({"keep_id": F.max("doc_id").over(group), "group_size": F.count(F.lit(1)).over(group)}))
    out = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"]
    return heavy.select(*out).unionByName(rest.select(*out))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=None, **how) -> DataFrame:
    """``docs`` without the rows that lose to an equal text; all columns stay as they are.

    A row is named by its id and digest, as rows that repeat an id may hold other texts.  The
    rows to drop grow with the input, so they are merged with the documents, never
    broadcast.  Rows with a null id are all kept.
    """
    sha = "_" * (1 + max(map(len, docs.columns)))  # longer than any column's name, so it is none of them
    lost = (exact_duplicates(docs, id_col, text_col, normalise, **how).filter("NOT kept")
            .select(F.col("doc_id").alias(id_col), F.col("text_sha256").alias(sha)))
    return docs.withColumn(sha, _digest(text_col, normalise)).join(lost.hint("merge"), [id_col, sha], "left_anti").drop(sha)


# Query ---------------------------------------------------------------------------------

SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY sha256(coalesce(text, '')))
"""
