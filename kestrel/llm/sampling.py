"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import stage_table

PRECISION = 1 << 30
MAX_VALUES = 100             # label values at most: with the rows of each they bound the id list


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_value: int,
                    id_col: str = "doc_id", text_col: str = "text", extra: dict | None = None) -> DataFrame:
    """``doc_id, text, label`` and the ``extra`` columns (name to column): about ``per_value`` documents at most of each label value.

    Ids are chosen by hash among all labels, from the counts of the values, so the choice is
    spread over the whole table and the id list is bounded: it is broadcast, and the
    documents are not shuffled.  Texts of any length are sampled, whole.  Rows with a null id,
    label or text are not sampled; of an id labelled twice with different values both rows are.
    """
    rows = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).alias("label")).dropna().distinct()
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().limit(MAX_VALUES + 1).collect()}
    if len(counts) > MAX_VALUES:
        raise ValueError(f"more than {MAX_VALUES} label values")
    share = F.lit(0)
    for value, n in sorted(counts.items()):
        share = F.when(F.col("label") == value, F.lit(int(min(1.0, 0.97 * per_value / n if n > per_value else 1.0) * PRECISION))).otherwise(share)
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(PRECISION)) < share)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        *[c.alias(name) for name, c in (extra or {}).items()])
    return texts.filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")


def within_bytes(features: DataFrame, size: Column, most: int) -> DataFrame:
    """Rows of a bounded sample (``doc_id, label`` and others) in an order of hashes until their sizes add up to ``most``; one row at least.

    The order has nothing to do with the sizes, so a text of any length can be among them.
    Only a hash and a size for each sampled row reach the driver.
    """
    rows = stage_table(features.withColumn("place", F.xxhash64("doc_id", "label", F.lit(17))), "sample")
    sizes = sorted(tuple(r) for r in rows.select("place", size.cast("long")).collect())
    total, last = 0, None
    for place, n in sizes:
        total += n
        if last is not None and total > most:
            break
        last = place
    return rows.filter(F.col("place") <= F.lit(last)).drop("place") if sizes else rows.drop("place")
