"""Lookup join that splits off frequent keys.

A table with one row per key is joined to rows of which some keys may hold a large share.
Frequent keys are found by frequent-items sketches, their few table rows broadcast and their
rows resolved where they are; only rows of the other keys are shuffled to the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import stage_table

#: Frequent-items sketches: their number, hashes each may name, and counters of each.
SKETCHES, PER_SKETCH, TRACKED = 256, 64, 2048
FREQUENT_ROWS = 1000         # a key that the sketches count below this is left to the shuffle


def frequent_hashes(rows: DataFrame, hash_col: str, least: int, buckets: int = SKETCHES, per_bucket: int = PER_SKETCH,
                    tracked: int = TRACKED) -> DataFrame:
    """``hash_col``: hashes (longs) that a frequent-items sketch counts ``least`` times or more; ``buckets * per_bucket`` rows at most.

    A hash falls into one bucket only, and every bucket has a sketch of its own (``approx_top_k``,
    Misra-Gries family), so sketches of all tasks are merged by as many tasks as there are
    buckets.  In a bucket of n rows a hash above 1.4 * n / ``tracked`` is among those counted, and
    of these the ``per_bucket`` most frequent are returned: what is not returned has at most
    max(``least``, 1.4 * n / ``tracked``, n / (``per_bucket`` + 1)) rows.  Nulls are left out.
    """
    top = (rows.filter(F.col(hash_col).isNotNull()).groupBy(F.pmod(F.xxhash64(hash_col), F.lit(buckets)).alias("bucket"))
           .agg(F.expr(f"approx_top_k({hash_col}, {per_bucket}, {tracked})").alias("top")))
    return top.select(F.explode("top").alias("t")).filter(F.col("t.count") >= least).select(F.col("t.item").alias(hash_col))


def lookup_join(rows: DataFrame, table: DataFrame, on: str, how: str = "inner", least: int = FREQUENT_ROWS, **sketch) -> DataFrame:
    """``rows`` joined (``inner`` or ``left``) with ``table``, which has one row for a key ``on`` at most.

    Whatever share of the rows one key holds, its rows are not brought together: at most
    ``SKETCHES * PER_SKETCH`` table rows are broadcast, and a key that is shuffled has no more
    rows than ``frequent_hashes`` says.  Null keys match nothing; as frequent ones they are
    kept where they are.  ``rows`` is read three times: stage it where it is costly.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    h = "_" * (1 + max(map(len, [*rows.columns, *table.columns])))  # longer than any column's name
    rows, keyed = rows.withColumn(h, F.xxhash64(on)), table.withColumn(h, F.xxhash64(on))
    hot = F.broadcast(stage_table(frequent_hashes(rows.filter(F.col(on).isNotNull()).select(h), h, least, **sketch), "frequent-keys"))
    here = rows.filter(F.col(on).isNotNull()).join(hot, h, "left_semi").drop(h).join(F.broadcast(keyed.join(hot, h, "left_semi").drop(h)), on, how)
    there = rows.filter(F.col(on).isNotNull()).join(hot, h, "left_anti").drop(h).join(table, on, how)
    out = here.unionByName(there)
    if how == "left":
        out = out.unionByName(rows.filter(F.col(on).isNull()).drop(h), allowMissingColumns=True)
    return out
