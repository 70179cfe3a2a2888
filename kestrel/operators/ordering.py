"""Global row positions without a single-partition window.

``global_index`` sorts with range partitioning (many tasks), numbers rows
inside each sorted partition, and adds the row counts of all earlier
partitions (a table with one row per partition, so its broadcast has a proven
bound).  The sorted, tagged frame is checkpointed to the shared checkpoint
folder first, so the per-partition counts and the final numbering always see
the same partition assignment, even when executors are lost and stages rerun.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import cut_lineage

_PID, _MID = "__pid", "__mid"


def global_index(df: DataFrame, order_by: list, index_col: str = "idx") -> DataFrame:
    """Add a 0-based position ``index_col`` in the order ``order_by`` (ties in arbitrary order).

    Works at any size: one range-partitioned sort, one checkpoint, one small
    aggregate; no window without ``partitionBy``.
    """
    tagged = df.orderBy(*order_by).select("*", F.spark_partition_id().alias(_PID),
                                          F.monotonically_increasing_id().alias(_MID))
    tagged = cut_lineage(tagged)
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: the cumulative window is over a table bounded by the partition count
    offsets = counts.select(_PID, F.coalesce(F.sum("__n").over(
        Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    pos = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), _PID)
                  .withColumn(index_col, F.col("__off") + pos)
                  .drop(_PID, _MID, "__off"))
