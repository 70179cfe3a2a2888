"""Connected components of an edge table by randomised contraction.

Each round every node points to its neighbour (or itself) with the smallest hash under the
round's seed; edges are rewritten to those pointers, loops and repeats dropped.  A round
removes a constant share of the nodes on average, also from long chains, and a hub costs
one row per neighbour: minima are combined map-side, and the rewriting is a join whose
sides are staged tables, so Spark can broadcast the small one or split a skewed key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import stage_table

MAX_ROUNDS = 100


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component's name is its smallest node.

    Loops and repeated edges are allowed, rows with a null end are ignored; no edges give no rows.
    """
    edges = stage_table(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    labels = None
    for seed in range(MAX_ROUNDS):
        if edges.isEmpty():
            break
        ends = edges.select("a", "b").union(edges.select("b", "a")).union(edges.select("a", "a")).union(edges.select("b", "b"))
        point = stage_table(ends.groupBy("a").agg(F.min_by("b", F.xxhash64(F.lit(seed), "b")).alias("to"))
                            .withColumnRenamed("a", "node"), "pointers")
        to_a, to_b = point.toDF("a", "to_a"), point.toDF("b", "to_b")
        edges = stage_table(edges.join(to_a, "a").join(to_b, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
                            .filter("a <> b").distinct(), "edges")
        if labels is None:
            labels = point
        else:
            labels = stage_table(labels.join(point.toDF("to", "next"), "to", "left")
                                 .select("node", F.coalesce("next", "to").alias("to")), "labels")
    else:
        raise RuntimeError(f"components not contracted within {MAX_ROUNDS} rounds")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = stage_table(labels.groupBy("to").agg(F.min("node").alias("component")), "smallest")
    return labels.join(smallest, "to").select("node", "component")
