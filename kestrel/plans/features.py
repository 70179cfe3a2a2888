"""Queries for encoders, scalers, splits and folds."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kestrel.operators import features as fe
from kestrel.plans.registry import register
from kestrel.sources.tables import lineitem_with_gaps, load

R = 6


@register("part_label_encoding", sql="""
SELECT p_partkey, p_brand, p_type,
       CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand_id,
       CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS p_type_id
FROM part
""")
def part_label_encoding(spark, sf):
    """Label ids 0..k−1 in sorted value order for several columns, one dictionary."""
    p = load(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    d = fe.fit_label_dictionary(p, ["p_brand", "p_type"])
    return d.transform(p)


@register("status_frequency_index", sql="""
WITH c AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1),
r AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS idx FROM c),
s AS (SELECT o_orderstatus AS v, count(*) AS n FROM orders GROUP BY 1),
t AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS idx FROM s)
SELECT o_orderkey, CAST(r.idx AS DOUBLE) AS priority_idx,
       CAST(t.idx AS INTEGER) AS status_hot
FROM orders JOIN r ON o_orderpriority = r.v JOIN t ON o_orderstatus = t.v
""")
def status_frequency_index(spark, sf):
    """Frequency-ordered label index (most frequent → 0) and one-hot of it.
    The indexer keeps a slot for unseen labels, which is the slot the encoder drops,
    so every seen label gets its own hot position."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    idx = fe.frequency_indexer(["o_orderpriority", "o_orderstatus"])
    ohe = fe.one_hot(["o_orderstatus_idx"])
    model = Pipeline(stages=[idx, ohe]).fit(o)
    out = model.transform(o)
    arr = vector_to_array("o_orderstatus_idx_vec")
    hot = F.array_position(arr, 1.0)
    return out.select("o_orderkey", F.col("o_orderpriority_idx").alias("priority_idx"),
                      F.when(hot > 0, (hot - 1).cast("int")).alias("status_hot"))


@register("minmax_scale_roundtrip", sql="""
WITH s AS (SELECT min(c_acctbal) AS lo1, max(c_acctbal) AS hi1, min(c_nationkey) AS lo2, max(c_nationkey) AS hi2 FROM customer)
SELECT c_custkey, round((c_acctbal - lo1) / (hi1 - lo1), 6) AS acct_scaled,
       round((c_nationkey - lo2) / (hi2 - lo2), 6) AS nation_scaled,
       round(c_acctbal, 6) AS acct_back
FROM customer, s
""")
def minmax_scale_roundtrip(spark, sf):
    """Min-max scaling fitted once, applied, then inverted back to units."""
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    fit = fe.fit_min_max(c, ["c_acctbal", "c_nationkey"])
    s = fit.transform(c.withColumns({"acct_scaled": F.col("c_acctbal"), "nation_scaled": F.col("c_nationkey")})
                      .drop("c_acctbal", "c_nationkey")
                      .withColumnsRenamed({"acct_scaled": "c_acctbal", "nation_scaled": "c_nationkey"}))
    s = s.withColumnsRenamed({"c_acctbal": "acct_scaled", "c_nationkey": "nation_scaled"})
    back = fit.inverse(s.withColumn("acct_back", F.col("acct_scaled")), {"acct_back": "c_acctbal"})
    return back.select("c_custkey", F.round("acct_scaled", R).alias("acct_scaled"),
                       F.round("nation_scaled", R).alias("nation_scaled"), F.round("acct_back", R).alias("acct_back"))


@register("hash_split_flags", sql="""
SELECT o_orderkey, (('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 10000) < 2000 AS is_test
FROM orders
""")
def hash_split_flags(spark, sf):
    """Repeatable 80/20 split by key hash."""
    o = load(spark, sf, "orders").select("o_orderkey")
    return fe.split_by_hash(o, "o_orderkey", 0.2, seed=42)


@register("stratified_split_counts", sql="""
WITH b AS (SELECT vec_id, label, ('0x' || substr(md5('7:' || CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT % 10000 AS h FROM embeddings),
c AS (SELECT label, h, count(*) AS n FROM b GROUP BY 1, 2),
cum AS (SELECT label, h, sum(n) OVER (PARTITION BY label ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs,
               sum(n) OVER (PARTITION BY label) AS tot FROM c),
cut AS (SELECT label, min(h) AS cut FROM cum WHERE cs >= 0.25 * tot GROUP BY 1)
SELECT b.label, coalesce(b.h <= cut.cut, false) AS is_test, CAST(count(*) AS BIGINT) AS n
FROM b LEFT JOIN cut ON b.label = cut.label GROUP BY 1, 2
""")
def stratified_split_counts(spark, sf):
    """Stratified 75/25 split keeping each label's share (F10 stratified)."""
    e = load(spark, sf, "embeddings").select("vec_id", "label")
    s = fe.split_stratified(e, "vec_id", "label", 0.25, seed=7)
    return s.groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))


@register("contiguous_folds", sql="""
SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders
""")
def contiguous_folds(spark, sf):
    """Contiguous 7-fold assignment in key order (k-fold without shuffle, M2)."""
    o = load(spark, sf, "orders").select("o_orderkey")
    return fe.assign_folds(o, "o_orderkey", 7)


@register("assembled_features", sql="""
SELECT l_orderkey, nullif(l_linenumber, 3) AS l_linenumber, round(l_quantity, 6) AS f0, round(l_discount, 6) AS f1, round(l_tax, 6) AS f2
FROM lineitem WHERE l_orderkey % 7 <> 0
""")
def assembled_features(spark, sf):
    """Vector assembly with invalid (NULL) rows skipped (F1 replacing the null guard)."""
    g = lineitem_with_gaps(load(spark, sf, "lineitem"))
    v = fe.assemble(["l_quantity", "l_discount", "l_tax"]).transform(g)
    a = vector_to_array("features")
    return v.select("l_orderkey", "l_linenumber", *[F.round(a[i], R).alias(f"f{i}") for i in range(3)])
