"""Parquet tables of a scale-factor folder and the trip-text view derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.dates import HYPHEN_FORMAT, SLASH_FORMAT

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of one table; filters and projections push into the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trip_text_view(orders: DataFrame) -> DataFrame:
    """Render orders as raw trip rows the way a CSV export writes them.

    ``pickup_text`` carries ``o_orderdate`` plus ``o_orderkey % 24`` hours, in
    the hyphen format for even keys and the 12-hour slash format for odd keys;
    ``total_amount_text`` is the price with thousands separators.
    """
    ts = F.expr("timestampadd(HOUR, o_orderkey % 24, o_orderdate)")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(ts, HYPHEN_FORMAT)) \
            .otherwise(F.date_format(ts, SLASH_FORMAT))
    return orders.select(F.col("o_orderkey").alias("trip_id"),
                         text.alias("pickup_text"),
                         F.format_number("o_totalprice", 2).alias("total_amount_text"),
                         F.col("o_orderpriority").alias("category"))


def coordinates_view(embeddings: DataFrame) -> DataFrame:
    """Pseudo pickup/drop-off coordinates from the first four embedding components."""
    e = F.col("embedding")
    return embeddings.select(
        "vec_id",
        (e[0].cast("double") * 90.0).alias("pickup_latitude"),
        (e[1].cast("double") * 180.0).alias("pickup_longitude"),
        (e[2].cast("double") * 90.0).alias("dropoff_latitude"),
        (e[3].cast("double") * 180.0).alias("dropoff_longitude"))


def lineitem_with_gaps(lineitem: DataFrame) -> DataFrame:
    """Lineitem with NULLs injected by fixed rules (the test tables hold none):
    line number 3 → NULL, discount NULL for order keys divisible by 7, return flag
    NULL for order keys divisible by 5."""
    k = F.col("l_orderkey")
    return lineitem.withColumns({
        "l_linenumber": F.nullif(F.col("l_linenumber"), F.lit(3)),
        "l_discount": F.when(k % 7 != 0, F.col("l_discount")),
        "l_returnflag": F.when(k % 5 != 0, F.col("l_returnflag")),
    })
