"""Streaming use of the row-level operators.

The column functions and fitted ``PipelineModel.transform`` are stateless
expressions, so the same code runs on a streaming DataFrame: a file stream of
parquet tables is parsed, flagged and scored micro-batch by micro-batch, and
written to a sink with exactly-once file output and a checkpoint in the
shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel import functions as kf
from kestrel.session import checkpoint_dir
from kestrel.sources.tables import trip_text_view


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    """A parquet table as a file stream (schema taken from the batch table, never inferred per file)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir))


def trip_features(orders: DataFrame) -> DataFrame:
    """The trip-text features of the flagship query, valid for batch and streaming frames."""
    t = trip_text_view(orders)
    ts = kf.parse_trip_ts("pickup_text")
    return t.select("trip_id", ts.alias("ts"), kf.peak_time(ts).alias("peak_time"),
                    kf.is_weekend(ts).alias("weekend"), kf.money_to_double("total_amount_text").alias("amount"))


def run_trip_feature_stream(spark: SparkSession, sf_dir: str, out_path: str, query_name: str = "trip_features"):
    """Process every available file of the orders stream into parquet at ``out_path``
    (trigger ``availableNow``), checkpointing progress in the shared checkpoint folder."""
    feats = trip_features(stream_table(spark, sf_dir, "orders"))
    ckpt = checkpoint_dir(spark).rstrip("/") + f"/stream-{query_name}"
    q = (feats.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).queryName(query_name).start())
    q.awaitTermination()
    return q
