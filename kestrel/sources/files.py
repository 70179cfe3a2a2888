"""File sources and sinks: delimited text with explicit schemas, whole texts, pair files,
tagged corpora, literal and generated frames, distributed writers, model persistence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.dates import parse_date


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
                   header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """CSV/TSV with a declared schema (no inference pass); any Hadoop file system URI."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("encoding", encoding).option("mode", "PERMISSIVE").csv(path))


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``(path, text)`` with line breaks joined by single blanks."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.input_file_name().alias("path"),
                     F.trim(F.regexp_replace("value", r"\r?\n", " ")).alias("text"))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``input<TAB>output`` file with a header row; CR stripped."""
    schema = T.StructType([T.StructField("input", T.StringType()), T.StructField("output", T.StringType())])
    df = read_delimited(spark, path, schema, sep="\t", header=True)
    return df.select(F.trim(F.rtrim(F.regexp_replace("input", "\r", ""))).alias("input"),
                     F.trim(F.regexp_replace("output", "\r", "")).alias("output")) \
             .dropna(subset=["input", "output"])


def read_tagged(spark: SparkSession, path: str) -> DataFrame:
    """``word/tag`` token files → ``(file, line, pos, word, tag)``; the last ``/`` splits."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"),
                                         F.monotonically_increasing_id().alias("line"),
                                         F.col("value"))
    toks = lines.select("file", "line", F.posexplode(F.split(F.trim("value"), r"\s+")).alias("pos", "tok")) \
                .filter(F.col("tok") != "")
    return toks.select("file", "line", "pos",
                       F.regexp_extract("tok", r"^(.*)/([^/]*)$", 1).alias("word"),
                       F.lower(F.regexp_extract("tok", r"^(.*)/([^/]*)$", 2)).alias("tag"))


def literal_frame(spark: SparkSession, rows, schema) -> DataFrame:
    """A frame from a few literal rows."""
    return spark.createDataFrame(rows, schema)


def read_dated_series(spark: SparkSession, path: str, date_col: str, value_col: str, sep: str = ",") -> DataFrame:
    """``(ts, value)`` from a delimited file whose dates are ISO text; rows without a date are dropped."""
    raw = read_delimited(spark, path, f"{date_col} string, {value_col} double", sep=sep)
    return raw.select(parse_date(date_col).cast("timestamp_ntz").alias("ts"), F.col(value_col).alias("value")).dropna(subset=["ts"])


def synthetic_linear(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """``n`` rows of x1..x3 ~ U(0,1) and ``x4 = 2*x1 + 3*x2 + x3``; deterministic by seed
    and partition count (generated in parallel, nothing on the driver)."""
    base = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(n)
    df = base.select("id", F.rand(seed).alias("x1"), F.rand(seed + 1).alias("x2"), F.rand(seed + 2).alias("x3"))
    return df.withColumn("x4", 2 * F.col("x1") + 3 * F.col("x2") + F.col("x3"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Distributed write (never through the driver); CSV gets a header row."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def profile_shape(df: DataFrame) -> DataFrame:
    """One row ``(n_rows, n_cols)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


