"""Experiment tracking as a run table.

A run is a set of event rows ``(experiment, experiment_tags, run_id, kind, key,
value, num_value, step, logged_at)`` appended to a parquet folder (on a shared
file system); the current state of a run is an aggregate over its events, so
concurrent writers only ever append.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = ("experiment string, experiment_tags map<string,string>, run_id string, kind string, key string, "
                "value string, num_value double, step bigint, logged_at timestamp_ntz")


class Run:
    """Collects params/metrics/tags/artifacts of one run; ``end()`` appends them once."""

    def __init__(self, spark: SparkSession, path: str, experiment: str, tags: dict[str, str] | None = None,
                 run_id: str | None = None):
        self.spark, self.path, self.experiment = spark, path, experiment
        self.exp_tags = dict(tags or {})
        self.run_id = run_id or uuid.uuid4().hex
        self.rows: list[tuple] = []
        self._step = 0

    def _add(self, kind, key, value, num=None, step=None):
        self._step += 1
        self.rows.append((self.experiment, self.exp_tags, self.run_id, kind, key,
                          None if value is None else str(value), None if num is None else float(num),
                          self._step if step is None else int(step), _dt.datetime.now()))

    def log_param(self, key, value):
        self._add("param", key, value)

    def log_params(self, params: dict):
        for k, v in params.items():
            self.log_param(k, v)

    def log_metric(self, key, value: float, step: int | None = None):
        self._add("metric", key, value, value, step)

    def set_tag(self, key, value):
        self._add("tag", key, value)

    def log_artifact(self, key, path: str):
        self._add("artifact", key, path)

    def end(self) -> str:
        df = self.spark.createDataFrame(self.rows, EVENT_SCHEMA)
        df.write.mode("append").parquet(self.path)
        self.rows = []
        return self.run_id

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.end()


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(path)


def runs_table(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    """One row per run: params, tags, artifacts (last value per key) and metrics (value at the
    highest step) as maps — ``search_runs`` over every experiment."""
    ev = read_events(spark, path)
    if experiment is not None:
        ev = ev.filter(F.col("experiment") == experiment)
    last = ev.groupBy("experiment", "run_id", "kind", "key").agg(
        F.max_by("value", "step").alias("value"), F.max_by("num_value", "step").alias("num_value"),
        F.max("logged_at").alias("logged_at"))

    def kv(kind, col):
        return F.map_from_entries(F.filter(F.collect_list(F.when(F.col("kind") == kind, F.struct("key", col))),
                                           lambda x: x.isNotNull()))

    return last.groupBy("experiment", "run_id").agg(
        kv("param", "value").alias("params"), kv("metric", "num_value").alias("metrics"),
        kv("tag", "value").alias("tags"), kv("artifact", "value").alias("artifacts"),
        F.max("logged_at").alias("last_logged"))


def best_run(runs: DataFrame, metric: str, lowest: bool = True) -> DataFrame:
    """The run with the best value of ``metric`` per experiment."""
    m = F.element_at("metrics", metric)
    key = m if lowest else -m
    return runs.filter(m.isNotNull()).groupBy("experiment").agg(F.min_by("run_id", key).alias("run_id"),
                                                                (F.min(key) if lowest else -F.min(key)).alias(metric))


def artifact_path(runs: DataFrame, run_id: str, key: str) -> str:
    """Path of an artifact logged by a run (one value to the driver)."""
    r = runs.filter(F.col("run_id") == run_id).select(F.element_at("artifacts", key).alias("p")).first()
    return None if r is None else r["p"]
