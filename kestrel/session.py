"""Session construction and the shared checkpoint folder.

Library code never sets cluster sizing; it only pins the settings that change
results (time zone, ANSI parsing) and leaves AQE on so joins and shuffles are
re-planned from measured sizes.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CKPT: dict[str, str] = {}
_STAGED: list[str] = []      # paths of the tables staged by this process
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING, _LOCK = [], threading.Lock()   # settings found by the first of the writes under way


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kestrel") -> SparkSession:
    """Build (or reuse) a session with the settings the operators rely on."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name a folder that the driver and all executors share;
    without it there is an error.  Only for a one-process master (``local``, ``local[...]``),
    as in tests, a temporary folder is made where it is unset.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = _CKPT.get(sc.applicationId) or tempfile.mkdtemp(prefix="kestrel-ckpt-")
        _CKPT[sc.applicationId] = d
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Materialise ``df`` to the shared checkpoint folder (reliable, survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Inside the block Spark removes a write's shuffle files once it has ended, not when the driver happens to collect its garbage."""
    with _LOCK:
        _WRITING.append(spark.conf.get(_CLEANUP, None) if not _WRITING else _WRITING[0])
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            before = _WRITING.pop()
            if not _WRITING and before is None:
                spark.conf.unset(_CLEANUP)
            elif not _WRITING:
                spark.conf.set(_CLEANUP, before)


def stage_table(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage as ``cut_lineage`` does, but keeps the rows columnar: later reads
    prune columns, push filters, and know the table's size for join planning.  The
    shuffle files of the write are gone when it ends.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/kestrel-{name}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    with _shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_staged(table) -> None:
    """Remove the files of a frame that ``stage_table`` returned; what was derived from it must be staged or written by then."""
    path = table._staged_path
    _STAGED.remove(path)
    _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def staged_run(spark: SparkSession):
    """Remove, at the end, the tables that were staged inside the ``with`` block.

    Frames that are still to be read must have been written or collected by then.
    """
    first = len(_STAGED)
    try:
        yield
    finally:
        paths, _STAGED[first:] = _STAGED[first:], []
        for path in paths:
            _delete(spark, path)
