import os
import subprocess
import sys
from types import SimpleNamespace

import __spark_entry__ as E
import pytest

from kestrel import session

from tests.conftest import SF


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["weekend", "peak_time", "n_trips", "mean_amount", "median_amount"]
    assert len(rows) > 0 and sum(r["n_trips"] for r in rows) > 0


def test_every_oracle_has_a_query():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 60


def test_cheap_queries_run_on_smallest_scale(spark):
    q = E.queries()
    for name in ("trip_text_features", "lineitem_describe", "monthly_rolling_stats", "document_tfidf",
                 "chat_pair_encoding", "contiguous_folds"):
        assert q[name](spark, SF).count() >= 0


def test_python_workers_need_no_copy_of_the_package():
    """The queries with Python helpers run from another folder, without PYTHONPATH."""
    names = ["document_stem_counts", "document_lemma_counts", "monthly_partial_autocorrelation", "monthly_augmented_dickey_fuller",
             "arima_order_search", "arima_fitted_vs_actual", "arima_monthly_forecast"]
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
import __spark_entry__ as E
from kestrel.session import get_session
spark = get_session("local[2]", 4)
print("ROWS", *[E.queries()[n](spark, {SF!r}).count() for n in {names!r}])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd="/", env=env, capture_output=True, text=True, timeout=600)
    rows = run.stdout.rpartition("ROWS")[2].split()
    assert run.returncode == 0 and len(rows) == len(names) and all(int(n) > 0 for n in rows), run.stderr[-2000:]


def test_run_table_is_repeatable(spark):
    a, b = ([tuple(r) for r in E.queries()["experiment_run_table"](spark, SF).collect()] for _ in range(2))
    assert a == b and len(a) == 1


def test_entry_loads_without_a_helper_library():
    """Only the training-data queries need xxhash; the others load without it."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
sys.modules["xxhash"] = None
import __spark_entry__ as E
names = E.queries()
print("LOADED", len(names), any(n.startswith("op") and n[2:3].isdigit() for n in names), set(E.oracle_sql()) <= set(names))
"""
    run = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=300)
    n, training, oracles = run.stdout.split()[1:]
    assert run.returncode == 0 and int(n) >= 80 and training == "False" and oracles == "True" and "xxhash" in run.stderr


def test_a_cluster_needs_a_shared_folder():
    made = []
    sc = SimpleNamespace(getCheckpointDir=lambda: None, setCheckpointDir=made.append, master="spark://host:7077", applicationId="a")
    unset = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: None))
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(unset)
    named = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: "hdfs://host/shared"))
    assert session.checkpoint_dir(named) == "hdfs://host/shared" and made == ["hdfs://host/shared"]


def test_staged_tables_of_a_run_are_removed(spark):
    kept = session.stage_table(spark.range(3), "kept")
    with session.staged_run(spark):
        inside = session.stage_table(spark.range(4), "inside")
        assert inside.count() == 4
        folder = os.path.dirname(inside.inputFiles()[0].removeprefix("file:"))
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and kept.count() == 3
    dropped = session.stage_table(spark.range(2), "dropped")
    folder = os.path.dirname(dropped.inputFiles()[0].removeprefix("file:"))
    session.drop_staged(dropped)
    assert not os.path.exists(folder)
