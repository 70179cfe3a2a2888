import os

from kestrel.sources.tables import load
from kestrel.streaming import run_trip_feature_stream, trip_features
from tests.conftest import SF


def test_stream_equals_batch(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "stream_out")
    run_trip_feature_stream(spark, SF, out, query_name="t_stream")
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = sorted(tuple(r) for r in trip_features(load(spark, SF, "orders")).collect())
    assert streamed == batch and len(batch) > 0
