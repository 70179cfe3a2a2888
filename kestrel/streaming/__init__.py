from kestrel.streaming.features import run_trip_feature_stream, stream_table, trip_features

__all__ = ["run_trip_feature_stream", "stream_table", "trip_features"]
