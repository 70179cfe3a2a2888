"""DataFrame operators: profiling, cleaning, ordering, features, time series, text, sequences,
models and run tracking."""
