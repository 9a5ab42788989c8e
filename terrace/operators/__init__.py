"""DataFrame operators: quality, history, flattening, metrics, profiling."""
