"""DataFrame operators: each takes and returns DataFrames, never collects."""
