"""Column expressions and one-row aggregates, all built from Spark's own functions."""
