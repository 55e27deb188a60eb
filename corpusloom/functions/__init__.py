"""Column builders: each takes columns and returns a column, no job is started."""
