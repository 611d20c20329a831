"""Column expressions and row-level steps, all of them built-in Spark functions."""
