"""Parallel-corpus production and quality jobs, written as Spark DataFrame plans."""
