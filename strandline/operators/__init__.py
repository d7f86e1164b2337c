"""Operators: DataFrames in, DataFrames out, nothing computed until an action runs."""
