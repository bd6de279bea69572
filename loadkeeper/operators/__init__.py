"""Operators: DataFrames in, DataFrame out, lazily planned."""
