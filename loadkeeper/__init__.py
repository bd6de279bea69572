"""Metadata-driven load control, reconciliation and readiness analytics on Spark DataFrames."""

__version__ = "0.1.0"
