"""Supplier-funded promotion analytics on Spark DataFrames."""

from fundspark.context import RunContext, build_session

__all__ = ["RunContext", "build_session"]
