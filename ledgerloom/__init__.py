"""Retail and order analytics as Spark jobs: DataFrames in, DataFrames out."""

from ledgerloom.session import build_session

__all__ = ["build_session"]
