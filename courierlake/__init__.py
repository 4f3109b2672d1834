"""Medallion order-and-delivery analytics on Spark DataFrames and Structured Streaming."""

from courierlake.session import build_session, tune

__all__ = ["build_session", "tune"]
