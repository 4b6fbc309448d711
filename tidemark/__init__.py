"""Layered (raw -> staging -> curated) time-series tables on Spark DataFrames."""

from tidemark.session import build_session, configure

__all__ = ["build_session", "configure"]
