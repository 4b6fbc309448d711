"""Keyword search over texts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions import has_keyword


def keyword_scan(docs: DataFrame, needle: str, text: str = "text") -> DataFrame:
    """Documents whose text contains ``needle`` anywhere."""
    return docs.filter(has_keyword(text, needle))
