"""MERGE semantics as DataFrame operations: matched rows replaced, new rows added, none deleted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import latest_per_key


def _keyed(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null keys that occur more than once. Counts are pre-aggregated before the shuffle."""
    return (
        df.filter(_keyed(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    example = repeated_keys(df, keys).head(1)
    if example:
        raise ValueError(f"a source row must match at most once; repeated key {example[0].asDict()}")


def matched_versions(target: DataFrame, source: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The keys that both sides hold, and whether the source's row wins: larger version, or equal.

    A missing version is older than any other. Only keys and versions of either side are moved.
    """
    theirs = target.filter(_keyed(keys)).select(*keys, F.col(version).alias("_theirs"))
    mine = source.filter(_keyed(keys)).groupBy(*keys).agg(F.max(version).alias("_mine"))
    wins = F.col("_theirs").isNull() | F.coalesce(F.col("_mine") >= F.col("_theirs"), F.lit(False))
    return theirs.join(mine, list(keys)).select(*keys, wins.alias("_source_wins"))


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    only_if_newer: str | None = None,
    matches: DataFrame | None = None,
) -> DataFrame:
    """All rows of the merged table.

    A source row replaces the target row with equal keys without comparing anything else, unless
    ``only_if_newer`` names a version column: then the larger version stays, the source on a tie, and
    of several source rows the one with the largest. ``matches`` is the stored result of
    ``matched_versions``; without it both sides of the merge work it out.

    Full rows of the target move only if the keys to be matched are too many to broadcast. Keys match
    with ``=``: rows with a null key match nothing and are kept on both sides. They stay out of the
    shuffle, so they cannot pile up in one task.
    """
    source = source.select(*target.columns)
    keyed, loose = target.filter(_keyed(keys)), target.filter(~_keyed(keys))
    if only_if_newer is None:
        kept = keyed.join(source.filter(_keyed(keys)).select(*keys), list(keys), "left_anti")
        return kept.select(*target.columns).unionByName(loose).unionByName(source)
    if matches is None:
        matches = matched_versions(target, source, keys, only_if_newer)
    mine = latest_per_key(source.filter(_keyed(keys)), keys, only_if_newer)
    won, lost = (matches.filter(c).select(*keys) for c in ("_source_wins", "NOT _source_wins"))
    kept = keyed.join(won, list(keys), "left_anti").select(*target.columns)
    fresh = mine.join(lost, list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(loose).unionByName(fresh).unionByName(source.filter(~_keyed(keys)))
