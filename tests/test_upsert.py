"""MERGE rules."""

from datetime import date

import pytest
from core_helpers import rows, utc

from tidemark.operators import merge_rows, repeated_keys
from tidemark.schemas import STAGING

T1, T2 = utc(2024, 2, 1), utc(2024, 2, 2)


def point(spark, *points):
    """(entity, day of January or None, price[, ingestion time])"""
    full = [
        (p[0], utc(2024, 1, p[1]) if p[1] else None, p[2], 0.0, 0.0, p[3] if len(p) > 3 else T1)
        for p in points
    ]
    return spark.createDataFrame(full, STAGING)


def stored(tables):
    df = tables.read("staging").selectExpr("entity", "day(event_time)", "price")
    return rows(df)


def test_update_insert_and_keep(spark, tables):
    tables.upsert("staging", point(spark, ("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0)))
    touched = tables.upsert("staging", point(spark, ("a", 1, 10.0), ("c", 1, 30.0)))
    assert touched == [date(2024, 1, 1)]
    assert stored(tables) == [("a", 1, 10.0), ("a", 2, 2.0), ("b", 1, 3.0), ("c", 1, 30.0)]


def test_untouched_partitions_are_not_rewritten(spark, tables, tmp_path):
    tables.upsert("staging", point(spark, ("a", 1, 1.0), ("a", 2, 2.0)))
    day2 = tmp_path / "tables" / "staging" / "event_date=2024-01-02"
    before = sorted(f.name for f in day2.iterdir())
    tables.upsert("staging", point(spark, ("a", 1, 5.0)))
    assert sorted(f.name for f in day2.iterdir()) == before


def test_repeating_an_upsert_changes_nothing(spark, tables):
    source = point(spark, ("a", 1, 1.0), ("b", 2, 2.0))
    tables.upsert("staging", source)
    once = stored(tables)
    tables.upsert("staging", source)
    assert stored(tables) == once


def test_null_keys_never_match(spark, tables):
    source = point(spark, ("a", None, 1.0), ("a", 1, 2.0))
    tables.upsert("staging", source)
    tables.upsert("staging", source)
    assert stored(tables) == [("a", None, 1.0), ("a", None, 1.0), ("a", 1, 2.0)]


def test_older_source_overwrites_by_default(spark, tables):
    tables.upsert("staging", point(spark, ("a", 1, 2.0, T2)))
    tables.upsert("staging", point(spark, ("a", 1, 1.0, T1)))
    assert stored(tables) == [("a", 1, 1.0)]


def test_only_if_newer(spark, tables):
    tables.upsert("staging", point(spark, ("a", 1, 2.0, T2), ("b", 1, 2.0, T1)))
    late = point(spark, ("a", 1, 1.0, T1), ("b", 1, 9.0, T1), ("c", 1, 5.0, T1), (None, 1, 7.0, T1))
    tables.upsert("staging", late, only_if_newer="ingestion_time")
    assert stored(tables) == [(None, 1, 7.0), ("a", 1, 2.0), ("b", 1, 9.0), ("c", 1, 5.0)]


def test_repeated_source_key_raises_and_changes_nothing(spark, tables):
    tables.upsert("staging", point(spark, ("a", 1, 1.0)))
    with pytest.raises(ValueError, match="repeated key"):
        tables.upsert("staging", point(spark, ("a", 1, 5.0), ("a", 1, 6.0)))
    assert stored(tables) == [("a", 1, 1.0)]


def test_repeated_null_keys_are_no_conflict(spark):
    assert repeated_keys(point(spark, ("a", None, 1.0), ("a", None, 2.0)), ["entity", "event_time"]).count() == 0


def test_empty_source(spark, tables):
    assert tables.upsert("staging", point(spark, ("a", 1, 1.0)).limit(0)) == []
    assert stored(tables) == []


def test_scratch_table_is_dropped(spark, tables):
    from pathlib import Path

    from tidemark.session import scratch_root

    root = Path(scratch_root(spark).replace("file:", ""))
    before = set(root.glob("upsert-staging-*"))
    tables.upsert("staging", point(spark, ("a", 1, 1.0)))
    assert set(root.glob("upsert-staging-*")) == before


def test_merge_rows_does_not_depend_on_column_order(spark):
    target = spark.createDataFrame([(1, "old", 0.5), (None, "loose", 0.1)], "k int, name string, v double")
    source = spark.createDataFrame([(0.7, 1, "new"), (0.9, None, "loose2")], "v double, k int, name string")
    merged = merge_rows(target, source, ["k"])
    assert rows(merged) == [(None, "loose", 0.1), (None, "loose2", 0.9), (1, "new", 0.7)]


def test_an_upsert_stopped_between_two_partitions_is_completed(spark, tables, monkeypatch):
    from tidemark.schemas import STAGING
    from tidemark.session import folder
    from tidemark.sources.tables import Tables

    def points(price, *days):
        made = [("a", utc(2024, 1, d), price, 1.0, 1.0, utc(2024, 2, 1)) for d in days]
        return spark.createDataFrame(made, STAGING)

    tables.upsert("staging", points(1.0, 1, 2, 3))
    finish = Tables.finish
    with monkeypatch.context() as stopped:
        calls = iter([False])
        stopped.setattr(Tables, "finish", lambda self, name: next(calls))  # the second call, after the copy, fails
        with pytest.raises(Exception):
            tables.upsert("staging", points(2.0, 1, 2, 4))
    place, files = folder(spark, f"{tables.path('staging')}/event_date=2024-01-02")
    files.delete(place, True)  # as a crash would leave it: one partition gone, the others old
    assert finish is Tables.finish
    Tables(spark, tables.root).create()
    assert rows(tables.read("staging"), "price") == [(1.0,), (2.0,), (2.0,), (2.0,)]
    assert not tables.finish("staging")
