"""Daily rollup, change and number rules."""

from datetime import date

import pytest
from core_helpers import rows, utc
from pyspark.sql import functions as F

from tidemark.functions import safe_divide
from tidemark.operators import daily_metrics, nearest_days, with_change
from tidemark.plans import build_curated, daily_rows
from tidemark.plans.layers import changed_rows
from tidemark.schemas import CURATED, STAGING

INGESTED = utc(2024, 2, 1)


@pytest.fixture
def staging(spark):
    def build(*points):
        """(entity, event time, price[, market cap, volume])"""
        full = [(p[0], p[1], p[2], *(p[3:] or (1.0, 1.0)), INGESTED) for p in points]
        return spark.createDataFrame(full, STAGING)

    return build


def changes(df):
    return rows(daily_rows(df), "entity", "date", "daily_price_change_pct")


def test_aggregates_skip_nulls(staging):
    day = utc(2024, 1, 1)
    df = staging(("a", day, 1.0, 10.0, 5.0), ("a", day.replace(hour=5), 3.0, None, None), ("a", day.replace(hour=7), None, 20.0, 2.0))
    assert rows(daily_metrics(df)) == [("a", date(2024, 1, 1), 2.0, 3.0, 1.0, 7.0, 15.0)]


def test_day_without_prices_keeps_its_row(staging):
    df = staging(("a", utc(2024, 1, 1), None))
    assert rows(daily_metrics(df), "avg_price", "max_price", "min_price") == [(None, None, None)]


def test_last_millisecond_belongs_to_its_utc_day(staging):
    df = staging(("a", utc(2024, 1, 1, 23, 59, 59, 999000), 1.0))
    assert rows(daily_metrics(df), "date") == [(date(2024, 1, 1),)]


def test_change_looks_at_the_previous_present_day(staging):
    df = staging(*[("a", utc(2024, 1, d), p) for d, p in ((1, 10.0), (2, 20.0), (5, 30.0))], ("b", utc(2024, 1, 5), 1.0))
    assert changes(df) == [
        ("a", date(2024, 1, 1), None),
        ("a", date(2024, 1, 2), 100.0),
        ("a", date(2024, 1, 5), 50.0),
        ("b", date(2024, 1, 5), None),
    ]


def test_change_against_zero_or_null_is_null(staging):
    df = staging(*[("a", utc(2024, 1, d), p) for d, p in ((1, 0.0), (2, 5.0), (3, None), (4, 6.0))])
    assert [c[2] for c in changes(df)] == [None] * 4


def test_undated_rows_come_before_every_date(staging):
    df = staging(("a", None, 10.0), ("a", utc(2024, 1, 1), 20.0))
    assert changes(df) == [("a", None, None), ("a", date(2024, 1, 1), 100.0)]


def test_other_names_and_no_volume(spark):
    df = spark.createDataFrame([("x", utc(2024, 1, 1), 4.0)], "k string, t timestamp, p double")
    daily = with_change(daily_metrics(df, "k", "t", "p", volume=None, market_cap=None))
    assert daily.columns == ["entity", "date", "avg_price", "max_price", "min_price", "daily_price_change_pct"]


@pytest.mark.parametrize(
    "x, y, expected",
    [(6.0, 4.0, 1.5), (1.0, 0.0, None), (0.0, 0.0, None), (None, 2.0, None), (2.0, None, None), (1e308, 1e-10, None)],
)
def test_safe_divide(spark, x, y, expected):
    df = spark.createDataFrame([(x, y)], "x double, y double")
    assert df.select(safe_divide(df.x, df.y)).first()[0] == expected


FIRST = [("a", utc(2024, 1, d), float(d)) for d in (1, 2, 5, 8)]
FIRST += [("b", utc(2024, 1, d), 10.0 * d) for d in (2, 5, 6)]
FIRST += [("n", None, 4.0), ("n", utc(2024, 1, 5), 8.0)]


@pytest.mark.parametrize(
    "later",
    [
        [("a", utc(2024, 1, 9), 50.0)],  # after everything
        [("a", utc(2023, 12, 1), 50.0)],  # before everything
        [("a", utc(2024, 1, 3), 50.0)],  # into a gap
        [("a", utc(2024, 1, 1, 1), 50.0)],  # changes the first day
        [("a", utc(2024, 1, 2, 1), 50.0), ("b", utc(2024, 1, 8), 7.0)],  # two days, others between
        [("c", utc(2024, 1, 2), 50.0)],  # new entity on a known day
        [("a", utc(2024, 3, 1), 50.0), ("a", utc(2023, 12, 1), 50.0)],  # spans all months
        [("n", utc(2024, 1, 2), 6.0)],  # between the undated and the first dated row
    ],
)
def test_changed_rows_are_those_of_a_full_rebuild(staging, later):
    def dated(points):
        return staging(*points).withColumn("event_date", F.to_date("event_time"))

    known = daily_rows(dated(FIRST))
    touched = sorted({p[1].date() for p in later})
    everything = dated([*FIRST, *later])
    before, after = set(map(tuple, known.collect())), set(map(tuple, daily_rows(everything).collect()))
    fresh = daily_metrics(everything.filter(F.col("event_date").isin(touched)))
    entities, metrics = fresh.select("entity"), [c for c in CURATED.names if c not in ("entity", "date", "daily_price_change_pct")]
    earlier = nearest_days(known, entities, touched[0], True, ["avg_price"])
    later_days = nearest_days(known, entities, touched[-1], False, metrics)
    changed = set(map(tuple, changed_rows(everything, known, touched, earlier, later_days, fresh).collect()))
    assert after - before <= changed <= after


@pytest.mark.parametrize("newcomer, reads", [(False, 1), (True, 3)])
def test_neighbours_are_looked_for_in_the_closest_months_first(tables, staging, monkeypatch, newcomer, reads):
    """An increment reads two months while all its entities were there lately; a new one widens the search."""
    from tidemark.plans import layers

    months = [utc(2023, m, 3) for m in range(1, 13)]
    build_curated(tables, tables.upsert("staging", staging(*[(e, m, float(m.month)) for e in "ab" for m in months])))
    asked = []

    def seen(known, entities, bound, before, metrics):
        asked.append((before, [str(r.month)[:7] for r in known.select("month").distinct().orderBy("month").collect()]))
        return nearest_days(known, entities, bound, before, metrics)

    monkeypatch.setattr(layers, "nearest_days", seen)
    points = [(e, utc(2023, 12, 9), 5.0) for e in ("abn" if newcomer else "ab")]
    build_curated(tables, tables.upsert("staging", staging(*points)))
    back = [months for before, months in asked if before]
    assert len(back) == reads and back[0] == ["2023-11", "2023-12"]
    assert [m for before, m in asked if not before] == [["2023-12"]]
    assert rows(tables.read("curated").select(*CURATED.names)) == rows(daily_rows(tables.read("staging")))


def test_increments_equal_one_full_build(tables, staging):
    build_curated(tables, [])
    increments = [
        [("a", utc(2024, 1, 4), 6.0), ("b", utc(2024, 1, 5), 2.0)],
        [("a", utc(2024, 1, 2), 3.0), ("b", None, 1.0)],
        [("a", utc(2024, 1, 3), 9.0), ("a", utc(2024, 1, 4), 5.0), ("b", utc(2024, 1, 2), 8.0)],
    ]
    for points in increments:
        build_curated(tables, tables.upsert("staging", staging(*points)))
        stored = rows(tables.read("curated").select(*CURATED.names))
        assert stored == rows(daily_rows(tables.read("staging")))
