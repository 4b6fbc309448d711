"""Whole runs: backfill, incremental and the file stream."""

from datetime import date, timedelta

import pytest
from core_helpers import TWO_POINTS, payload, rows, utc
from pyspark.sql import functions as F

from tidemark.operators import last_processed
from tidemark.plans import backfill, daily_rows, incremental, staging_rows
from tidemark.schemas import CURATED, STAGING
from tidemark.sources import create_tables, land
from tidemark.streaming import incremental_stream

TODAY = date(2024, 1, 10)
NOW = utc(2024, 1, 10, 6)
COINS = ["harbour", "lighthouse", "meadow", "quarry", "viaduct"]
MS = {day: int(utc(2024, 1, day).timestamp() * 1000) for day in range(1, 11)}


@pytest.fixture
def coins(spark):
    return spark.createDataFrame([(c,) for c in COINS], "entity string")


def sent(landed, *days, skip=(), bad=(), ingested=NOW):
    """One envelope per coin and run date, except skipped and broken ones."""
    return landed(
        *[
            (c, ingested, "{}" if (c, d) in bad else payload([[MS[d], float(d)]]), date(2024, 1, d))
            for d in days
            for c in COINS
            if (c, d) not in skip
        ]
    )


def pointer(tables, name="incremental"):
    return last_processed(tables.read("state"), name)


def test_backfill_loads_every_entity(landed, tables, coins):
    result = backfill(sent(landed, 10), tables, coins, TODAY)
    assert result and (result.items, result.failures, result.load.rows_loaded) == (5, 0, 5)
    assert tables.read("staging").count() == 5
    assert tables.read("curated").count() == 5
    assert pointer(tables, "backfill") is None


def test_backfill_skips_what_was_loaded_that_day(landed, tables, coins):
    backfill(sent(landed, 10, skip=[(c, 10) for c in COINS[1:]]), tables, coins, TODAY)
    result = backfill(sent(landed, 10), tables, coins, TODAY)
    assert (result.ok, result.items, result.load.rows_loaded) == (True, 4, 4)
    again = backfill(sent(landed, 10), tables, coins, TODAY, advance_state=True)
    assert (again.ok, again.items, again.load.rows_loaded) == (True, 0, 0)
    assert tables.raw().count() == 5
    assert pointer(tables, "backfill") == TODAY


def test_backfill_isolates_a_bad_entity(landed, tables, coins):
    result = backfill(sent(landed, 10, bad=[("meadow", 10)]), tables, coins, TODAY, advance_state=True)
    assert not result
    assert (result.failures, result.load.rows_loaded, result.load.rows_rejected) == (1, 4, 1)
    assert rows(tables.rejected(), "entity") == [("meadow",)]
    assert rows(tables.read("status").filter("NOT ok"), "entity", "reason") == [
        ("meadow", "missing or empty: prices, market_caps, total_volumes")
    ]
    assert tables.read("curated").count() == 4
    assert pointer(tables, "backfill") is None


def test_backfill_goes_on_when_it_cannot_tell_what_was_loaded(landed, tables, coins, monkeypatch):
    """Every entity is loaded then; staging keeps one row per key, and the result says what went wrong."""
    import sys

    plan = sys.modules["tidemark.plans.backfill"]
    backfill(sent(landed, 10), tables, coins, TODAY)

    def broken(raw, day):
        return raw.select(F.raise_error(F.lit("no access")).cast("string").alias("entity"), F.lit(day).alias("run_date"))

    monkeypatch.setattr(plan, "loaded_on", broken)
    result = backfill(sent(landed, 10), tables, coins, TODAY)
    assert result and "no access" in result.check_error and (result.items, result.load.rows_loaded) == (5, 5)
    assert tables.raw().count() == 10 and tables.read("staging").count() == 5
    with pytest.raises(Exception, match="no access"):
        backfill(sent(landed, 10), tables, coins, TODAY, strict_check=True)
    assert tables.raw().count() == 10


def test_unlisted_entities_are_not_loaded(landed, tables, coins):
    extra = landed(("orchard", NOW, TWO_POINTS, TODAY))
    result = backfill(sent(landed, 10).unionByName(extra), tables, coins, TODAY)
    assert result.load.rows_loaded == 5


def test_incremental_first_run_then_up_to_date(landed, tables, coins):
    result = incremental(sent(landed, 7, 8, 9), tables, coins, TODAY)
    assert result and (result.items, result.load.rows_loaded) == (10, 10)
    assert (result.start, result.end, result.resume_date) == (date(2024, 1, 8), date(2024, 1, 9), date(2024, 1, 9))
    assert pointer(tables) == date(2024, 1, 9)
    again = incremental(sent(landed, 9), tables, coins, TODAY)
    assert again and again.run_id is None and again.load is None
    assert tables.raw().count() == 10
    nxt = incremental(sent(landed, 9, 10, ingested=utc(2024, 1, 11)), tables, coins, TODAY + timedelta(days=1))
    assert (nxt.start, nxt.end, nxt.load.rows_loaded) == (TODAY, TODAY, 5)


@pytest.mark.parametrize(
    "bad_day, policy, expected",
    [(9, "contiguous", 8), (8, "max_success", 9), (7, "contiguous", None)],
)
def test_incremental_partial_failure(landed, tables, coins, bad_day, policy, expected):
    envelopes = sent(landed, 7, 8, 9, bad=[("quarry", bad_day)])
    result = incremental(envelopes, tables, coins, TODAY, first_run_days=3, policy=policy)
    assert (result.ok, result.items, result.failures) == (False, 15, 1)
    assert tables.read("curated").count() == 14
    assert pointer(tables) == (date(2024, 1, expected) if expected else None)


def test_incremental_with_nothing_landed_still_builds_the_layers(landed, tables, coins):
    tables.load(sent(landed, 5), "earlier")
    result = incremental(sent(landed, 1), tables, coins, TODAY)
    assert (result.ok, result.failures, result.load.rows_loaded) == (False, 10, 0)
    assert pointer(tables) is None
    assert tables.read("curated").count() == 5


def test_failing_staging_stops_curated_and_state(landed, tables, coins):
    bad = landed(*[(c, NOW, payload([[MS[9], "abc"]]), date(2024, 1, 9)) for c in COINS])
    with pytest.raises(Exception, match="not a valid number"):
        incremental(bad, tables, coins, TODAY, first_run_days=1)
    assert pointer(tables) is None
    assert tables.read("curated").count() == 0


def test_lookback(landed, tables, coins):
    tables.load(sent(landed, 5, ingested=utc(2024, 1, 5)), "earlier")
    incremental(sent(landed, 9), tables, coins, TODAY, first_run_days=1)
    assert tables.read("staging").count() == 5
    incremental(sent(landed, 10), tables, coins, date(2024, 1, 11), lookback_days=None)
    assert tables.read("staging").count() == 15


def deliveries(landed):
    """Three ingestions of overlapping points, the newest not last."""
    return [
        sent(landed, 8, 9, ingested=utc(2024, 1, 10, hour)).withColumn("run_date", F.lit(run_date))
        for hour, run_date in ((3, date(2024, 1, 1)), (9, date(2024, 1, 2)), (6, date(2024, 1, 3)))
    ]


def run_stream(tables, landing, checkpoint, **options):
    query = incremental_stream(landing, tables, checkpoint, **options)
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_resumes(spark, landed, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    tables = create_tables(spark, str(tmp_path / "tables"))
    first, second, third = deliveries(landed)
    land(first, landing, layout=("by_date",))
    land(second, landing, layout=("by_date",))
    run_stream(tables, landing, checkpoint, max_files_per_trigger=1)
    assert tables.raw().count() == 20
    loads = tables.raw().select("load_id").distinct().count()
    assert loads > 1

    run_stream(tables, landing, checkpoint)
    assert tables.raw().count() == 20

    land(third, landing, layout=("by_date",))
    run_stream(tables, landing, checkpoint)
    assert tables.raw().count() == 30

    everything = first.unionByName(second).unionByName(third)
    expected = staging_rows(everything, None, None)
    assert rows(tables.read("staging").select(*STAGING.names)) == rows(expected)
    assert rows(tables.read("curated").select(*CURATED.names)) == rows(daily_rows(expected))


def test_stream_with_bounded_age(spark, landed, tmp_path):
    landing = str(tmp_path / "landing")
    tables = create_tables(spark, str(tmp_path / "tables"))
    land(sent(landed, 8, ingested=utc(2024, 1, 8)), landing)
    land(sent(landed, 9), landing)
    run_stream(tables, landing, str(tmp_path / "checkpoint"), as_of=TODAY, lookback_days=1)
    assert tables.raw().count() == 10
    assert tables.read("staging").count() == 5


def test_stream_keeps_rejects_apart(spark, landed, tmp_path):
    landing = str(tmp_path / "landing")
    tables = create_tables(spark, str(tmp_path / "tables"))
    land(sent(landed, 9, bad=[("meadow", 9)]), landing, layout=("by_date",))
    run_stream(tables, landing, str(tmp_path / "checkpoint"))
    assert rows(tables.rejected(), "entity") == [("meadow",)]
    assert tables.read("curated").count() == 4


def test_stream_without_as_of_counts_from_today(spark, landed, tmp_path):
    from datetime import datetime, timezone

    landing = str(tmp_path / "landing")
    tables = create_tables(spark, str(tmp_path / "tables"))
    old, new = sent(landed, 8), sent(landed, 9, ingested=datetime.now(timezone.utc))
    land(old.unionByName(new), landing, layout=("by_date",))
    run_stream(tables, landing, str(tmp_path / "checkpoint"), lookback_days=1)
    assert tables.read("staging").count() == len(COINS)
