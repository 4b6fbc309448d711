"""Flattening and latest-per-key rules."""

from datetime import date

import pytest
from core_helpers import DAY1, DAY2, TWO_POINTS, payload, rows, utc

from tidemark.operators import flatten_series, latest_per_key, recent
from tidemark.plans import daily_rows, staging_rows

T1, T2 = utc(2024, 2, 1), utc(2024, 2, 2)


def flat(landed, *texts, **options):
    df = landed(*[("a", T1, text) for text in texts])
    return flatten_series(df, **options)


def test_two_points(landed):
    points = flat(landed, TWO_POINTS)
    assert rows(points, "position", "price", "market_cap", "total_volume") == [
        (0, 12.5, 7100.0, 64.0),
        (1, 15.0, 7350.0, 81.0),
    ]
    assert [r[0] for r in rows(points.selectExpr("unix_millis(event_time)"))] == [DAY1, DAY2]


def test_two_points_to_daily_change(landed):
    daily = daily_rows(flat(landed, TWO_POINTS))
    assert rows(daily, "date", "daily_price_change_pct") == [
        (date(2023, 5, 8), None),
        (date(2023, 5, 9), 20.0),
    ]


def test_shortest_array_wins(landed):
    text = payload([[1, 1], [2, 2], [3, 3]], [[1, 1], [2, 2]], [[1, 1], [2, 2], [3, 3], [4, 4]])
    assert flat(landed, text).count() == 2


@pytest.mark.parametrize(
    "text",
    [
        '{"prices": [[1, 1]], "market_caps": [[1, 1]]}',
        '{"prices": null, "market_caps": [[1, 1]], "total_volumes": [[1, 1]]}',
        '{"prices": [[1, 1]], "market_caps": 7, "total_volumes": [[1, 1]]}',
        '{"prices": [], "market_caps": [[1, 1]], "total_volumes": [[1, 1]]}',
        '{"prices": [[1, 1]], "market_caps": [[1, 1]], "total_volumes": [[1,',
        None,
    ],
)
def test_unusable_payload_gives_no_rows(landed, text):
    assert flat(landed, text).count() == 0


def test_event_time_comes_from_the_first_array_only(landed):
    points = flat(landed, payload([[DAY1, 1.0]], [[DAY2, 2.0]], [[5, 3.0]]))
    assert rows(points.selectExpr("unix_millis(event_time)", "market_cap", "total_volume")) == [
        (DAY1, 2.0, 3.0)
    ]


def test_json_null_value_and_timestamp_keep_the_row(landed):
    points = flat(landed, payload([[DAY1, None], [None, 5.0]]))
    got = rows(points.selectExpr("position", "unix_millis(event_time)", "price"))
    assert got == [(0, DAY1, None), (1, None, 5.0)]


def test_quoted_number_is_accepted(landed):
    assert rows(flat(landed, payload([[DAY1, "17.25"]])), "price") == [(17.25,)]


@pytest.mark.parametrize("point", [["1683525600000.5", 1.0], [1683525600000.5, 1.0], [DAY1, "abc"], [DAY1, True]])
def test_text_that_is_no_number_fails_the_job(landed, point):
    points = flat(landed, payload([point], [[1, 1]], [[1, 1]]))
    with pytest.raises(Exception, match="not a valid"):
        points.collect()


@pytest.mark.parametrize("value", ["abc", True])
def test_bad_value_in_a_later_array_fails_the_job(landed, value):
    with pytest.raises(Exception, match="not a valid number"):
        flat(landed, payload([[DAY1, 1.0]], [[DAY1, value]])).collect()


def test_odd_elements_in_later_arrays(landed):
    odd = [5, [7], ["x", "2.5"], None, {"a": 1}, [DAY1, [3]], [DAY1, None], ["t", 4]]
    points = flat(landed, payload([[DAY1, 1.0]] * len(odd), odd))
    assert [r[1] for r in rows(points, "position", "market_cap")] == [
        None, None, 2.5, None, None, None, None, 4.0,
    ]


def test_integer_like_timestamps_are_still_checked_as_text(landed):
    text = '{"prices": [[1704067200000.0, 1]], "market_caps": [[1, 1]], "total_volumes": [[1, 1]]}'
    with pytest.raises(Exception, match="not a valid epoch millisecond"):
        flat(landed, text).collect()


def test_text_that_is_no_number_still_fails_without_ansi(spark, landed):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a valid number: abc"):
            flat(landed, payload([[DAY1, "abc"]])).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_text_that_is_no_number_can_become_null(landed):
    points = flat(landed, payload([[DAY1, "abc"], ["x", 2.0]], [[1, 1]] * 2, [[1, 1]] * 2), bad="null")
    assert rows(points.selectExpr("position", "unix_millis(event_time)", "price")) == [
        (0, DAY1, None),
        (1, None, 2.0),
    ]


def test_text_that_is_no_number_can_be_flagged(landed):
    text = payload([[DAY1, "abc"], ["x", 2.0], [DAY1, 3.0], [None, None]], [[1, 1]] * 3 + [[1, "y"]], [[1, 1]] * 4)
    assert rows(flat(landed, text, bad="flag"), "position", "is_bad") == [
        (0, True), (1, True), (2, False), (3, True),
    ]


def test_complete_days_only(landed):
    raw = landed(("a", T1, payload([[DAY1, 1.0], [DAY2, 2.0], [None, 3.0]])))
    assert rows(staging_rows(raw, date(2023, 5, 9), None, complete_days_only=True), "price") == [(1.0,)]


def test_odd_elements_become_null_and_neighbours_stay(landed):
    points = flat(landed, payload([5, [7], [DAY1, 1.5], None, {"a": 1}, [DAY2, 2.5], [DAY2, [1, 2]]]))
    got = rows(points.selectExpr("position", "unix_millis(event_time)", "price"))
    assert got == [
        (0, None, None),
        (1, 7, None),
        (2, DAY1, 1.5),
        (3, None, None),
        (4, None, None),
        (5, DAY2, 2.5),
        (6, DAY2, None),
    ]


def test_odd_element_in_one_array_leaves_the_others_alone(landed):
    points = flat(landed, payload([[DAY1, 1.5], [DAY2, 2.5]], [9, [1, 8.5]]))
    assert rows(points, "position", "price", "market_cap") == [(0, 1.5, None), (1, 2.5, 8.5)]


def test_other_names(landed):
    df = landed(("a", T1, '{"p": [[5, 1.0]], "q": [[6, 2.0]]}')).withColumnRenamed("entity", "coin")
    points = flatten_series(df, {"p": "usd", "q": "cap"}, keep=["coin"], event_time="at", position="i")
    assert points.columns == ["coin", "at", "usd", "cap", "i"]
    assert rows(points, "coin", "usd", "cap", "i") == [("a", 1.0, 2.0, 0)]


def test_latest_ingestion_wins(landed):
    raw = landed(("a", T2, payload([[DAY1, 2.0]])), ("a", T1, payload([[DAY1, 1.0]])))
    assert rows(staging_rows(raw, date(2024, 2, 2)), "price") == [(2.0,)]


def test_repeated_timestamp_in_one_payload_keeps_the_later_position(landed):
    raw = landed(("a", T1, payload([[DAY1, 9.0], [DAY1, 1.0]])))
    assert rows(staging_rows(raw, date(2024, 2, 1)), "price") == [(1.0,)]


def test_null_keys_are_one_key(landed):
    raw = landed(("a", T1, payload([[None, 1.0], [None, 2.0]])), ("b", T1, payload([[None, 3.0]])))
    assert rows(staging_rows(raw, date(2024, 2, 1)), "entity", "price") == [("a", 2.0), ("b", 3.0)]


def test_latest_per_key_puts_null_order_last(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 5, "y")], "k int, v int, name string")
    assert rows(latest_per_key(df, ["k"], "v"), "name") == [("y",)]


def test_recent_bounds(landed):
    df = landed(
        ("as_of", utc(2024, 2, 2, 23), None),
        ("day_before", utc(2024, 2, 1), None),
        ("older", utc(2024, 1, 31, 23, 59, 59), None),
    )
    df = df.unionByName(landed(("never", T1, None)).selectExpr(
        "cast(null as timestamp) ingestion_time", "entity", "days_requested", "payload", "run_date"
    ))
    assert rows(recent(df, date(2024, 2, 2)), "entity") == [("as_of",), ("day_before",)]
    assert rows(recent(df, date(2024, 2, 2), 0), "entity") == [("as_of",)]
    assert recent(df, None, None).count() == 4
    with pytest.raises(ValueError, match="as_of"):
        recent(df, None, 1)
