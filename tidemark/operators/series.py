"""Envelopes of parallel point arrays -> one row per point -> one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    checked_double,
    checked_millis,
    in_utc_day_window,
    nested_arrays,
    number_points,
    text_points,
    utc_day,
)
from tidemark.functions.dates import as_column
from tidemark.functions.json_points import bad_double, bad_millis
from tidemark.schemas import METRICS

INGESTION_DATE = "ingestion_date"


def recent(
    df: DataFrame,
    as_of: date | Column | None,
    lookback_days: int | None = 1,
    ingestion_time: str = "ingestion_time",
) -> DataFrame:
    """Rows ingested on or after the UTC day ``as_of - lookback_days``; ``None`` keeps all rows.

    A bound needs its day: a lookback without ``as_of`` is an error, not an empty answer. A null
    ingestion time never passes. When the table carries its ``ingestion_date`` partition
    column the same bound is put on it, so that older partitions are not listed or read.
    """
    if lookback_days is None:
        return df
    if as_of is None:
        raise ValueError("lookback_days needs as_of; lookback_days=None keeps all rows")
    if INGESTION_DATE in df.columns:
        df = df.filter(in_utc_day_window(F.col(INGESTION_DATE), as_of, lookback_days))
    return df.filter(in_utc_day_window(F.col(ingestion_time), as_of, lookback_days))


def complete_days(
    df: DataFrame, as_of: date | Column, event_time: str = "event_time"
) -> DataFrame:
    """Points of days that are over; those of ``as_of`` itself and without a time are left out."""
    return df.filter(utc_day(event_time) < as_column(as_of))


def flatten_series(
    df: DataFrame,
    metrics: Mapping[str, str] = METRICS,
    payload: str = "payload",
    keep: Sequence[str] = ("entity", "ingestion_time"),
    event_time: str = "event_time",
    position: str = "position",
    bad: str = "raise",
) -> DataFrame:
    """One row per array position, up to the shortest array of the payload.

    ``metrics`` maps payload array -> output column. The first array also supplies the event time;
    the timestamps inside the others are not read. The arrays are zipped inside the row, so the
    positional join needs no shuffle.

    ``bad`` says what happens to text that is no number: ``raise`` fails the job, ``null`` reads it
    as null, ``flag`` does that and adds a boolean ``is_bad``, to keep such points elsewhere, and
    ``bad_text``, the JSON text of what the arrays hold there.
    """
    if bad not in ("raise", "null", "flag"):
        raise ValueError("bad must be raise, null or flag")
    names, strict = list(metrics), bad == "raise"
    # Flagging needs the text of every value; otherwise only the timestamps do.
    texts = names if bad == "flag" else names[:1]
    numbers = [n for n in names if n not in texts]
    text, doc = F.col(payload), F.col("_nested")
    parsed = df.select(*keep, text, nested_arrays(text, texts, numbers).alias("_nested"))
    arrays = parsed.select(
        *keep,
        *[text_points(doc, text, n).alias(n) for n in texts],
        *[number_points(doc, text, n, strict).alias(n) for n in numbers],
    )
    shortest = F.least(*[F.array_size(n) for n in names])
    zipped = F.slice(F.arrays_zip(*names), F.lit(1), shortest)
    exploded = arrays.select(*keep, F.posexplode(zipped).alias(position, "_point"))
    point = {n: F.col("_point")[n] for n in names}
    values = {n: checked_double(point[n], strict) for n in texts}
    values |= {n: F.get(point[n], F.lit(1)) for n in numbers}
    columns = [
        *keep,
        checked_millis(point[names[0]], strict).alias(event_time),
        *[values[n].alias(out) for n, out in metrics.items()],
        position,
    ]
    if bad == "flag":
        tests = [bad_millis(point[names[0]]), *[bad_double(point[n]) for n in names]]
        is_bad = reduce(Column.__or__, tests)
        columns += [is_bad.alias("is_bad"), F.when(is_bad, F.to_json("_point")).alias("bad_text")]
    return exploded.select(*columns)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The row with the largest ``order`` per key, larger ``tiebreak`` values deciding ties.

    Null keys form a key of their own. ``row_number() = 1`` lets Spark drop the losing rows of each
    map task before the shuffle, so many deliveries of one key send one row per task.
    """
    first = [order] if isinstance(order, str) else list(order)
    ranking = [F.col(c).desc() for c in (*first, *tiebreak)]
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")
