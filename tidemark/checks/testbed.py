"""Envelopes derived from the whole ``events`` table, as a feed would have delivered them.

entity = event_type, price = value, market cap = event_id, volume = props.k. The oracle SQL computes
the same answers from ``events`` directly and never sees JSON.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import iso_utc, points_json
from tidemark.schemas import LANDED

# An envelope holds points of one entity, one day and one run of this many event ids. Copies of an
# event beyond the first fill envelopes of their own, so many at a time: every row is sent, and the
# size of an envelope has a fixed bound however large the table is and however often a row was copied.
IDS_PER_ENVELOPE = 16384
# The short arrays of an uneven delivery leave out the events whose id is divisible by this number.
OMITTED_IDS = 37
# Faulty numbers: the price of the events whose id is divisible by this number is sent as text.
UNPRICED_IDS = 41
UNPRICED = "n/a"
# On this day of the month a landed line breaks off in the middle.
BROKEN_DAY = 7


@dataclass(frozen=True)
class Delivery:
    """One pass of the feed over the events.

    ``uneven``: the market caps lack the omitted events, which come last in the arrays, and the
    volumes have a point too many.
    """

    ingested: datetime
    factor: int = 1
    since: date | None = None
    uneven: bool = False
    days_requested: int = 90


STALE = Delivery(datetime(2024, 1, 31), factor=10)
FULL = Delivery(datetime(2024, 2, 1))
CORRECTION = Delivery(
    datetime(2024, 2, 2), factor=2, since=date(2024, 1, 16), uneven=True, days_requested=2
)
UNEVEN = replace(CORRECTION, since=None)
DELIVERIES = (STALE, FULL, CORRECTION)
AS_OF = date(2024, 2, 2)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, run_date, points[(omitted, ms, event_id, price, volume)]: omitted last, else in time order."""
    events = read(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity"),
        F.to_date("ts").alias("run_date"),
        F.expr(f"event_id div {IDS_PER_ENVELOPE}").alias("chunk"),
        F.struct(
            (F.col("event_id") % OMITTED_IDS == 0).alias("omitted"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
            "event_id",
            F.col("value").alias("price"),
            F.get_json_object("props", "$.k").alias("volume"),
        ).alias("point"),
    )
    # Copies are counted in the map tasks and written out again after the shuffle.
    counted = events.groupBy("entity", "run_date", "chunk", "point").agg(F.count(F.lit(1)).alias("n"))
    once = counted.groupBy("entity", "run_date", "chunk").agg(F.array_sort(F.collect_list("point")).alias("points"))
    more, size = F.col("n") - 1, F.lit(IDS_PER_ENVELOPE)
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((more - 1) / size))
    copies = counted.filter("n > 1").select("entity", "run_date", "point", "n", F.explode(blocks).alias("block"))
    held = F.least(size, more - F.col("block") * size).cast("int")
    copies = copies.select("entity", "run_date", F.array_repeat("point", held).alias("points"))
    return once.drop("chunk").unionByName(copies)


def _members(points: Column, factor: Column, uneven: Column) -> dict[str, Column]:
    """The JSON members of a payload: ``"prices": [[ms, value], ...]`` and so on."""
    scaled = F.transform(points, lambda p: p.withField("price", p["price"] * factor))
    # The other arrays carry timestamps of their own; only those of the prices count.
    shifted = F.transform(points, lambda p: p.withField("ms", p["ms"] + 1))
    caps = F.when(uneven, F.filter(shifted, lambda p: ~p["omitted"])).otherwise(shifted)
    volumes = F.when(uneven, F.concat(shifted, F.slice(shifted, -1, 1))).otherwise(shifted)
    return {
        "prices": F.concat(F.lit('"prices": '), points_json(scaled, "ms", "price")),
        "market_caps": F.concat(F.lit('"market_caps": '), points_json(caps, "ms", "event_id")),
        "total_volumes": F.concat(F.lit('"total_volumes": '), points_json(volumes, "ms", "volume")),
    }


def _joined(members: dict[str, Column]) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(", ", *members.values()), F.lit("}"))


def _faulty(members: dict[str, Column], day: Column) -> Column:
    """The payload with one kind of fault on some days of the month."""
    prices, caps, volumes = members.values()
    broken = {
        "prices": F.when(day == 14, '"prices": null').when(day == 18, '"prices": 5').otherwise(prices),
        "market_caps": F.when(day == 5, '"other": []').otherwise(caps),
        "total_volumes": F.when(day == 9, '"total_volumes": []').otherwise(volumes),
    }
    payload = _joined(broken)
    cut = F.left(payload, F.length(payload) - 1)
    return F.when(day == 23, cut).when(day != 28, payload)


def landed_from_events(
    spark: SparkSession,
    sf_dir: str,
    deliveries: tuple[Delivery, ...] = DELIVERIES,
    faulty: bool = False,
) -> DataFrame:
    """Envelopes of the given deliveries with the columns of ``schemas.LANDED``.

    With ``faulty``, every kind of bad payload occurs: a field absent, empty, null or no array, cut
    off text, and no payload at all.
    """
    passes = F.array(
        *[
            F.struct(
                F.lit(d.ingested).alias("ingestion_time"),
                F.lit(d.days_requested).cast("bigint").alias("days_requested"),
                F.lit(d.factor).alias("factor"),
                F.lit(d.since).cast("date").alias("since"),
                F.lit(d.uneven).alias("uneven"),
            )
            for d in deliveries
        ]
    )
    sent = envelopes(spark, sf_dir).withColumn("d", F.explode(passes))
    sent = sent.filter(F.col("d.since").isNull() | (F.col("run_date") >= F.col("d.since")))
    members = _members(F.col("points"), F.col("d.factor"), F.col("d.uneven"))
    payload = _faulty(members, F.dayofmonth("run_date")) if faulty else _joined(members)
    rows = sent.select("d.*", "entity", "run_date", payload.alias("payload"))
    return rows.select(*LANDED.names)


def faulty_from_events(spark: SparkSession, sf_dir: str, ingested: datetime) -> DataFrame:
    return landed_from_events(spark, sf_dir, (Delivery(ingested),), faulty=True)


def unpriced_from_events(spark: SparkSession, sf_dir: str, ingested: datetime) -> DataFrame:
    """One delivery in which some prices are no numbers."""
    def price(p):
        unpriced = p["event_id"] % UNPRICED_IDS == 0
        return F.when(unpriced, F.lit(f'"{UNPRICED}"')).otherwise(p["price"].cast("string"))

    points = F.transform("points", lambda p: p.withField("price", price(p)))
    sent = envelopes(spark, sf_dir).withColumn("points", points)
    shown = {"prices": "price", "market_caps": "event_id", "total_volumes": "volume"}
    members = {k: F.concat(F.lit(f'"{k}": '), points_json(F.col("points"), "ms", v)) for k, v in shown.items()}
    rows = sent.select(
        F.lit(ingested).alias("ingestion_time"), "entity", F.lit(90).cast("bigint").alias("days_requested"), "run_date",
        _joined(members).alias("payload"),
    )
    return rows.select(*LANDED.names)


def land_broken(envelopes: DataFrame, path: str) -> None:
    """Landed lines as a writer that was stopped leaves them: those of one day break off in the middle."""
    line = F.to_json(F.struct(iso_utc("ingestion_time").alias("ingestion_time"), "entity", "days_requested", "payload", "run_date"))
    cut = F.when(F.dayofmonth("run_date") == BROKEN_DAY, F.left(line, F.floor(F.length(line) / 2).cast("int"))).otherwise(line)
    envelopes.select(cut.alias("value"), F.col("run_date").alias("by_date")).write.partitionBy("by_date").text(path)


def event_days(spark: SparkSession, sf_dir: str) -> tuple[date, date] | None:
    """First and last day of the events; None without any."""
    first, last = read(spark, sf_dir, "events").agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    return (first, last) if first else None


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(F.col("event_type").alias("entity")).distinct()


def customer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run history per customer: one item per order, failed while the order is still open."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("pipeline_name"),
        F.to_date("o_orderdate").alias("run_date"),
        (F.col("o_orderstatus") != "O").alias("ok"),
    )


def customer_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State rows: every order sets its customer's pointer to the order date."""
    ts = F.col("o_orderdate").cast("timestamp")
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("pipeline_name"),
        F.to_date("o_orderdate").alias("last_processed_date"),
        ts.alias("updated_at"),
    )
