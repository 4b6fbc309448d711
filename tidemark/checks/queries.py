"""The registered queries: (spark, folder of the test tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidemark.checks import testbed as bed
from tidemark.functions import iso_utc, landing_key, safe_divide, zero_pad
from tidemark.operators import (
    daily_metrics,
    failed_dates,
    flatten_series,
    keyword_scan,
    landed_exists,
    latest_per_key,
    latest_state,
    loaded_counts,
    merge_rows,
    pending,
    point_counts,
    recent,
    resume_point,
    run_status,
    run_summary,
    run_window,
    validate,
    with_change,
    with_missing,
    work_items,
)
from tidemark.plans import backfill, build_curated, build_staging, incremental, staging_rows
from tidemark.schemas import CURATED, STAGING, STATE
from tidemark.session import configure, scratch_path
from tidemark.sources import Tables, configured, create_tables, land, load_landed, load_landed_days
from tidemark.streaming import incremental_stream

Query = Callable[[SparkSession, str], DataFrame]

FAULTS_INGESTED = datetime(2024, 1, 31)
BACKFILL_NOW = datetime(2024, 2, 1, 6)
WEEK_DAYS = 7
WEEK = date(2024, 1, 12)
STATE_SPLIT = datetime(1999, 1, 1)
WINDOW_AS_OF = date(2001, 7, 31)
KEYWORD = "license"

# Averages of two-decimal values often lie exactly between two 6-digit numbers, where summing in
# another order decides how ``round`` goes. Cutting off-centre keeps both engines clear of that.
SCALE = 1e6
NUDGE = 0.2718281828

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name; a trailing ``_query`` only keeps clear of an operator's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _edge(fn(configure(spark), sf_dir.rstrip("/")))

    _registry[fn.__name__.removesuffix("_query")] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_registry)


def _edge(df: DataFrame) -> DataFrame:
    """Zone-free timestamps, as the oracle has them, and floats cut to 6 digits."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        elif field.dataType.typeName() == "double":
            # From 2^52 on a double has no fraction left, and floor() would saturate as a long.
            scaled = column * SCALE + NUDGE
            column = F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled) / SCALE
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _fresh_tables(spark: SparkSession) -> Tables:
    return create_tables(spark, scratch_path(spark, "tables"))


def _raw(spark: SparkSession, sf_dir: str, *deliveries) -> DataFrame:
    return bed.landed_from_events(spark, sf_dir, deliveries or bed.DELIVERIES)


# Scans, filters and payloads


@query
def recent_raw(spark, sf_dir):
    rows = recent(_raw(spark, sf_dir), bed.AS_OF, lookback_days=1)
    return rows.select("entity", "run_date", "ingestion_time", "days_requested")


@query
def valid_payloads(spark, sf_dir):
    valid, _ = validate(bed.faulty_from_events(spark, sf_dir, FAULTS_INGESTED))
    return point_counts(valid).drop("payload")


@query
def rejected_payloads(spark, sf_dir):
    _, rejected = validate(bed.faulty_from_events(spark, sf_dir, FAULTS_INGESTED))
    return rejected.select("entity", "run_date", F.array_join("missing", ",").alias("missing"))


@query
def documents_with_keyword(spark, sf_dir):
    hits = keyword_scan(bed.read(spark, sf_dir, "documents"), KEYWORD)
    return hits.select("doc_id", "lang", "source")


@query
def safe_ratio(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("double")
    events = bed.read(spark, sf_dir, "events")
    return events.select("event_id", safe_divide(F.col("value"), k).alias("ratio"))


@query
def landing_keys(spark, sf_dir):
    events = bed.read(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        landing_key(F.col("event_type"), F.to_date("ts"), ts).alias("object_key"),
        zero_pad("user_id", 3).alias("padded"),
        iso_utc(ts).alias("iso_time"),
    )


# Series


@query
def flatten_series_query(spark, sf_dir):
    return flatten_series(_raw(spark, sf_dir)).drop("position")


@query
def flatten_shortest(spark, sf_dir):
    counted = point_counts(_raw(spark, sf_dir, bed.UNEVEN))
    sizes = ["n_prices", "n_market_caps", "n_total_volumes"]
    points = flatten_series(counted, keep=["entity", "run_date", *sizes])
    return points.select("entity", "run_date", *sizes, "event_time", "position")


@query
def latest_per_key_query(spark, sf_dir):
    return staging_rows(_raw(spark, sf_dir), bed.AS_OF)


@query
def latest_event_per_user(spark, sf_dir):
    events = bed.read(spark, sf_dir, "events")
    latest = latest_per_key(events, ["user_id"], "ts", ["event_id"])
    return latest.select("user_id", "event_id", "ts", "event_type", "value")


# Upserts


def _merged_staging(spark, sf_dir, times: int = 1) -> Tables:
    tables = _fresh_tables(spark)
    build_staging(tables, _raw(spark, sf_dir, bed.FULL), bed.AS_OF)
    correction = _raw(spark, sf_dir, bed.CORRECTION)
    for _ in range(times):
        build_staging(tables, correction, bed.AS_OF, lookback_days=0)
    return tables


@query
def staging_upsert(spark, sf_dir):
    return _merged_staging(spark, sf_dir).read("staging").select(*STAGING.names)


@query
def staging_upsert_twice(spark, sf_dir):
    return _merged_staging(spark, sf_dir, times=2).read("staging").select(*STAGING.names)


@query
def staging_upsert_only_if_newer(spark, sf_dir):
    tables = _fresh_tables(spark)
    for delivery in (bed.CORRECTION, bed.STALE, bed.FULL):
        raw = _raw(spark, sf_dir, delivery)
        build_staging(tables, raw, as_of=None, lookback_days=None, only_if_newer=True)
    return tables.read("staging").select(*STAGING.names)


@query
def staging_upsert_older_wins(spark, sf_dir):
    """A match overwrites without comparing ingestion times: the delivery that comes last stays."""
    tables = _fresh_tables(spark)
    for delivery in (bed.FULL, bed.STALE):
        build_staging(tables, _raw(spark, sf_dir, delivery), as_of=None, lookback_days=None)
    return tables.read("staging").select(*STAGING.names)


@query
def merge_null_keys(spark, sf_dir):
    """Rows without a key match nothing: those of both sides stay."""
    key = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey")).alias("k")
    orders = bed.read(spark, sf_dir, "orders")
    target = orders.select(key, "o_custkey", "o_orderstatus", "o_totalprice")
    source = target.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return merge_rows(target, source, ["k"])


@query
def curated_upsert(spark, sf_dir):
    tables = _fresh_tables(spark)
    build_staging(tables, _raw(spark, sf_dir, bed.FULL), bed.AS_OF)
    build_curated(tables)
    build = build_staging(tables, _raw(spark, sf_dir, bed.CORRECTION), bed.AS_OF)
    build_curated(tables, build.touched)
    return tables.read("curated").select(*CURATED.names)


@query
def merge_customer_orders(spark, sf_dir):
    """Unconditional MERGE without a table: open orders overwrite, older or not."""
    orders = bed.read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"
    )
    by_date = ("o_orderdate", ["o_orderkey"])
    target = latest_per_key(orders.filter("o_orderstatus <> 'O'"), ["o_custkey"], *by_date)
    source = latest_per_key(orders.filter("o_orderstatus = 'O'"), ["o_custkey"], *by_date)
    return merge_rows(target, source, ["o_custkey"])


# Daily rollups


@query
def daily_metrics_query(spark, sf_dir):
    return daily_metrics(staging_rows(_raw(spark, sf_dir), bed.AS_OF))


@query
def daily_change(spark, sf_dir):
    daily = daily_metrics(staging_rows(_raw(spark, sf_dir), bed.AS_OF))
    return with_change(daily).select(*CURATED.names)


@query
def orders_daily_change(spark, sf_dir):
    orders = bed.read(spark, sf_dir, "orders")
    daily = daily_metrics(
        orders, "o_custkey", "o_orderdate", "o_totalprice", volume="o_totalprice", market_cap=None
    )
    return with_change(daily)


@query
def lineitem_daily_change(spark, sf_dir):
    lines = bed.read(spark, sf_dir, "lineitem")
    daily = daily_metrics(
        lines, "l_suppkey", "l_shipdate", "l_extendedprice", volume="l_quantity", market_cap=None
    )
    return with_change(daily)


# Work items and run status


def _customer_items(spark, sf_dir) -> DataFrame:
    """The days around each customer's last order, as far as the customer ever ordered."""
    last = (
        bed.read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last"))
    )
    start = F.greatest("first", F.date_sub("last", WEEK_DAYS - 1))
    return work_items(last, start, F.col("last"), entity="o_custkey")


def _event_items(spark, sf_dir) -> DataFrame:
    spans = (
        bed.read(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("entity"))
        .agg(F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last"))
    )
    return work_items(spans, F.col("first"), F.col("last"))


@query
def work_items_query(spark, sf_dir):
    return _event_items(spark, sf_dir)


@query
def loaded_counts_query(spark, sf_dir):
    return loaded_counts(bed.read(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query
def pending_items(spark, sf_dir):
    orders = bed.read(spark, sf_dir, "orders")
    return pending(_customer_items(spark, sf_dir), orders, "o_custkey", "o_orderdate")


@query
def landed_semi(spark, sf_dir):
    orders = bed.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("entity"), F.to_date("o_orderdate").alias("run_date")
    )
    return landed_exists(_customer_items(spark, sf_dir), orders)


def _faulty_status(spark, sf_dir) -> DataFrame:
    items = _event_items(spark, sf_dir)
    outcomes = with_missing(bed.faulty_from_events(spark, sf_dir, FAULTS_INGESTED))
    return run_status(items, outcomes)


@query
def run_status_query(spark, sf_dir):
    return _faulty_status(spark, sf_dir)


@query
def run_summary_query(spark, sf_dir):
    return run_summary(_faulty_status(spark, sf_dir), by=["entity"])


@query
def failed_dates_query(spark, sf_dir):
    return failed_dates(bed.customer_status(spark, sf_dir), by=["pipeline_name"])


@query
def resume_max_success(spark, sf_dir):
    return resume_point(bed.customer_status(spark, sf_dir), "max_success")


@query
def resume_contiguous(spark, sf_dir):
    return resume_point(bed.customer_status(spark, sf_dir), "contiguous")


# State


@query
def state_latest(spark, sf_dir):
    return latest_state(bed.customer_state(spark, sf_dir))


@query
def state_upsert(spark, sf_dir):
    tables = _fresh_tables(spark)
    rows = bed.customer_state(spark, sf_dir)
    later = F.col("updated_at") >= F.lit(STATE_SPLIT)
    tables.upsert("state", latest_state(rows.filter(later)))
    tables.upsert("state", latest_state(rows.filter(~later)))
    return tables.read("state").select(*STATE.names)


@query
def run_window_query(spark, sf_dir):
    pipelines = bed.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("pipeline_name")
    )
    return run_window(bed.customer_state(spark, sf_dir), pipelines, WINDOW_AS_OF)


# Whole runs


@query
def land_and_load(spark, sf_dir):
    path = scratch_path(spark, "landing")
    land(_raw(spark, sf_dir), path)
    landed = load_landed(spark, path, start=date(2024, 1, 10), end=date(2024, 1, 25))
    tables = _fresh_tables(spark)
    tables.load(landed, "first")
    return point_counts(tables.raw()).drop("payload", "load_id")


@query
def load_report(spark, sf_dir):
    """What a load of good and bad envelopes reports, beside what the tables hold afterwards."""
    tables = _fresh_tables(spark)
    report = tables.load(bed.faulty_from_events(spark, sf_dir, FAULTS_INGESTED), "first")
    counts = tables.read("intake").agg(
        F.count_if(F.col("outcome") == "loaded").alias("raw_rows"),
        F.count_if(F.col("outcome") == "rejected").alias("quarantined_rows"),
    )
    reported = {"rows_loaded": report.rows_loaded, "rows_rejected": report.rows_rejected}
    return counts.withColumns({k: F.lit(v).cast("bigint") for k, v in reported.items()})


@query
def quarantine(spark, sf_dir):
    tables = _fresh_tables(spark)
    tables.load(bed.faulty_from_events(spark, sf_dir, FAULTS_INGESTED), "first")
    lacking = F.array_join("missing", ",").alias("missing")
    return tables.rejected().select("entity", "run_date", "ingestion_time", lacking)


@query
def backfill_state(spark, sf_dir):
    """A complete backfill moves its pointer to its day."""
    tables = _fresh_tables(spark)
    landed = _raw(spark, sf_dir, bed.FULL).withColumn("run_date", F.to_date("ingestion_time"))
    day = bed.FULL.ingested.date()
    backfill(landed, tables, bed.entities(spark, sf_dir), day, advance_state=True, now=BACKFILL_NOW)
    return tables.read("state").select(*STATE.names)


@query
def backfill_curated(spark, sf_dir):
    """Two backfill days; repeating the first one loads nothing again."""
    tables = _fresh_tables(spark)
    # A backfill lands everything under the day it runs.
    landed = _raw(spark, sf_dir).withColumn("run_date", F.to_date("ingestion_time"))
    entities = bed.entities(spark, sf_dir)
    for day in (date(2024, 2, 1), date(2024, 2, 1), date(2024, 2, 2)):
        backfill(landed, tables, entities, day)
    return tables.read("curated").select(*CURATED.names)


@query
def incremental_curated(spark, sf_dir):
    """A first run with bad days stops the pointer; the next one, a day later, picks up from there."""
    tables = _fresh_tables(spark)
    days = bed.event_days(spark, sf_dir)
    if days:
        first, last = days
        entities, next_day = bed.entities(spark, sf_dir), last + timedelta(days=1)
        faulty = bed.faulty_from_events(spark, sf_dir, datetime.combine(last, time()))
        incremental(faulty, tables, entities, last, first_run_days=(last - first).days)
        repaired = _raw(spark, sf_dir, bed.Delivery(datetime.combine(next_day, time())))
        incremental(repaired, tables, entities, next_day)
    return tables.read("curated").select(*CURATED.names)


@query
def state_after_runs(spark, sf_dir):
    """Two runs of one pipeline leave one row of state, that of the later one."""
    tables = _fresh_tables(spark)
    landed = _raw(spark, sf_dir, bed.FULL, bed.CORRECTION).withColumn("run_date", F.to_date("ingestion_time"))
    entities = landed.select("entity").distinct()
    for delivery in (bed.FULL, bed.CORRECTION):
        sent = landed.filter(F.col("ingestion_time") == F.lit(delivery.ingested))
        day, known = delivery.ingested.date(), entities.join(sent.select("entity").distinct(), "entity", "left_semi")
        backfill(sent, tables, known, day, advance_state=True, now=delivery.ingested)
    return tables.read("state").select(*STATE.names)


@query
def packed_loads(spark, sf_dir):
    """Rows of each load after the loads were packed, and how many folders hold them."""
    tables = _fresh_tables(spark)
    tables.load(bed.faulty_from_events(spark, sf_dir, FAULTS_INGESTED), "faulty")
    for name, delivery in (("stale", bed.STALE), ("full", bed.FULL), ("again", bed.FULL)):
        tables.load(_raw(spark, sf_dir, delivery), name)
    tables.pack()
    stored = tables.read("intake")
    folders = stored.groupBy("outcome", "ingestion_date").agg(F.countDistinct("batch").alias("folders"))
    rows = stored.groupBy("outcome", "ingestion_date", "load_id").agg(F.count(F.lit(1)).alias("row_count"))
    return rows.join(folders, ["outcome", "ingestion_date"])


@query
def load_broken_lines(spark, sf_dir):
    """What each day's landed files came to: envelopes, rejected ones, and lines that break off."""
    tables, path = _fresh_tables(spark), scratch_path(spark, "landing")
    bed.land_broken(bed.faulty_from_events(spark, sf_dir, FAULTS_INGESTED), path)
    tables.load(load_landed(spark, path, bad="keep"), "first")
    day = F.to_date(F.regexp_extract("source_file", r"by_date=([0-9-]+)/", 1)).alias("run_date")
    counts = [F.sum(c).alias(c) for c in ("rows_loaded", "rows_rejected", "rows_corrupt")]
    return tables.files_of("first").groupBy(day).agg(*counts)


@query
def landed_week(spark, sf_dir):
    """Envelopes of some days, from those days' folders alone."""
    path = scratch_path(spark, "landing")
    land(_raw(spark, sf_dir, bed.FULL, bed.CORRECTION), path)
    days = load_landed_days(spark, path, WEEK, WEEK + timedelta(days=WEEK_DAYS - 1))
    return days.groupBy("entity", "run_date").agg(F.count(F.lit(1)).alias("envelopes"))


@query
def staging_good_points(spark, sf_dir):
    """Points that are no numbers do not keep the others from staging."""
    tables = _unpriced(spark, sf_dir)
    return tables.read("staging").select(*STAGING.names)


@query
def points_quarantine(spark, sf_dir):
    """The points that were kept apart, each once however often its envelope was built from."""
    tables = _unpriced(spark, sf_dir)
    build_staging(tables, tables.raw(), bed.AS_OF, bad_points="quarantine")
    shown = {"price_text": "prices", "market_cap_text": "market_caps"}
    texts = [F.get_json_object("point", f"$.{array}[1]").alias(name) for name, array in shown.items()]
    return tables.read("bad_points").select("entity", "ingestion_time", "position", *texts)


def _unpriced(spark, sf_dir) -> Tables:
    tables = _fresh_tables(spark)
    tables.load(bed.unpriced_from_events(spark, sf_dir, bed.FULL.ingested), "first")
    build_staging(tables, tables.raw(), bed.AS_OF, bad_points="quarantine")
    return tables


@query
def configured_items(spark, sf_dir):
    """Work items for the entities of a configuration table: customers' market segments."""
    segments = configured(bed.read(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal > 0")
    return work_items(segments, WEEK, WEEK + timedelta(days=WEEK_DAYS - 1))


@query
def stream_staging(spark, sf_dir):
    tables = _fresh_tables(spark)
    landing = scratch_path(spark, "landing")
    land(_raw(spark, sf_dir), landing, layout=("by_date",))
    stream = incremental_stream(
        landing, tables, scratch_path(spark, "stream"), bed.AS_OF, lookback_days=1, stream_name="check"
    )
    stream.awaitTermination()
    return tables.read("staging").select(*STAGING.names)
