"""What the physical plans must and must not contain."""

import re
from datetime import date

import pytest
from core_helpers import TWO_POINTS, utc
from pyspark.sql import functions as F

from tidemark.checks import testbed
from tidemark.checks.queries import queries
from tidemark.operators import (
    daily_metrics,
    flatten_series,
    latest_per_key,
    merge_rows,
    pending,
    recent,
    resume_point,
    work_items,
)
from tidemark.schemas import STAGING
from tidemark.sources.tables import in_partitions

SF = "/root/testdata/sf0.001"
WRITING = {
    "staging_upsert", "staging_upsert_twice", "staging_upsert_only_if_newer", "curated_upsert",
    "staging_upsert_older_wins", "load_report", "quarantine", "backfill_state", "state_upsert", "land_and_load", "backfill_curated", "incremental_curated", "stream_staging",
    "state_after_runs", "packed_loads", "load_broken_lines", "landed_week", "staging_good_points", "points_quarantine",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return plan(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", sorted(set(queries()) - WRITING))
def test_no_query_crosses_or_leaves_the_jvm(spark, name):
    text = plan(queries()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Exchange SinglePartition"):
        assert node not in text


def test_latest_per_key_prunes_before_its_only_shuffle(spark):
    events = testbed.read(spark, SF, "events")
    text = plan(latest_per_key(events, ["user_id"], "ts", ["event_id"]))
    assert text.count("Exchange hashpartitioning") == 1
    before_shuffle = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_flatten_needs_no_shuffle_and_parses_once(spark, landed):
    raw = landed(("a", utc(2024, 2, 1), TWO_POINTS))
    text = plan(flatten_series(raw))
    assert "Exchange" not in text
    assert "Generate posexplode" in text


def test_daily_metrics_aggregate_before_the_shuffle(spark):
    orders = testbed.read(spark, SF, "orders")
    df = daily_metrics(orders, "o_custkey", "o_orderdate", "o_totalprice", None, None)
    text = plan(df)
    assert shuffles(df) == 1
    assert "partial_avg" in text.split("Exchange hashpartitioning")[1]
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:\w+>", text)


def test_recent_prunes_raw_partitions(landed, tables):
    tables.load(landed(("a", utc(2024, 2, 1), TWO_POINTS)), "x")
    text = plan(recent(tables.raw(), date(2024, 2, 1)))
    filters = text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "ingestion_date" in filters and "outcome" in filters


def test_upsert_reads_only_touched_partitions(spark, tables):
    point = [("a", utc(2024, 1, d), 1.0, 1.0, 1.0, utc(2024, 2, 1)) for d in (1, 2)]
    tables.upsert("staging", spark.createDataFrame(point, STAGING))
    target = tables.read("staging").filter(in_partitions("event_date", [date(2024, 1, 1), None]))
    text = plan(target)
    assert "event_date" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_merge_sends_only_source_keys_through_the_join(spark, tables):
    staging = tables.read("staging")
    text = plan(merge_rows(staging, staging, ["entity", "event_time"]))
    assert "LeftAnti" in text
    build = text.split("LeftAnti")[1].split("ReadSchema: ")[2].split("\n")[0]
    assert build == "struct<entity:string,event_time:timestamp>"


def test_pending_reduces_loads_before_the_join(spark):
    orders = testbed.read(spark, SF, "orders")
    customers = testbed.read(spark, SF, "customer")
    items = work_items(customers, date(1998, 3, 1), date(1998, 3, 7), "c_custkey")
    text = plan(pending(items, orders, "o_custkey", "o_orderdate"))
    assert "HashAggregate" in text and "LeftAnti" in text


def test_contiguous_resume_point_shuffles_by_pipeline(spark):
    status = testbed.customer_status(spark, SF)
    text = plan(resume_point(status, "contiguous"))
    assert "SinglePartition" not in text


def test_loads_move_no_payload_whatever_the_broadcast_limit(spark, landed, tables, monkeypatch):
    from tidemark.plans.results import load_entities

    plans = []
    monkeypatch.setattr(tables, "load", lambda df, run_id: plans.append(plan(df)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        entities = testbed.entities(spark, SF)
        load_entities(tables, landed(("a", utc(2024, 2, 1), TWO_POINTS)), entities, "x")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0] and "Exchange hashpartitioning" not in plans[0]


def test_increments_prune_months_in_every_scan_of_curated(spark, tables):
    from tidemark.operators import nearest_days
    from tidemark.plans.layers import changed_rows
    from tidemark.schemas import CURATED

    values = {"entity": F.lit("a"), "date": F.lit(date(2024, 1, 4))}
    row = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CURATED.fields]
    tables.append("curated", spark.range(1).select(*row))
    curated, staging = tables.read("curated"), tables.read("staging")
    fresh = daily_metrics(staging)
    near = nearest_days(curated.filter(F.col("month").isin(date(2024, 1, 1))), fresh.select("entity"), date(2024, 1, 5), True, ["avg_price"])
    text = plan(changed_rows(staging, curated, [date(2024, 1, 5), date(2024, 2, 3)], near, fresh.limit(0), fresh))
    scans = [line for line in text.splitlines() if "FileScan" in line and "avg_price" in line]
    assert len(scans) == 2 and all(re.search(r"PartitionFilters: \[.*month#\d+ ([<>]=|=)", line) for line in scans), text


def test_status_is_aggregated_without_sorting(spark):
    assert "SortAggregate" not in plan(queries()["run_status"](spark, SF))
