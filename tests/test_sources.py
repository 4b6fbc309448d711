"""Landing files and table layout."""

import json
from datetime import date

import pytest
from core_helpers import TWO_POINTS, rows, utc

from tidemark.functions import iso_utc, landing_key, zero_pad
from tidemark.operators import keyword_scan
from tidemark.schemas import LANDED, TABLES
from tidemark.sources import create_tables, land, load_landed

NOW = utc(2024, 2, 1, 12, 30, 15, 123456)


def test_round_trip_keeps_every_value(spark, landed, tmp_path):
    df = landed(("btc", NOW, TWO_POINTS), ("007", NOW, "{}"), ("a/b:c", NOW, None))
    land(df, str(tmp_path))
    back = load_landed(spark, str(tmp_path))
    assert back.schema.names == [*LANDED.names, "by_date", "source_file", "corrupt"]
    assert rows(back.fillna("none", "payload"), *LANDED.names) == rows(df.fillna("none", "payload"))


def test_folders_by_entity_and_date(spark, landed, tmp_path):
    land(landed(("btc", NOW, "{}", date(2024, 1, 5))), str(tmp_path))
    assert len(list(tmp_path.glob("by_date=2024-01-05/by_entity=btc/*.json"))) == 1


def test_landing_by_date_only(spark, landed, tmp_path):
    land(landed(("btc", NOW, "{}", date(2024, 1, 5))), str(tmp_path), layout=("by_date",))
    assert len(list(tmp_path.glob("by_date=2024-01-05/*.json"))) == 1
    assert rows(load_landed(spark, str(tmp_path)), "entity") == [("btc",)]


def test_date_bounds_prune_folders(spark, landed, tmp_path):
    land(landed(*[("a", NOW, "{}", date(2024, 1, d)) for d in (1, 2, 3, 4)]), str(tmp_path))
    df = load_landed(spark, str(tmp_path), start=date(2024, 1, 2), end=date(2024, 1, 3))
    assert rows(df, "run_date") == [(date(2024, 1, 2),), (date(2024, 1, 3),)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "by_date" in partition_filters


def write_json(path, **fields):
    path.write_text(json.dumps(fields) + "\n")
    return str(path)


def test_one_file_and_a_list_of_files(spark, tmp_path):
    one = write_json(tmp_path / "one.json", ingestion_time="2024-02-01T00:00:00.000000+00:00", entity="a", days_requested=2, payload="{}")
    two = write_json(tmp_path / "two.json", ingestion_time="2024-02-01T05:00:00+05:00", entity="b", days_requested=2, payload="{}")
    assert rows(load_landed(spark, one), "entity") == [("a",)]
    both = load_landed(spark, [one, two])
    assert rows(both.selectExpr("entity", "unix_seconds(ingestion_time)")) == [("a", 1706745600), ("b", 1706745600)]


def test_unknown_field_is_dropped_and_absent_field_is_null(spark, tmp_path):
    path = write_json(tmp_path / "x.json", entity="a", surprise=[1, 2], payload="{}")
    df = load_landed(spark, path)
    assert df.columns == [*LANDED.names, "by_date", "source_file", "corrupt"]
    assert rows(df, "entity", "days_requested", "ingestion_time") == [("a", None, None)]


@pytest.mark.parametrize("bad", [{"ingestion_time": "yesterday"}, {"days_requested": "many"}])
def test_value_of_the_wrong_type_fails_the_load(spark, tables, tmp_path, bad):
    path = write_json(tmp_path / "x.json", **{"entity": "a", "payload": "{}", **bad})
    with pytest.raises(Exception):
        tables.load(load_landed(spark, path), "x")
    assert tables.raw().count() == 0


def test_load_reports_and_separates_rejects(landed, tables):
    df = landed(("a", NOW, TWO_POINTS), ("b", NOW, TWO_POINTS), ("c", NOW, "{}"))
    report = tables.load(df, "run-1")
    assert (report.rows_loaded, report.rows_rejected) == (2, 1)
    assert rows(tables.raw(), "entity", "ingestion_date", "load_id") == [
        ("a", date(2024, 2, 1), "run-1"),
        ("b", date(2024, 2, 1), "run-1"),
    ]
    assert [(r["entity"], r["missing"]) for r in tables.rejected().collect()] == [
        ("c", ["prices", "market_caps", "total_volumes"])
    ]


def test_loads_append_and_a_replaced_load_does_not_double(landed, tables):
    df = landed(("a", NOW, TWO_POINTS))
    tables.load(df, "run-1")
    tables.load(df, "run-2")
    assert tables.raw().count() == 2
    tables.load(df, "run-2", replace=True)
    assert tables.raw().count() == 2


def test_create_is_idempotent_and_typed(spark, landed, tmp_path):
    tables = create_tables(spark, str(tmp_path / "t"))
    tables.load(landed(("a", NOW, TWO_POINTS)), "1")
    again = create_tables(spark, str(tmp_path / "t"))
    assert again.raw().count() == 1
    for name, spec in TABLES.items():
        assert again.read(name).schema == spec.full_schema


def test_keys_and_text(spark):
    df = spark.createDataFrame([("btc", date(2024, 1, 5), NOW, 7, 1234)], "e string, d date, t timestamp, n int, m int")
    row = df.select(
        landing_key(df.e, df.d, df.t), iso_utc(df.t), zero_pad("n"), zero_pad("m")
    ).first()
    iso = "2024-02-01T12:30:15.123456+00:00"
    assert tuple(row) == (f"raw/btc/2024-01-05/{iso}.json", iso, "007", "1234")


def test_keyword_scan_reads_the_whole_text(spark):
    texts = ["x" * 50000 + "net weight", "net weigh", "a.net weight.b", None, "net%weight"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert rows(keyword_scan(df, "net weight"), "doc_id") == [(0,), (2,)]
    assert rows(keyword_scan(df, "%"), "doc_id") == [(4,)]
