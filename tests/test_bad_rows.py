"""Bad points and broken lines as rows, beside everything that is good."""

import json
from datetime import date
from pathlib import Path

import pytest
from core_helpers import payload, rows, utc
from pyspark.sql import functions as F

from tidemark.plans import backfill, build_staging, incremental
from tidemark.schemas import LANDED
from tidemark.sources import configured, create_tables, land, load_landed, load_landed_days
from tidemark.streaming import incremental_stream

TODAY = date(2024, 1, 10)
NOW = utc(2024, 1, 10, 6)
MS = {day: int(utc(2024, 1, day).timestamp() * 1000) for day in range(1, 11)}


@pytest.fixture
def coins(spark):
    return spark.createDataFrame([("good",), ("mixed",)], "entity string")


def sent(landed):
    mixed = payload([[MS[8], 1.5], [MS[9], "abc"], ["soon", 2.0]], caps=[[MS[8], 1.0], [MS[9], 2.0], [MS[9], "x"]], volumes=[[MS[8], 1.0]] * 3)
    return landed(("good", NOW, payload([[MS[9], 7.0]]), TODAY), ("mixed", NOW, mixed, TODAY))


def test_bad_points_stop_a_run_unless_they_are_kept_apart(landed, tables, coins):
    with pytest.raises(Exception, match="not a valid"):
        backfill(sent(landed), tables, coins, TODAY)
    result = backfill(sent(landed), create_tables(tables.spark, tables.root), coins, TODAY, bad_points="quarantine")
    assert result and result.bad_points == 2
    assert rows(tables.read("staging"), "entity", "price") == [("good", 7.0), ("mixed", 1.5)]
    apart = tables.read("bad_points")
    assert rows(apart, "entity", "position") == [("mixed", 1), ("mixed", 2)]
    texts = {r.position: json.loads(r.point) for r in apart.collect()}
    assert texts[1]["prices"] == [str(MS[9]), "abc"] and texts[2] == {"prices": ["soon", "2.0"], "market_caps": [str(MS[9]), "x"], "total_volumes": [str(MS[8]), "1.0"]}


def test_a_repeated_build_and_a_copied_envelope_add_no_bad_points(landed, tables):
    df = sent(landed)
    tables.load(df.unionByName(df), "twice")
    for _ in range(2):
        build = build_staging(tables, tables.raw(), TODAY, bad_points="quarantine")
    assert build.bad_points == 4 and tables.read("bad_points").count() == 2
    # The same text from another envelope is another bad point.
    tables.load(df.withColumn("payload", F.concat("payload", F.lit(" "))), "other")
    build_staging(tables, tables.raw(), TODAY, bad_points="quarantine")
    assert tables.read("bad_points").count() == 4


def test_quarantine_gives_what_raise_gives_when_all_is_good(landed, spark, tmp_path, coins):
    good = sent(landed).filter("entity = 'good'")
    found = []
    for how in ("raise", "quarantine"):
        tables = create_tables(spark, str(tmp_path / how))
        result = incremental(good.withColumn("run_date", F.lit(date(2024, 1, 9))), tables, coins.limit(1), TODAY, first_run_days=1, bad_points=how)
        assert result.bad_points == 0
        found.append((rows(tables.read("staging")), rows(tables.read("curated")), tables.read("bad_points").count()))
    assert found[0] == found[1] and found[0][2] == 0
    with pytest.raises(ValueError, match="raise or quarantine"):
        build_staging(tables, tables.raw(), TODAY, bad_points="ignore")


def write_lines(path, day, *lines):
    folder = Path(path, f"by_date={day}")
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.json").write_text("".join(line + "\n" for line in lines))


def line(entity, day, **more):
    return json.dumps({"ingestion_time": "2024-01-10T06:00:00.000000+00:00", "entity": entity, "days_requested": 2, "run_date": day, "payload": payload([[MS[9], 7.0]]), **more})


@pytest.fixture
def broken(tmp_path):
    write_lines(tmp_path / "in", "2024-01-10", line("good", "2024-01-10"), '{"entity": "mix', line("mixed", "2024-01-10", days_requested="many"))
    write_lines(tmp_path / "in", "2024-01-10", line("mixed", "2024-01-10", payload="{}"))
    write_lines(tmp_path / "in", "2024-01-04", "no json at all")
    return str(tmp_path / "in")


def test_broken_lines_become_rows(spark, tables, broken):
    report = tables.load(load_landed(spark, broken, bad="keep"), "x")
    assert (report.rows_loaded, report.rows_rejected, report.rows_corrupt) == (1, 1, 3)
    assert tables.raw().count() == 1 and rows(tables.rejected(), "entity") == [("mixed",)]
    texts = [t for (t,) in rows(tables.corrupt(), "corrupt")]
    assert texts[0] == "no json at all" and texts[1] == '{"entity": "mix' and json.loads(texts[2])["days_requested"] == "many"
    per_file = {tuple(r[-3:]) for r in tables.files_of("x").collect()}
    assert tables.files_of("x").count() == 3 and per_file == {(1, 0, 2), (0, 1, 0), (0, 0, 1)}


def test_broken_lines_fail_the_load_by_default(spark, tables, broken):
    with pytest.raises(Exception):
        tables.load(load_landed(spark, broken), "x")
    with pytest.raises(ValueError, match="bad must be"):
        load_landed(spark, broken, bad="drop")


def test_a_run_takes_its_days_broken_lines_along(spark, tables, coins, broken):
    result = backfill(load_landed(spark, broken, bad="keep"), tables, coins, TODAY)
    assert (result.load.rows_loaded, result.load.rows_rejected, result.load.rows_corrupt) == (1, 1, 2)
    assert rows(tables.read("status"), "entity", "ok") == [("good", True), ("mixed", False)]


def test_days_are_read_from_their_folders_alone(spark, landed, tmp_path):
    days = [date(2024, 1, d) for d in (3, 4, 5, 6)]
    land(landed(*[(e, NOW, "{}", d) for d in days for e in ("007", "x")]), str(tmp_path))
    got = load_landed_days(spark, str(tmp_path), date(2024, 1, 4), date(2024, 1, 5))
    assert rows(got, "entity", "by_date") == [("007", days[1]), ("007", days[2]), ("x", days[1]), ("x", days[2])]
    assert {f.split("by_date=")[1][:10] for f in got.inputFiles()} == {"2024-01-04", "2024-01-05"}
    none = load_landed_days(spark, str(tmp_path), date(2025, 1, 1), date(2025, 1, 9))
    assert none.schema.names == got.schema.names and none.count() == 0


def run(tables, landing, checkpoint, **options):
    incremental_stream(landing, tables, checkpoint, **options).awaitTermination()


def test_a_stream_does_not_read_the_intake_again(spark, landed, tmp_path, monkeypatch):
    import sys

    files = sys.modules["tidemark.streaming.files"]
    tables, landing = create_tables(spark, str(tmp_path / "t")), str(tmp_path / "in")
    land(sent(landed).filter("entity = 'good'"), landing)
    plans, real = [], files.build_staging

    def seen(tables, raw, *args, **options):
        plans.append(raw._jdf.queryExecution().toString())
        return real(tables, raw, *args, **options)

    monkeypatch.setattr(files, "build_staging", seen)
    run(tables, landing, str(tmp_path / "c"))
    assert plans and all(tables.path("intake") not in text and "InMemoryTableScan" in text for text in plans)
    assert tables.read("staging").count() == 1


def test_a_replayed_batch_changes_nothing_and_packing_goes_on_beside(spark, landed, tmp_path):
    tables, landing, checkpoint = create_tables(spark, str(tmp_path / "t")), str(tmp_path / "in"), tmp_path / "c"
    for k in range(4):
        land(sent(landed).withColumn("ingestion_time", F.lit(utc(2024, 1, 10, k))), landing, layout=("by_date",))
    options = dict(max_files_per_trigger=1, stream_name="s", bad_points="quarantine", pack_every=2)
    run(tables, landing, str(checkpoint), **options)
    before = [rows(tables.raw()), rows(tables.read("staging")), rows(tables.read("curated")), rows(tables.read("bad_points"))]
    packed = list(Path(tables.root, "intake").glob("outcome=*/ingestion_date=*/batch=packed-*"))
    assert packed and before[0] and before[3]
    last = max((checkpoint / "commits").iterdir(), key=lambda f: int(f.name) if f.name.isdigit() else -1)
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    last.unlink()  # as if the run had stopped before the batch was committed
    run(tables, landing, str(checkpoint), **options)
    assert [rows(tables.raw()), rows(tables.read("staging")), rows(tables.read("curated")), rows(tables.read("bad_points"))] == before


def test_configured_entities(spark):
    table = spark.createDataFrame([(" a ", 1), ("b", 0), ("a", 1), ("", 1), (None, 1), ("c", 1)], "name string, active int")
    assert rows(configured(table, "name", "active = 1")) == [("a",), ("c",)]
    assert rows(configured(table, "name")) == [("a",), ("b",), ("c",)]


def test_pending_reads_the_dates_of_its_items_alone(spark, landed, tables):
    from tidemark.operators import pending, work_items

    tables.load(landed(*[("a", utc(2024, 1, d), payload([[MS[d], 1.0]])) for d in (2, 5, 9)]), "x")
    entities = spark.createDataFrame([("a",)], "entity string")
    items = work_items(entities, date(2024, 1, 4), date(2024, 1, 6))
    for between in (None, (date(2024, 1, 4), date(2024, 1, 6))):
        left = pending(items, tables.raw(), between=between)
        assert rows(left, "run_date") == [(date(2024, 1, 4),), (date(2024, 1, 6),)]
        spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
        filters = left._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("PushedFilters")[0]
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        assert ">= 2024-01-04" in filters and "<= 2024-01-06" in filters
    assert LANDED.names and pending(items.limit(0), tables.raw()).count() == 0
