"""Every registered query against DuckDB on the smallest test tables."""

import pytest
from pyspark.sql import functions as F

import check
from tidemark.checks import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    assert check.compare(spark, con, name, SF) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_every_copy_of_an_event_is_sent(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    copies = events.filter("event_id IN (500, 740)").withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("again")
    sf_dir = tmp_path / "sf"
    sf_dir.mkdir()
    events.unionByName(copies).toPandas().astype({"ts": "datetime64[us]"}).to_parquet(sf_dir / "events.parquet")
    con = check.oracle_connection(sf_dir)
    for name in ("flatten_series", "flatten_shortest", "valid_payloads", "land_and_load", "daily_change"):
        assert check.compare(spark, con, name, str(sf_dir)) == ""
    late = events.filter("event_id IN (500, 740)").filter("ts >= '2024-01-16' AND event_id <> 740").count()
    more = queries()["flatten_series"](spark, str(sf_dir)).count() - queries()["flatten_series"](spark, SF).count()
    assert more == 500 * (2 * copies.select("event_id").distinct().count() + late)


def test_large_values_are_not_cut_off(spark):
    from tidemark.checks.queries import _edge

    got = _edge(spark.createDataFrame([(9.3e12,), (1.5e300,), (-2e13,), (0.1234567891,)], "x double"))
    assert [r.x for r in got.collect()] == [9.3e12, 1.5e300, -2e13, 0.123457]
