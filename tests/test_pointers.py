"""Resume pointers under runs beside each other."""

from datetime import date
from pathlib import Path

import pytest
from core_helpers import rows, utc

from tidemark.operators import last_processed, latest_state
from tidemark.schemas import STATE
from tidemark.sources.pointers import Pointer

D = {d: date(2024, 1, d) for d in range(1, 20)}
NOW, LATER = utc(2024, 2, 1), utc(2024, 2, 2)


def test_first_move_and_next(tables):
    assert tables.pointer("p") == Pointer(0, None)
    moved = tables.move_pointer("p", tables.pointer("p"), D[5], NOW)
    assert moved == tables.pointer("p") == Pointer(1, D[5])
    assert tables.move_pointer("p", moved, D[6], LATER) == Pointer(2, D[6])
    assert rows(tables.read("state").select(*STATE.names)) == [("p", D[6], LATER.replace(tzinfo=None))]


@pytest.mark.parametrize("first, second, stays", [(9, 7, 9), (7, 9, 9), (8, 8, 8)])
def test_two_runs_that_saw_the_same_pointer(tables, first, second, stays):
    """Both begin, the first one ends, then the second: the later date stays, whoever brings it."""
    start = tables.move_pointer("p", tables.pointer("p"), D[5], NOW)
    one, other = tables.pointer("p"), tables.pointer("p")
    assert one == other == start
    tables.move_pointer("p", one, D[first], NOW)
    told = tables.move_pointer("p", other, D[second], LATER)
    assert told.processed == tables.pointer("p").processed == D[stays]
    assert tables.read("state").count() == 1


def test_interleaved_incremental_runs(tables, landed, spark, monkeypatch):
    """A whole run of the pipeline happens while another one is between its window and its pointer."""
    from core_helpers import payload

    from tidemark.plans import incremental
    from tidemark.plans import incremental as module  # the function; its module is looked up below
    import sys

    plan = sys.modules["tidemark.plans.incremental"]
    assert module is incremental
    coins = spark.createDataFrame([("a",)], "entity string")
    sent = landed(*[("a", utc(2024, 1, 10), payload([[int(utc(2024, 1, d).timestamp() * 1000), float(d)]]), D[d]) for d in (7, 8, 9, 10)])
    real, inner = plan.transform, []

    def beside(*args):
        if not inner:
            inner.append(None)
            inner[0] = incremental(sent, tables, coins, D[11], first_run_days=4)
        return real(*args)

    monkeypatch.setattr(plan, "transform", beside)
    outer = incremental(sent, tables, coins, D[10], first_run_days=3)
    assert inner[0].resume_date == D[10]
    assert outer.resume_date == tables.pointer("incremental").processed == D[10]
    assert tables.read("curated").count() == 4


def test_a_move_that_was_created_but_not_written_does_not_count(tables):
    seen = tables.move_pointer("p", tables.pointer("p"), D[5], NOW)
    Path(tables.root, "pointers", "p", "000000000002.json").touch()
    assert tables.pointer("p") == Pointer(2, D[5])
    assert rows(tables.read("state"), "last_processed_date") == [(D[5],)]
    assert tables.move_pointer("p", seen, D[6], NOW) == Pointer(3, D[6])


def test_old_moves_go(tables):
    seen = tables.pointer("p")
    for d in range(1, 9):
        seen = tables.move_pointer("p", seen, D[d], NOW)
    assert sorted(f.name for f in Path(tables.root, "pointers", "p").glob("*.json")) == ["000000000007.json", "000000000008.json"]
    assert tables.pointer("p").processed == D[8]


def test_pipelines_do_not_meet_whatever_their_names(tables):
    names = ["a", "a.b", "a/b", "ä *", "a%2Fb", "..", "A"]
    for k, name in enumerate(names, 1):
        tables.move_pointer(name, tables.pointer(name), D[k], NOW)
    assert {n: tables.pointer(n).processed for n in names} == {n: D[k] for k, n in enumerate(names, 1)}
    assert rows(tables.read("state"), "pipeline_name") == [(n,) for n in sorted(names)]


def test_a_merged_state_is_where_the_first_run_starts(spark, tables):
    tables.upsert("state", spark.createDataFrame([("p", D[3], NOW), ("q", D[4], NOW)], STATE))
    assert tables.pointer("p") == Pointer(0, D[3])
    tables.move_pointer("p", tables.pointer("p"), D[9], LATER)
    assert rows(tables.read("state"), "pipeline_name", "last_processed_date") == [("p", D[9]), ("q", D[4])]


def test_equal_times_go_to_the_later_date(spark):
    state = spark.createDataFrame([("p", D[3], NOW), ("p", D[9], NOW), ("p", D[5], NOW), ("n", D[1], None), ("n", D[2], None)], STATE)
    assert last_processed(state, "p") == D[9]
    assert rows(latest_state(state), "pipeline_name", "last_processed_date") == [("n", D[2]), ("p", D[9])]
