"""Loads of parts of days, repeated and stopped loads, and the record that makes them visible."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import at
from widefold.plans import day_load
from widefold.plans.day_load import load_days
from widefold.sources import loads
from widefold.sources.flat import read_flat

DAYS = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]
NOON = "2024-01-01 12:00:00"


def fact_of(wide, value=1, tenants=(1, 2)):
    """A row of each tenant every four hours of two days."""
    return wide([
        {"customerId": c, "clientId": f"c{h}", "timestampMs": at(60 * h), "metricIntGroup1": {"k": value}}
        for c in tenants for h in range(0, 48, 4)
    ])


def stored(load):
    return sorted((r["customerId"], r["timestampMs"].day, r["timestampMs"].hour, r["int1"]) for r in load.flat.collect())


def wanted(values, tenants=(1, 2)):
    return sorted((c, 1 + h // 24, h % 24, values(c, h)) for c in tenants for h in range(0, 48, 4))


def test_half_days_make_a_day_in_any_order(wide, tmp_path):
    fact, path = fact_of(wide), str(tmp_path / "flat")
    halves = [(DAYS[0], NOON), (NOON, DAYS[1]), (DAYS[1], DAYS[2])]
    for n, order in enumerate(([0, 1, 2], [2, 1, 0], [1, 0, 1, 2, 2, 0])):
        for i in order:
            load = load_days(fact, f"{path}{n}", *halves[i])
        assert stored(load) == wanted(lambda c, h: 1)


def test_a_part_of_a_day_is_replaced_and_the_rest_stays(wide, tmp_path):
    path = str(tmp_path / "flat")
    load_days(fact_of(wide), path, DAYS[0], DAYS[2])
    load = load_days(fact_of(wide, 5), path, NOON, "2024-01-02 08:00:00")
    assert stored(load) == wanted(lambda c, h: 5 if 12 <= h < 32 else 1)
    # Tenant 1 is no longer in the fact.
    load = load_days(fact_of(wide, 7, (2,)), path, NOON, DAYS[1])
    rest = [r for r in wanted(lambda c, h: 7 if c == 2 and 12 <= h < 24 else 5 if 24 <= h < 32 else 1)]
    assert stored(load) == [r for r in rest if not (r[0] == 1 and r[1] == 1 and r[2] >= 12)]


def test_a_whole_range_that_has_no_rows_left_is_empty(wide, tmp_path):
    path = str(tmp_path / "flat")
    load_days(fact_of(wide), path, DAYS[0], DAYS[2])
    load = load_days(fact_of(wide).where("false"), path, DAYS[0], DAYS[1])
    assert {r[1] for r in stored(load)} == {2}
    assert load_days(fact_of(wide).where("false"), path, DAYS[1], DAYS[2]).flat.count() == 0
    assert stored(load_days(fact_of(wide), path)) == wanted(lambda c, h: 1)


def test_given_tenants_alone_are_replaced(wide, tmp_path):
    path = str(tmp_path / "flat")
    load_days(fact_of(wide), path, DAYS[0], DAYS[2])
    load = load_days(fact_of(wide, 3), path, DAYS[0], DAYS[1], tenants=[2])
    assert stored(load) == wanted(lambda c, h: 3 if c == 2 and h < 24 else 1)
    assert [tuple(r) for r in loads.load_history(load.flat.sparkSession, path).orderBy("number").select("tenants").collect()] == [(None,), ([2],)]


def test_append_adds_and_replace_begins_anew(wide, tmp_path):
    path = str(tmp_path / "flat")
    load_days(fact_of(wide), path, DAYS[0], DAYS[2])
    load = load_days(fact_of(wide, 2), path, NOON, DAYS[1], mode="append")
    assert len(stored(load)) == 24 + 6
    # A repeated load of the range takes both away.
    assert stored(load_days(fact_of(wide, 4), path, DAYS[0], DAYS[1])) == wanted(lambda c, h: 4 if h < 24 else 1)
    assert {r[1] for r in stored(load_days(fact_of(wide), path, DAYS[1], DAYS[2], mode="replace"))} == {2}


@pytest.mark.parametrize("grain, end", [("minute", "2024-01-01 12:00:30"), ("hour", "2024-01-01 12:30:00"), ("day", NOON)])
def test_a_range_that_cuts_a_grain_is_refused(wide, tmp_path, grain, end):
    with pytest.raises(ValueError, match=f"cuts a {grain}"):
        load_days(fact_of(wide), str(tmp_path / "flat"), DAYS[0], end, grain)


def test_other_bad_calls_are_refused(wide, tmp_path):
    path = str(tmp_path / "flat")
    for bad in ({"start": DAYS[0]}, {"start": NOON, "end": NOON}, {"mode": "merge"}):
        with pytest.raises(ValueError):
            load_days(fact_of(wide), path, **bad)


@pytest.mark.parametrize("step", ["_numbered", "flatten", "write_version", "days_of_version", "add_to_record"])
def test_a_stopped_load_changes_nothing_and_can_run_again(wide, spark, tmp_path, monkeypatch, step):
    """The load stops right after each of its steps, but for the last, before which it stops."""
    path = str(tmp_path / "flat")
    load = load_days(fact_of(wide), path, DAYS[0], DAYS[2])
    schema = load.flat.drop("eventDate").schema
    run = getattr(day_load, step)

    def stopped(*args, **kwargs):
        if step != "add_to_record":
            run(*args, **kwargs)
        raise InterruptedError(step)

    monkeypatch.setattr(day_load, step, stopped)
    with pytest.raises(InterruptedError):
        load_days(fact_of(wide, 9, (2,)), path, NOON, DAYS[1])
    rows = read_flat(spark, path, schema)
    assert stored(day_load.Load(None, None, rows)) == wanted(lambda c, h: 1)
    monkeypatch.setattr(day_load, step, run)
    again = stored(load_days(fact_of(wide, 9), path, NOON, DAYS[1]))
    assert again == wanted(lambda c, h: 9 if 12 <= h < 24 else 1)
    loads.drop_dead_versions(spark, path)
    assert stored(day_load.Load(None, None, read_flat(spark, path, schema))) == again


def test_two_loads_at_once_do_not_both_become_visible(wide, spark, tmp_path):
    path = str(tmp_path / "flat")
    load_days(fact_of(wide), path, DAYS[0], DAYS[2])
    known = loads.read_record(spark, path)
    load_days(fact_of(wide, 2), path, DAYS[0], DAYS[1])
    with pytest.raises(Exception, match="already exists"):
        loads.add_to_record(spark, path, known, known.live, "x", "partitions", "minute", None, None, None, [])


def test_history_and_dead_versions(wide, spark, tmp_path):
    path = str(tmp_path / "flat")
    load_days(fact_of(wide), path, DAYS[0], DAYS[2])
    load = load_days(fact_of(wide, 2), path, NOON, DAYS[1])
    history = loads.load_history(spark, path).orderBy("number").collect()
    assert [(r["number"], r["mode"], r["start"], r["end"]) for r in history] == [
        (1, "partitions", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)),
        (2, "partitions", dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2)),
    ]
    assert history[1]["days"] == [dt.date(2024, 1, 1)]
    assert loads.drop_dead_versions(spark, path) == 1
    assert stored(load) == wanted(lambda c, h: 2 if 12 <= h < 24 else 1)
    assert loads.drop_dead_versions(spark, path) == 0


def test_whole_days_are_not_read_again_and_dead_versions_are_pruned(wide, spark, tmp_path):
    path = str(tmp_path / "flat")
    load_days(fact_of(wide), path, DAYS[0], DAYS[2])
    known = loads.read_record(spark, path)
    load = load_days(fact_of(wide, 2), path, DAYS[0], DAYS[1])
    span = (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert day_load._kept(None, load.flat, span, None, known) is None
    files = {r[0] for r in load.flat.select(F.input_file_name()).distinct().collect()}
    live = loads.read_record(spark, path).live
    assert {f.split("version=")[1].split("/")[0] for f in files} == {v for vs in live.values() for v in vs}
    plan = load.flat._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "array_contains(map(" in scan.split("PartitionFilters:")[1]
