import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import at
from widefold.functions.maps import any_group_has, first_group_with, map_value
from widefold.functions.times import check_chunk_minutes, chunk_of, days_between, month_key, start_of, window_end
from widefold.model import group_columns
from widefold.operators import discovery
from widefold.sources.wide import count_where, scan


def test_keys_are_distinct_and_not_blank(wide):
    fact = wide(
        [
            {"customerId": 1, "metricIntGroup1": {"b": 1, "a": 2, " \t": 3, "": 4}},
            {"customerId": 1, "metricIntGroup15": {"a": 2, "　": 1}, "metricFloatGroup3": {"x": 1.5}},
            {"customerId": 2, "metricIntGroup2": None, "metricFloatGroup15": {"y": 1.0}},
            {"customerId": 3},
        ]
    )
    entries = discovery.discover_entries(fact)
    keys = {tuple(r) for r in discovery.keys_of(entries).collect()}
    assert keys == {(1, "int", "a"), (1, "int", "b"), (1, "float", "x"), (2, "float", "y")}
    assert {r[0] for r in discovery.tenants_of(entries).collect()} == {1, 2, 3}
    lists = {(r["customer_id"], r["kind"], r["group_no"]): r["keys"] for r in discovery.key_lists(entries).collect()}
    assert lists == {(1, "int", 1): ["a", "b"], (1, "int", 15): ["a"], (1, "float", 3): ["x"], (2, "float", 15): ["y"]}


def test_tag_keys_of_several_days_are_united(wide):
    fact = wide(
        [
            {"customerId": 1, "timestampMs": at(0), "tagGroup1": {"old": "v"}},
            {"customerId": 1, "timestampMs": at(days=1), "tagGroup9": {"new": "v"}},
        ]
    )
    assert {r["key"] for r in discovery.discover_keys(fact, ("string",)).collect()} == {"old", "new"}


def test_range_is_half_open_and_holds_the_last_second(wide):
    fact = wide([{"timestampMs": t} for t in (at(59, 59, 500), at(60), at(0))])
    assert scan(fact, "2024-01-01 00:00:00", "2024-01-01 01:00:00").count() == 2
    assert count_where(fact, F.col("timestampMs") >= F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")).first()[0] == 1
    with pytest.raises(ValueError):
        scan(fact, start="2024-01-01 00:00:00")


def test_day_list_fills_gaps_and_chunks_fill_days(wide):
    fact = wide([{"customerId": 1, "timestampMs": at(5)}, {"customerId": 1, "timestampMs": at(days=2, minutes=125)}])
    days = [r["event_date"] for r in discovery.day_list(fact).orderBy("event_date").collect()]
    assert days == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    grid = {r["chunk_start"]: r["raw_rows"] for r in discovery.chunk_grid(fact, 120).collect()}
    assert len(grid) == 36
    assert {k: v for k, v in grid.items() if v} == {at(0): 1, at(days=2, minutes=120): 1}


def test_reversed_days_fail(spark):
    with pytest.raises(Exception, match="before first day"):
        spark.range(1).select(
            days_between(F.lit("2024-01-02").cast("date"), F.lit("2024-01-01").cast("date"))
        ).collect()


@pytest.mark.parametrize("minutes", [0, -5, 7, 90, 1441])
def test_bad_chunk_minutes(minutes):
    with pytest.raises(ValueError):
        check_chunk_minutes(minutes)


def test_truncation_does_not_depend_on_the_session_zone(spark):
    moment = dt.datetime(2024, 3, 10, 2, 30, 15, 250500)
    df = spark.createDataFrame([(moment,)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(
            *[start_of(g, "ts").alias(g) for g in ("millisecond", "minute", "hour", "day")],
            chunk_of(F.col("ts"), 20).alias("chunk"),
            month_key("ts").alias("month"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["millisecond"] == dt.datetime(2024, 3, 10, 2, 30, 15, 250000)
    assert row["minute"] == dt.datetime(2024, 3, 10, 2, 30)
    assert row["hour"] == dt.datetime(2024, 3, 10, 2)
    assert row["day"] == dt.datetime(2024, 3, 10)
    assert row["chunk"] == dt.datetime(2024, 3, 10, 2, 20)
    assert row["month"] == 202403
    assert window_end("2024-01-01 00:00:00", 6) == dt.datetime(2024, 1, 1, 6)


def test_map_expressions_take_null_maps(wide):
    fact = wide([{"metricIntGroup1": None, "metricIntGroup3": {"k": 7}}, {"metricIntGroup1": {"j": 1}}])
    groups = group_columns("int")
    rows = fact.select(
        any_group_has(groups, "k").alias("has"),
        first_group_with(groups, "k").alias("first"),
        map_value("metricIntGroup3", "k").alias("value"),
    ).collect()
    assert [tuple(r) for r in rows] == [(True, "metricIntGroup3", 7), (False, None, 0)]


def test_one_scan_reads_only_the_maps(wide, spark, tmp_path):
    path = str(tmp_path / "wide")
    wide([{"metricIntGroup1": {"a": 1}}]).write.parquet(path)
    plan = discovery.discover_entries(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "tagGroup" not in plan and "platform" not in plan
