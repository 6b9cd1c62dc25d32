"""What a task holds or reads stays bounded, whatever the size of the input."""

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import stores
from tests.conftest import at
from widefold import fixtures
from widefold.operators import preagg
from widefold.plans import checksums, day_load, task_size
from widefold.plans.day_load import load_days
from widefold.plans.stored import Stored
from widefold.sources import flat as flat_source
from widefold.sources import wide as wide_source

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def rows_of_days(wide, n):
    return wide([{"timestampMs": at(days=i % 3, minutes=i), "customerId": i % 2, "clientId": str(i)} for i in range(n)])


def test_files_of_the_raw_fact_are_bounded(spark, wide, tmp_path, monkeypatch):
    monkeypatch.setattr(wide_source, "ROWS_PER_FILE", 5)
    fact = rows_of_days(wide, 60).coalesce(1)
    wide_source.write_wide(fact, str(tmp_path / "wide"))
    back = wide_source.read_wide(spark, str(tmp_path / "wide"), by_date=True)
    files = back.groupBy(F.col("_metadata.file_path").alias("f"), "eventDate").count().collect()
    assert max(r["count"] for r in files) <= 5 and sum(r["count"] for r in files) == 60
    assert back.where(F.col("eventDate") != F.to_date("timestampMs")).count() == 0


@pytest.mark.parametrize("days", [1, 100])
def test_days_beyond_the_open_ones_are_written_too(spark, wide, tmp_path, monkeypatch, days):
    monkeypatch.setattr(wide_source, "OPEN_DAYS", days)
    before = spark.conf.get(WRITERS)
    wide_source.write_wide(rows_of_days(wide, 60).coalesce(1), str(tmp_path / "wide"))
    assert spark.conf.get(WRITERS) == before
    back = wide_source.read_wide(spark, str(tmp_path / "wide"), by_date=True)
    assert sorted(int(r["clientId"]) for r in back.select("clientId").collect()) == list(range(60))
    # One task keeps the days open side by side, so a day has one file.
    assert back.select(F.col("_metadata.file_path")).distinct().count() == 3


def test_writers_are_reset_after_an_error(spark, wide, tmp_path):
    before = spark.conf.get(WRITERS)
    wide_source.write_wide(rows_of_days(wide, 3), str(tmp_path / "wide"))
    with pytest.raises(Exception, match="(?i)exist"):
        wide_source.write_wide(rows_of_days(wide, 3), str(tmp_path / "wide"), "errorifexists")
    assert spark.conf.get(WRITERS) == before


def test_one_row_group_of_events_is_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "EVENTS_PER_TASK", 100)
    duckdb.sql(
        "COPY (SELECT range AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (range // 2) MINUTE AS ts, range % 9 AS user_id, "
        f"'view' AS event_type, 1.0 AS value, '{{}}' AS props FROM range(1000)) TO '{tmp_path}/events.parquet'"
    )
    fact = fixtures.wide_fact(spark, str(tmp_path))
    sizes = [n for n in fact.select(F.spark_partition_id().alias("p")).groupBy("p").count().toPandas()["count"]]
    assert sum(sizes) == 1000 and len(sizes) > 5 and max(sizes) < 300


def test_a_task_of_a_load_sorts_a_bounded_range(spark, wide, tmp_path, monkeypatch):
    monkeypatch.setattr(flat_source, "ROWS_PER_RANGE", 20)
    fact = rows_of_days(wide, 400)
    load = load_days(fact, str(tmp_path / "flat"))
    rows = load.flat.groupBy(F.col("_metadata.file_path").alias("f")).count().toPandas()["count"]
    assert rows.sum() == 400 and rows.max() <= 40
    again = load_days(fact.where("customerId = 1"), str(tmp_path / "flat"))
    assert again.flat.count() == 400
    assert again.flat.select("timestampMs", "clientId").exceptAll(fact.select("timestampMs", "clientId")).count() == 0


def test_a_group_is_shuffled_with_one_list_per_kind(wide):
    fact = wide([{"clientId": "a", "metricIntGroup1": {"x": 2}, "metricIntGroup9": {"x": 3, "y": 1}}] * 2 + [{"clientId": "b"}])
    rows = preagg.preaggregate(fact)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("partial_collect_list(") <= 2 * plan.count("ObjectHashAggregate(")
    got = {r["clientId"]: (r["metricIntGroup1"], r["metricIntGroup2"], r["metricIntGroup9"]) for r in rows.collect()}
    assert got == {"a": ({"x": 4}, {}, {"x": 6, "y": 2}), "b": ({}, {}, {})}


@pytest.fixture()
def pieces(spark, monkeypatch):
    """Shuffles of 40 pieces, which adaptive execution joins by their bytes alone; small tasks join none."""
    names = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
    }
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    monkeypatch.setattr(task_size, "SHUFFLED_BYTES", 1)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def loaded_files(spark, wide, tmp_path, monkeypatch):
    monkeypatch.setattr(wide_source, "ROWS_PER_FILE", 5)
    wide_source.write_wide(rows_of_days(wide, 400).coalesce(1), str(tmp_path / "wide"))
    return wide_source.read_wide(spark, str(tmp_path / "wide"), by_date=True)


def test_a_load_reads_few_files_in_a_task(spark, wide, tmp_path, monkeypatch):
    fact, seen = loaded_files(spark, wide, tmp_path, monkeypatch), []
    write = day_load.write_version

    def watched(*args):
        seen.append(wide_source.read_wide(spark, str(tmp_path / "wide"), by_date=True).rdd.getNumPartitions())
        write(*args)

    monkeypatch.setattr(day_load, "write_version", watched)
    names = (task_size.SHUFFLED, task_size.OPEN_COST)
    before = [spark.conf.get(n, None) for n in names]
    load = load_days(fact, str(tmp_path / "flat"))
    assert len(fact.inputFiles()) >= 80 and seen[0] >= len(fact.inputFiles()) // task_size.FILES_PER_TASK
    assert [spark.conf.get(n, None) for n in names] == before and load.flat.count() == 400


def test_states_of_a_grain_are_grouped_by_small_tasks(spark, wide, tmp_path, monkeypatch, pieces):
    fact = loaded_files(spark, wide, tmp_path, monkeypatch).withColumn(
        "metricIntGroup1", F.create_map(F.lit("k"), F.lit(2))
    )
    load = load_days(fact, str(tmp_path / "flat"))
    hours = stores.coarser(Stored(fact, load.flat, load.mapping, load.entries), ["minute", "hour"])
    assert len(hours.inputFiles()) > 20
    assert hours.count() == 400 and hours.agg(F.sum("int1")).first()[0] == 800


def test_tables_are_compared_by_small_tasks(spark, wide, tmp_path, pieces):
    fact, paths = rows_of_days(wide, 400), [str(tmp_path / n) for n in ("left", "right")]
    other = fact.withColumn("platform", F.lit("web"))
    left, right = (load_days(f, p).flat for f, p in zip((fact, other), paths, strict=True))
    found = checksums.compare_tables(spark, *paths, left, right)
    assert found.count() == 400 and len(found.inputFiles()) > 20


def test_stricter_settings_of_the_session_stay(spark):
    names = {task_size.SHUFFLED: "16k", task_size.OPEN_COST: "1g"}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        with pytest.raises(ZeroDivisionError), task_size.small_tasks(spark):
            inside = [spark.conf.get(n) for n in names]
            1 / 0
        assert inside == ["16384b", f"{1 << 30}b"] and [spark.conf.get(n) for n in names] == ["16k", "1g"]
    finally:
        for n in names:
            spark.conf.unset(n)


def test_a_load_log_is_made_by_small_tasks(spark, wide, tmp_path, monkeypatch):
    fact = loaded_files(spark, wide, tmp_path, monkeypatch)
    spark.sparkContext.setJobGroup("log of small tasks", "")
    try:
        lines = stores.log_lines(Stored(fact, fact, None, fact))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("log of small tasks") for s in tracker.getJobInfo(j).stageIds]
    tasks = max(info.numTasks for s in stages if (info := tracker.getStageInfo(s)))
    assert tasks >= len(fact.inputFiles()) // task_size.FILES_PER_TASK and lines.where("value LIKE '%completed%'").count() > 1
