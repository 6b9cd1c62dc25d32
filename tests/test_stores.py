"""The key catalogue, coarser grains from finer ones, and views in the catalog."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from conftest import at
from widefold.operators import discovery, flatten, metrics
from widefold.operators.mapping import discover_mapping
from widefold.plans import key_catalogue, stored_views
from widefold.plans.day_load import load_days
from widefold.plans.small_side import materialise
from widefold.sources.wide import read_wide, write_wide

START, END = "2024-01-01 00:00:00", "2024-01-05 00:00:00"


def day_of(wide, day, *rows):
    return wide([{"customerId": 1, "timestampMs": at(days=day), **r} for r in rows])


def found(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture
def fact(wide, tmp_path):
    path = str(tmp_path / "wide")
    write_wide(day_of(wide, 0, {"metricIntGroup1": {"a": 1, " ": 2}, "tagGroup2": {"t": "x"}}, {"customerId": 2}), path)
    write_wide(day_of(wide, 1, {"metricFloatGroup3": {"b": 0.5}, "metricIntGroup2": {"a": 0}}), path, "append")
    return path


def test_catalogue_equals_discovery_and_reads_new_days_only(wide, spark, fact):
    assert key_catalogue.update_catalogue(spark, fact) == 3
    assert found(key_catalogue.catalogued_entries(spark, fact)) == found(discovery.discover_entries(read_wide(spark, fact)))
    tags = key_catalogue.catalogued_entries(spark, fact, ("string",)).where("key IS NOT NULL")
    assert found(tags) == {(1, "string", 2, "t")}
    assert key_catalogue.update_catalogue(spark, fact) == 0
    write_wide(day_of(wide, 2, {"metricIntGroup5": {"late": 1}}), fact, "append")
    new = key_catalogue.files_present(spark, fact).join(key_catalogue.last_snapshot(spark, fact)[1], "file", "left_anti")
    plan = key_catalogue.rows_of_files(spark, fact, new)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "timestampMs" in line)
    assert "= 2024-01-03)" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert key_catalogue.update_catalogue(spark, fact) == 1
    assert found(key_catalogue.catalogued_entries(spark, fact)) == found(discovery.discover_entries(read_wide(spark, fact)))


def test_changed_and_vanished_days(wide, spark, fact):
    key_catalogue.update_catalogue(spark, fact)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_wide(day_of(wide, 0, {"metricIntGroup1": {"other": 1}}), fact)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    entries = found(key_catalogue.catalogued_entries(spark, fact))
    assert entries == found(discovery.discover_entries(read_wide(spark, fact)))
    assert (1, "int", 1, "a") not in entries and (1, "int", 1, "other") in entries
    write_wide(day_of(wide, 3, {"metricIntGroup1": {"only": 1}}), fact)
    assert found(key_catalogue.catalogued_entries(spark, fact)) == {(1, "int", 1, "only"), (1, None, None, None)}
    assert [d.day for d in key_catalogue.days_catalogued(spark, fact)] == [4]


def test_a_stopped_scan_changes_nothing(wide, spark, fact, monkeypatch):
    key_catalogue.update_catalogue(spark, fact)
    before = found(key_catalogue.live_entries(spark, fact))
    write_wide(day_of(wide, 2, {"metricIntGroup5": {"late": 1}}), fact, "append")
    has = key_catalogue.has_catalogue
    # Entries are written, the snapshot is not.
    entries = key_catalogue.file_entries

    class Stopped:
        def __init__(self, df):
            self.df = df

        @property
        def write(self):
            self.df.write.mode("overwrite").parquet(f"{key_catalogue.catalogue_folder(fact)}/entries/scan=2")
            raise InterruptedError

    monkeypatch.setattr(key_catalogue, "file_entries", lambda rows: Stopped(entries(rows)))
    with pytest.raises(InterruptedError):
        key_catalogue.update_catalogue(spark, fact)
    assert has(spark, fact) and found(key_catalogue.live_entries(spark, fact)) == before
    monkeypatch.setattr(key_catalogue, "file_entries", entries)
    assert key_catalogue.update_catalogue(spark, fact) == 1
    assert found(key_catalogue.catalogued_entries(spark, fact)) == found(discovery.discover_entries(read_wide(spark, fact)))


def test_a_rare_key_opens_its_files_only(wide, spark, fact):
    key_catalogue.update_catalogue(spark, fact)

    def opened(group, key, *span):
        return {f.split("eventDate=")[1][:10] for f in key_catalogue.scan_for_key(spark, fact, 1, group, key, *span).inputFiles()}

    assert opened("metricIntGroup1", "a") == {"2024-01-01"}
    assert opened("metricIntGroup1", "a", "2024-01-02 00:00:00", END) == set()
    # Not above 0, in another map, not there.
    assert opened("metricIntGroup2", "a") == opened("metricIntGroup3", "a") == opened("metricIntGroup1", "no") == set()
    assert opened("metricFloatGroup3", "b") == {"2024-01-02"}
    # A day that the catalogue has not seen is read.
    write_wide(day_of(wide, 2, {"metricIntGroup1": {"a": 7}}), fact, "append")
    assert opened("metricIntGroup1", "a") == {"2024-01-01", "2024-01-03"}
    for source in (read_wide(spark, fact, by_date=True), key_catalogue.scan_for_key(spark, fact, 1, "metricIntGroup1", "a")):
        assert found(metrics.map_metric(source, 1, "metricIntGroup1", "a", "country", START, END)) == {(0, 8)}


def test_many_files_are_not_named(spark, fact, monkeypatch):
    key_catalogue.update_catalogue(spark, fact)
    monkeypatch.setattr(key_catalogue, "MOST_NAMED", 0)
    assert len(key_catalogue.scan_for_key(spark, fact, 1, "metricIntGroup1", "a").inputFiles()) == 3


@pytest.mark.parametrize("conflict", ["last", "sum"])
def test_coarser_grains_from_finer_ones(wide, conflict):
    """The map column that counts for a key differs between the minutes and the hour."""
    rows = []
    for i in range(120):
        ints = {"metricIntGroup4": {"k": 1}} if i % 3 else {"metricIntGroup9": {"k": 10}}
        rows.append({
            "customerId": i % 2, "clientId": None if i % 5 == 0 else "c", "timestampMs": at(i * 7, i % 60), "platform": f"p{i}",
            "metricFloatGroup1": {"f": i / 4}, **ints,
        })
    fact = wide(rows)
    mapping, entries = discover_mapping(fact)
    state = flatten.summed_state(fact, mapping, entries, "minute", conflict)
    for grain in ("hour", "day"):
        stored = materialise(state.rows)
        state = flatten.coarser_state(dataclasses.replace(state, rows=stored), grain)
        assert set(state.rows.inputFiles()) == set(stored.inputFiles())
        assert found(flatten.positional(state)) == found(flatten.flatten(fact, mapping, entries, grain, conflict))
    with pytest.raises(ValueError, match="finer"):
        flatten.coarser_state(state, "minute")


NAMES = ["a.b-c d", "tick`s", "Platform", "it's", "k", "K"]


def test_another_session_reads_the_views(wide, spark, tmp_path):
    path = str(tmp_path / "flat")
    first = wide([{"customerId": c, "metricIntGroup1": {n: i + c for i, n in enumerate(NAMES)}} for c in (1, 2)])
    load = load_days(first, path)
    other = spark.newSession()
    assert stored_views.publish_views(spark, path, "shop", load.mapping) == ["shop_tenant_1", "shop_tenant_2"]
    try:
        view = other.table("shop_tenant_2")
        assert {"a.b-c d", "tick`s", "it's"} < set(view.columns) and not view.isLocal()
        row = view.first().asDict()
        assert (row["a.b-c d"], row["tick`s"], row["it's"]) == (2, 3, 5) and row["customerId"] == 2
        # Names that differ by case only, or are taken, get their columns' names.
        numbers = {r["key"]: r["column"] for r in load.mapping.keys.where("customer_id = 2").collect()}
        assert row[f"Platform_{numbers['Platform']}"] == 4 and row["platform"] == ""
        assert {row.get("K"), row.get("k"), row.get(f"k_{numbers['k']}"), row.get(f"K_{numbers['K']}")} == {6, 7, None}
        # A later load brings a key, a day and a tenant, and replaces a day.
        later = wide([{"customerId": c, "timestampMs": at(days=d), "metricIntGroup1": {"k": 50, "later": d}} for c in (2, 3) for d in (0, 1)])
        load = load_days(later, path)
        assert stored_views.publish_views(spark, path, "shop", load.mapping)[-1] == "shop_tenant_3"
        again = other.table("shop_tenant_2")
        assert "later" in again.columns
        assert sorted(r["later"] for r in again.collect()) == [0, 1]
        assert other.table("shop_tenant_1").first()["a.b-c d"] == 1
        assert {tuple(r)[:2] for r in stored_views.view_catalog(spark, "shop").collect()} == {(f"shop_tenant_{i}", i) for i in (1, 2, 3)}
        tables = [r["tableName"] for r in spark.sql("SHOW TABLES").where(F.col("tableName").startswith("shop_load")).collect()]
        assert tables == ["shop_load_2"]
        plan = again.select("later")._jdf.queryExecution().executedPlan().toString()
        assert "customerId" in next(line for line in plan.splitlines() if "FileScan" in line).split("PartitionFilters:")[1]
    finally:
        stored_views.drop_views(spark, "shop")
    assert not spark.sql("SHOW VIEWS").where(F.col("viewName").startswith("shop_")).collect()
