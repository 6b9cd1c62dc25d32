"""Checksums of flat tables, and the rows in which two tables differ."""

import pytest
from pyspark.sql import functions as F

from conftest import at
from widefold.plans import checksums
from widefold.plans.day_load import load_days

DAYS = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]


def fact_of(wide, changed=None, tenants=(1, 2, 3)):
    """Forty rows a day and tenant for three days; changed: (tenant, row) to a map of its metrics."""
    rows = []
    for c in tenants:
        for i in range(120):
            metrics = (changed or {}).get((c, i), {"k": i, "z": 1})
            rows.append({"customerId": c, "clientId": f"c{i % 5}", "timestampMs": at(i % 40, days=i // 40), "metricIntGroup1": metrics})
    return wide(rows)


@pytest.fixture
def pair(wide, tmp_path):
    def build(right):
        paths = [str(tmp_path / name) for name in ("left", "right")]
        return paths, [load_days(f, p).flat for f, p in zip((fact_of(wide), right), paths, strict=True)]

    return build


def shown(df):
    return sorted((r["customerId"], r["timestampMs"], r["column"], r["left_value"], r["right_value"]) for r in df.collect())


def test_one_changed_cell_is_found_and_its_day_alone_is_read(spark, wide, pair):
    paths, (left, right) = pair(fact_of(wide, {(2, 50): {"k": 51, "z": 1}}))
    sums = [checksums.table_sums(spark, p, left.drop("eventDate").schema) for p in paths]
    parts = checksums.differing_parts(*sums)
    assert [(str(r[0]), r[1], r[2]) for r in parts.collect()] == [("2024-01-02", 2, "int1")]
    found = checksums.differing_rows(left, right, parts)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line and "timestampMs" in line]
    assert len(scans) == 2
    for scan in scans:
        assert "= 2024-01-02" in scan.split("PartitionFilters:")[1] and "int2" not in scan and "platform" not in scan
    assert shown(found) == [(2, at(10, days=1), "int1", "50", "51")]


def test_equal_tables_do_not_differ_whatever_their_order_and_loads(spark, wide, tmp_path):
    paths = [str(tmp_path / name) for name in ("once", "parts")]
    fact = fact_of(wide)
    left = load_days(fact, paths[0]).flat
    for a, b in ((2, 3), (0, 1), (1, 2), (0, 1)):
        right = load_days(fact.repartition(5), paths[1], DAYS[a], DAYS[b]).flat
    assert checksums.compare_tables(spark, *paths, left, right).count() == 0


def test_lost_and_added_rows(spark, wide, pair):
    fact = fact_of(wide).where(~((F.col("customerId") == 1) & (F.col("timestampMs") == F.lit(at(3)))))
    fact = fact.unionByName(wide([{"customerId": 3, "clientId": "new", "timestampMs": at(0, days=2)}]))
    paths, (left, right) = pair(fact)
    rows = shown(checksums.compare_tables(spark, *paths, left, right))
    assert [r for r in rows if r[2] == checksums.KEYS] == [(1, at(3), checksums.KEYS, "", None), (3, at(0, days=2), checksums.KEYS, None, "")]
    assert {r[2] for r in rows if r[0] == 1} >= {checksums.KEYS, "int1", "int2"} and {r[0] for r in rows} == {1, 3}


def test_sums_are_worked_out_once_for_each_version(spark, wide, tmp_path):
    path = str(tmp_path / "flat")
    load = load_days(fact_of(wide), path)
    schema = load.flat.drop("eventDate").schema
    assert len(checksums.update_checksums(spark, path, schema)) == 1
    assert checksums.update_checksums(spark, path, schema) == []
    before = {tuple(r) for r in checksums.table_sums(spark, path, schema).collect()}
    # A later load replaces a day with the same rows, and one brings a column that no row of the others has.
    load_days(fact_of(wide), path, DAYS[1], DAYS[2])
    new = checksums.update_checksums(spark, path, schema)
    assert len(new) == 1 and new[0].startswith("000002")
    assert {tuple(r) for r in checksums.table_sums(spark, path, schema).collect()} == before
    load = load_days(fact_of(wide, {(1, 119): {"k": 119, "z": 1, "later": 4}}), path, DAYS[2], DAYS[3])
    after = {tuple(r) for r in checksums.table_sums(spark, path, load.flat.drop("eventDate").schema).collect()}
    assert {(str(r[0]), r[1], r[2]) for r in after ^ before} == {("2024-01-03", 1, "int3")}


def test_empty_tables(spark, wide, tmp_path):
    path = str(tmp_path / "flat")
    flat = load_days(fact_of(wide).where("false"), path).flat
    assert checksums.table_sums(spark, path, flat.drop("eventDate").schema).count() == 0
    assert checksums.compare_tables(spark, path, path, flat, flat).count() == 0
