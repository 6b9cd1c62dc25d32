import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import at
from widefold.model import flat_schema
from widefold.operators import locate, metrics, profile, report, validate, views
from widefold.plans.day_load import load_days
from widefold.plans.small_side import clear_intermediates, intermediates, materialise, shared_folder
from widefold.sources import flat as flat_source
from widefold.sources.wide import read_wide, write_wide

START, END = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def sums(df):
    return {tuple(r)[:-1]: r["metric_sum"] for r in df.collect()}


@pytest.fixture
def loaded(wide, tmp_path):
    """Two tenants whose shared metric sits in different columns; names hold special characters."""
    rows = []
    for i in range(60):
        tenant = 1 + i % 2
        ints = {"metricIntGroup3": {"event_count": 1}}
        if tenant == 1:
            ints["metricIntGroup1"] = {"a.b-c d": i, "aaa": -i}
        rows.append(
            {
                "customerId": tenant,
                "clientId": f"c{i % 7}",
                "sessionId": "s",
                "flowId": "f" if i % 3 else "g",
                "timestampMs": at(i * 20),
                "country": i % 2,
                "platform": ["ios", "web"][i % 7 % 2],
                **ints,
            }
        )
    fact = wide(rows)
    return fact, load_days(fact, str(tmp_path / "flat"), mode="replace")


def test_three_paths_agree(loaded):
    fact, load = loaded
    metric = "a.b-c d"
    for shape in metrics.SHAPES:
        old = metrics.map_metric(fact, 1, "metricIntGroup1", metric, shape, START, END)
        assert sums(old) == sums(metrics.flat_metric(load.flat, 1, "int1", shape, START, END)) != {}
    view = views.tenant_view(load.flat, load.mapping, 1)
    assert {metric, "aaa", "event_count"} < set(view.columns)
    direct = metrics.direct_metric(load.flat, 1, "int1", START, END)
    assert sums(direct) == sums(metrics.view_metric(view, metric, START, END))


def test_view_plan_equals_direct_plan(loaded):
    _, load = loaded
    view = views.tenant_view(load.flat, load.mapping, 1)
    read = metrics.view_metric(view, "event_count", START, END)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in read.splitlines() if "FileScan" in line)
    assert "customerId" in scan.split("PartitionFilters:")[1] and "eventDate" in scan.split("PartitionFilters:")[1]
    assert "int3" in scan and "int1" not in scan and "appName" not in scan


def test_flat_scan_pushes_value_and_time_conditions(loaded, spark):
    _, load = loaded
    df = metrics.flat_metric(load.flat, 1, "int3", "dims", START, END)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThan(int3,0)" in pushed and "GreaterThanOrEqual(timestampMs" in pushed


def test_negative_values_part_the_paths(wide, tmp_path):
    rows = [{"metricIntGroup1": {"k": v}, "timestampMs": at(0, s)} for s, v in enumerate((5, -3))]
    fact = wide(rows)
    load = load_days(fact, str(tmp_path / "flat"))
    old = metrics.map_metric(fact, 0, "metricIntGroup1", "k", "country", START, END)
    new = metrics.flat_metric(load.flat, 0, "int1", "country", START, END)
    assert (sums(old), sums(new)) == ({(0,): 5}, {(0,): 2})


def test_zero_groups_show_only_without_the_condition(wide, tmp_path):
    fact = wide([{"metricIntGroup1": {"k": 0}}])
    load = load_days(fact, str(tmp_path / "flat"))
    assert sums(metrics.flat_metric(load.flat, 0, "int1", "dims", START, END)) == {}
    assert sums(metrics.direct_metric(load.flat, 0, "int1", START, END)) == {("", "", ""): 0}


def test_window_end_is_open(wide):
    fact = wide([{"timestampMs": t, "metricIntGroup1": {"k": 1}} for t in (at(359, 59, 999), at(360))])
    got = metrics.map_metric(fact, 0, "metricIntGroup1", "k", "minute", START, dt.datetime(2024, 1, 1, 6))
    assert sums(got) == {(at(359),): 1}


def test_flow_ties_and_groups(wide, spark):
    rows = [
        {"flowId": "b", "metricIntGroup4": {"m": 1}, "metricIntGroup2": {"m": 1}},
        {"flowId": "a", "metricIntGroup9": {"m": 1}},
        {"flowId": "z", "metricIntGroup2": {"single": 1}},
        {"flowId": "n", "metricIntGroup1": None},
    ]
    counts = locate.flow_counts(wide(rows))
    flows = {(r["metric_key"], r["flowid"]): (r["cnt"], r["flow_rank"]) for r in locate.metric_flows(counts).collect()}
    assert flows == {("m", "a"): (1, 1), ("m", "b"): (1, 2), ("single", "z"): (1, 1)}
    found = {r["metric_key"]: tuple(r)[2:] for r in locate.metric_group(counts).collect()}
    assert found == {"m": ("a", "metricIntGroup9", True), "single": ("z", "metricIntGroup2", False)}
    assert locate.metric_flows(counts, limit=1).count() == 2


def test_locator_errors_and_patterns(loaded, spark):
    fact, load = loaded
    wanted = spark.createDataFrame([(1, "event_count"), (2, "event_count")], "customer_id int, metric_key string")
    located = locate.metric_locator(fact, load.mapping.keys, wanted)
    rows = {r["customer_id"]: tuple(r)[2:] for r in located.collect()}
    assert rows == {1: ("f", "metricIntGroup3", "int3", True), 2: ("f", "metricIntGroup3", "int1", True)}
    assert {r["flowid"] for r in locate.pattern_rows(located).collect()} == {"ALL"}
    lost = spark.createDataFrame([(1, "none")], "customer_id int, metric_key string")
    with pytest.raises(Exception, match="no flow holds metric none"):
        locate.metric_locator(fact, load.mapping.keys, lost).collect()


def test_report_equals_single_queries(loaded):
    fact, load = loaded
    located = locate.metric_locator(fact, load.mapping.keys)
    rows = report.flat_report(load.flat, located, "country", START, END).collect()
    for tenant, metric, column in ((1, "event_count", "int3"), (2, "event_count", "int1"), (1, "a.b-c d", "int1")):
        single = sums(metrics.flat_metric(load.flat, tenant, column, "country", START, END))
        assert {
            (r["country"],): r["metric_sum"] for r in rows if (r["customer_id"], r["metric_key"]) == (tenant, metric)
        } == single
    with pytest.raises(ValueError, match="no metric"):
        report.flat_report(load.flat, located.where("false"), "country", START, END)
    patterns = locate.pattern_rows(located)
    old = {tuple(r) for r in report.map_report(fact, patterns, "minute", START, END).collect()}
    new = {tuple(r) for r in report.flat_report(load.flat, patterns, "minute", START, END).collect()}
    assert old == new != set()


METRIC = "customer_id int, metric_key string, query_type string, g string, metric_sum bigint"


def test_validation_modes(spark):
    old = spark.createDataFrame([(1, "m", "q", "x", 5), (1, "m", "q", "y", 1), (1, "o", "q", "x", 2)], METRIC)
    new = spark.createDataFrame([(1, "m", "q", "x", 4), (1, "m", "q", "y", 2), (2, "n", "q", None, 3)], METRIC)
    results = validate.compare_totals(old, new)
    rows = {(r["customer_id"], r["metric_key"]): tuple(r)[3:] for r in results.collect()}
    assert rows == {(1, "m"): (True, 2, 2, 6, 6, 0), (1, "o"): (False, 1, 0, 2, 0, 2), (2, "n"): (False, 0, 1, 0, 3, 3)}
    groups = {(r["metric_key"], r["g"]): r["difference"] for r in validate.compare_groups(old, new, ["g"]).collect()}
    assert groups == {("m", "x"): 1, ("m", "y"): 1, ("o", "x"): 2, ("n", None): 3}
    summary = {r["customer_id"]: tuple(r)[1:] for r in validate.validation_summary(results).collect()}
    assert summary == {1: (2, 1, 1, False), 2: (1, 0, 1, False)}
    with pytest.raises(ValueError, match="2 metrics differ"):
        validate.require_valid(results)
    validate.require_valid(validate.compare_totals(old, old))


def test_views_and_summaries(loaded, spark):
    _, load = loaded
    name = views.register_view(load.flat, load.mapping, 2)
    assert tuple(views.verify_view(spark.table(name)).first()) == (30, True)
    assert tuple(views.verify_view(spark.table(name).where("false")).first()) == (0, False)
    assert views.sample_row(spark.table(name), ["timestampMs"]).first()["timestampMs"] == at(20)
    summary = {r["customer_id"]: r.asDict() for r in views.tenant_summary(load.flat, load.mapping).collect()}
    assert summary[1]["int_metrics"] == 3 and summary[2]["int_metrics"] == 1 and summary[2]["has_data"]
    used = {(r["customer_id"], r["column"]): (r["used_rows"], r["total"]) for r in profile.column_profile(load.flat).collect()}
    assert used[(2, "int1")] == (30, 30.0) and used[(2, "int2")] == (0, 0.0)
    assert profile.column_counts(load.flat) == {"total": 46, "metadata": 43, "int": 3}
    assert tuple(profile.class_profile(profile.column_profile(load.flat)).first())[:3] == ("int", 3, 3)
    assert {tuple(r) for r in profile.rows_by_month(load.flat).collect()} == {(202401, 1, 30), (202401, 2, 30)}


def days_rows(wide, day, value):
    return wide([{"customerId": c, "timestampMs": at(days=day), "metricIntGroup1": {"k": value}} for c in (1, 2)])


def test_write_modes(wide, spark, tmp_path):
    path = str(tmp_path / "flat")

    def stored():
        rows = flat_source.read_flat(spark, path, flat_schema(1)).collect()
        return sorted((r["customerId"], r["timestampMs"].day, r["int1"]) for r in rows)

    load_days(days_rows(wide, 0, 1), path)
    load_days(days_rows(wide, 1, 2), path)
    assert stored() == [(1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 2, 2)]
    load_days(days_rows(wide, 1, 5), path)
    load_days(days_rows(wide, 1, 5), path)
    assert stored() == [(1, 1, 1), (1, 2, 5), (2, 1, 1), (2, 2, 5)]
    load_days(days_rows(wide, 1, 5).where("customerId = 2"), path, mode="append")
    assert len(stored()) == 5
    load_days(days_rows(wide, 2, 7).where("customerId = 1"), path, mode="replace")
    assert stored() == [(1, 3, 7)]


def key_totals(load):
    names = {(r["customer_id"], r["column"]): r["key"] for r in load.mapping.keys.collect()}
    columns = sorted({c for _, c in names})
    totals = {}
    for row in load.flat.collect():
        for c in columns:
            if row[c]:
                key = (row["customerId"], names[row["customerId"], c])
                totals[key] = totals.get(key, 0) + row[c]
    return totals


def keyed_rows(wide, day, *keys):
    return wide([{"customerId": 1, "timestampMs": at(days=day), "metricIntGroup1": {k: day + 1 for k in keys}}])


def test_numbers_keep_their_meaning_over_loads(wide, tmp_path):
    path = str(tmp_path / "flat")
    load_days(keyed_rows(wide, 0, "b", "gone"), path)
    # A new key sorts before the known ones, and one of these is missing.
    load = load_days(keyed_rows(wide, 1, "a", "b"), path)
    assert key_totals(load) == {(1, "b"): 3, (1, "gone"): 1, (1, "a"): 2}
    # The same load again, and one that adds to the table.
    load = load_days(keyed_rows(wide, 1, "a", "b"), path)
    assert key_totals(load) == {(1, "b"): 3, (1, "gone"): 1, (1, "a"): 2}
    load = load_days(keyed_rows(wide, 2, "0", "a"), path, mode="append")
    assert key_totals(load) == {(1, "b"): 3, (1, "gone"): 1, (1, "a"): 5, (1, "0"): 3}
    numbers = {r["key"]: r["idx"] for r in load.mapping.keys.collect()}
    assert numbers == {"b": 1, "gone": 2, "a": 3, "0": 4}
    # Another tenant comes in, and the table begins anew.
    other = keyed_rows(wide, 3, "x").withColumn("customerId", F.lit(2))
    assert key_totals(load_days(other, path))[2, "x"] == 4
    assert key_totals(load_days(keyed_rows(wide, 4, "z"), path, mode="replace")) == {(1, "z"): 5}


def test_a_given_mapping_is_extended(wide, tmp_path):
    first = load_days(keyed_rows(wide, 0, "b"), str(tmp_path / "one"))
    second = load_days(keyed_rows(wide, 0, "a", "b"), str(tmp_path / "two"), mapping=first.mapping)
    assert {r["key"]: r["idx"] for r in second.mapping.keys.collect()} == {"b": 1, "a": 2}


def test_columns_that_older_files_lack_are_zero_and_conditions_reach_them(wide, spark, tmp_path):
    path = str(tmp_path / "flat")
    load_days(keyed_rows(wide, 0, "b"), path)
    flat = load_days(keyed_rows(wide, 1, "c"), path).flat
    assert sorted((r["int1"], r["int2"]) for r in flat.collect()) == [(0, 2), (1, 0)]
    assert flat.where("int2 > 0").count() == 1 and flat.where("int2 = 0").count() == 1
    plan = spark._jvm.PythonSQLUtils.explainString(flat.where("int2 > 0")._jdf.queryExecution(), "formatted")
    assert "GreaterThan(int2,0)" in next(line for line in plan.splitlines() if line.startswith("PushedFilters"))


@pytest.mark.parametrize("sort_key", ["client", "hour"])
def test_files_of_a_large_tenant_do_not_overlap(wide, spark, tmp_path, sort_key):
    path = str(tmp_path / "flat")
    rows = wide([{"customerId": 1}]).crossJoin(spark.range(4000)).withColumns(
        {"clientId": F.lpad(F.pmod(F.xxhash64("id"), F.lit(997)).cast("string"), 4, "0"), "sessionId": F.col("id").cast("string")}
    ).withColumn("timestampMs", F.expr("timestampMs + make_dt_interval(0, id % 20)")).drop("id")
    rows = rows.unionByName(wide([{"customerId": 2}]))
    flat = rows.drop(*[c for c in rows.columns if "Group" in c], "flowId", "flowStartTimeMs")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        flat_source.write_flat(flat, path, sort_key=sort_key)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(path)
    per_tenant = dict(files.groupBy("customerId").agg(F.countDistinct(F.col("_metadata.file_path"))).collect())
    assert per_tenant[1] > 1
    assert {tuple(r) for r in flat_source.file_overlaps(files, sort_key).collect()} == {(1, 0), (2, 0)}
    # The measure does see overlaps.
    shuffled = str(tmp_path / "shuffled")
    files.repartition(3).write.partitionBy("eventDate", "customerId").parquet(shuffled)
    assert dict(flat_source.file_overlaps(spark.read.parquet(shuffled), sort_key).collect())[1] == 2


def test_day_folders_of_the_raw_fact_are_pruned(wide, spark, tmp_path):
    path = str(tmp_path / "wide")
    write_wide(wide([{"timestampMs": at(days=d), "metricIntGroup1": {"k": 1}} for d in range(3)]), path)
    fact = read_wide(spark, path, by_date=True)
    query = metrics.map_metric(fact, 0, "metricIntGroup1", "k", "country", START, END)
    plan = query._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "eventDate" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert sums(query) == {(0,): 1}
    assert sums(metrics.map_metric(fact, 0, "metricIntGroup1", "k", "country", START, "2024-01-04 00:00:00")) == {(0,): 3}


def test_map_report_reads_the_located_maps_only(loaded, spark, tmp_path):
    fact, load = loaded
    path = str(tmp_path / "wide")
    fact.write.parquet(path)
    located = locate.metric_locator(fact, load.mapping.keys).where("metric_key = 'event_count'")
    df = report.map_report(read_wide(spark, path), located, "minute_window", START, END)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The scan of the fact is told by its columns: the plan cuts long paths.
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "timestampMs" in line)
    assert "metricIntGroup3" in scan and "metricIntGroup1#" not in scan and "metricFloat" not in scan
    assert {r["query_type"] for r in df.collect()} == {"groupby_minute_filtered"}


@pytest.mark.parametrize("sort_key", ["client", "hour"])
def test_rows_are_sorted_inside_files(wide, spark, tmp_path, sort_key):
    rows = [{"clientId": f"c{i * 7 % 10}", "timestampMs": at(i * 13 % 300), "metricIntGroup1": {"k": 1}} for i in range(40)]
    path = str(tmp_path / "flat")
    load_days(wide(rows), path, sort_key=sort_key)
    read = flat_source.read_flat(spark, path, flat_schema(1)).collect()

    def order(r):
        hour = (r["timestampMs"].hour,) if sort_key == "hour" else ()
        return (*hour, r["clientId"], r["sessionId"], r["timestampMs"])

    assert [order(r) for r in read] == sorted(order(r) for r in read)


def test_created_table_fills_defaults(spark, tmp_path):
    schema = flat_schema(2, 1, 1, "v2")
    assert schema.names[:3] == ["timestampMs", "flowId", "flowStartTimeMs"] and schema.names[-1] == "string1"
    flat_source.create_flat_table(spark, "flat_v2", schema, str(tmp_path / "t"), drop=True)
    spark.sql(
        "INSERT INTO flat_v2 (timestampMs, customerId, clientId, int2, eventDate) VALUES "
        "(timestamp_ntz'2024-01-01 00:00:00', 7, 'c', 9, date'2024-01-01')"
    )
    row = spark.table("flat_v2").first()
    assert (row["int1"], row["int2"], row["float1"], row["string1"], row["browserName"], row["country"]) == (0, 9, 0.0, "", "", 0)
    assert row["customerId"] == 7
    spark.sql("DROP TABLE flat_v2")
    for bad in ({"variant": "v3"}, {"string_columns": 1}, {"float_columns": -1}):
        with pytest.raises(ValueError):
            flat_schema(1, **bad)


def test_intermediates(spark):
    from pathlib import Path

    before = spark.conf.get("spark.checkpoint.dir")
    folder = Path(shared_folder(spark))
    assert str(folder).startswith(before)
    with intermediates(spark):
        assert materialise(spark.range(3)).count() == 3
        assert list(folder.iterdir())
    assert not folder.exists()
    clear_intermediates(spark)


def test_intermediates_without_a_checkpoint_folder(spark):
    class Context:
        applicationId, master = "app", "local[2]"

        def getCheckpointDir(self):
            return None

    class Conf:
        def __init__(self, warehouse):
            self.warehouse = warehouse

        def get(self, key, default=None):
            return self.warehouse if key == "spark.sql.warehouse.dir" else default

    class Session:
        def __init__(self, warehouse, master):
            self.sparkContext, self.conf = Context(), Conf(warehouse)
            self.sparkContext.master = master

    assert shared_folder(Session("file:/w", "local[2]")) == "file:/w/widefold-app"
    assert shared_folder(Session("hdfs://n/w", "yarn")) == "hdfs://n/w/widefold-app"
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session(warehouse, "yarn"))
