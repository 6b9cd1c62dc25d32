import datetime as dt
import random
import re
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from widefold.functions.labels import duration_text, improvement_percent, metric_type
from widefold.operators import logs, order_stats, timing
from widefold.operators.order_stats import order_statistics, share_position
from widefold.sources.logs import read_logs
from widefold.sources.timings import read_timings, write_csv, write_json

SAMPLE = (
    "customer_id int, customer_name string, metric_key string, schema_type string, run_number int, "
    "execution_time_seconds double, row_count bigint, query_date string"
)


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SMALLEST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
PARALLEL = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def samples(spark, groups):
    rows = [
        (1, "t", metric, kind, i, float(v), 1, "2024-01-01")
        for (metric, kind), values in groups.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, SAMPLE)


def test_statistics_of_odd_even_and_single_groups(spark):
    rng = random.Random(1)
    groups = {("m", "old"): [rng.random() for _ in range(51)], ("m", "new"): [2.0, 4.0, 3.0, 9.0], ("one", "old"): [5.0]}
    got = {(r["metric_key"], r["schema_type"]): r for r in timing.metric_stats(samples(spark, groups)).collect()}
    for key, values in groups.items():
        row = got[key]
        assert row["runs"] == len(values) and row["min"] == min(values) and row["max"] == max(values)
        assert row["median"] == pytest.approx(statistics.median(values))
        assert row["avg"] == pytest.approx(statistics.mean(values))
        assert row["stdev"] == pytest.approx(statistics.stdev(values) if len(values) > 1 else 0.0)


@pytest.mark.parametrize("n", [1, 20, 50, 100, 101])
def test_tail_positions(spark, n):
    values = list(range(n))
    df = samples(spark, {("m", "old"): values}).withColumnRenamed("schema_type", "access_type")
    row = timing.view_stats(df).first()
    assert (row["p95"], row["p99"]) == (values[int(n * 0.95)], values[int(n * 0.99)])


def test_order_statistics_of_a_hot_group_cut_into_ranges(spark):
    rng = random.Random(3)
    values = {"hot": [rng.choice([0.5, rng.random(), rng.random() ** 8]) for _ in range(3000)], "cold": [1.0, 2.0]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v double")
    positions = {"p10": share_position(0.1), "p95": share_position(0.95), "last": lambda n: n - 1}
    got = order_statistics(df, ["g"], "v", positions).select("g", *positions)
    expected = {
        g: (sorted(vs)[int(len(vs) * 0.1)], sorted(vs)[int(len(vs) * 0.95)], max(vs)) for g, vs in values.items()
    }
    assert {r["g"]: tuple(r)[1:] for r in got.collect()} == expected


def test_ranges_grow_with_the_values(spark, monkeypatch):
    store = order_stats.materialise
    monkeypatch.setattr(order_stats, "materialise", lambda df: seen.append(store(df)) or seen[-1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", ADVISORY, SMALLEST, PARALLEL)}
    for k, v in zip(before, ("64", "16k", "1k", "false"), strict=True):
        spark.conf.set(k, v)
    ranges = []
    try:
        for n in (4_000, 8_000):
            seen: list = []
            df = spark.range(n).select(F.lit("hot").alias("g"), F.col("id").cast("double").alias("v"))
            row = order_statistics(df, ["g"], "v", {"middle": share_position(0.5)}).first()
            assert (row["middle"], row["runs"]) == (n // 2, n)
            ranges.append(seen[0].select("range_no").distinct().count())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 1 < ranges[0] < ranges[1]


def test_null_groups_are_kept(spark):
    rows = [(1, None, "m", "old", 1.0), (1, None, "m", "old", 3.0), (1, "a", None, None, 5.0), (None, None, None, "old", None)]
    df = spark.createDataFrame(rows, "customer_id int, customer_name string, metric_key string, schema_type string, execution_time_seconds double")
    got = {tuple(r)[:4]: (r["runs"], r["avg"], r["median"], r["stdev"]) for r in timing.metric_stats(df).collect()}
    assert got == {(1, None, "m", "old"): (2, 2.0, 2.0, 2**0.5), (1, "a", None, None): (1, 5.0, 5.0, 0.0)}


def test_speedups_and_labels(spark):
    df = samples(
        spark,
        {
            ("a_success_time", "old"): [4.0, 2.0],
            ("a_success_time", "new"): [1.0],
            ("app_time", "old"): [1.0],
            ("app_time", "new"): [0.0],
            ("count", "old"): [0.0],
            ("count", "new"): [2.0],
        },
    )
    rows = {r["metric_key"]: (r["speedup"], r["improvement_percent"]) for r in timing.speedups(df).collect()}
    assert rows["a_success_time"] == (3.0, pytest.approx(200 / 3))
    assert rows["app_time"] == (0.0, 100.0) and rows["count"] == (0.0, 0.0)
    types = {r["metric_type"] for r in timing.speedup_by_type(timing.speedups(df)).collect()}
    assert types == {"success_count", "duration", "other"}
    first = timing.fastest_first(timing.speedups(df)).first()
    assert first["metric_key"] == "a_success_time"
    overall = timing.overall(df).first()
    assert overall["old_runs"] == 4 and overall["new_runs"] == 3
    assert overall["overall_speedup"] == pytest.approx((7 / 4) / (3 / 3))
    labels = spark.createDataFrame([(59.96,), (60.0,), (6729.4,), (0.25,)], "s double")
    assert [r[0] for r in labels.select(duration_text(F.col("s"))).collect()] == ["60.0s", "1m 0s", "112m 9s", "0.2s"]
    nothing = spark.createDataFrame([(0.0, 1.0, "total_duration")], "o double, n double, k string")
    assert tuple(
        nothing.select(improvement_percent(F.col("o"), F.col("n")), metric_type(F.col("k"))).first()
    ) == (0.0, "duration")


def test_timing_files(spark, tmp_path):
    df = samples(spark, {("m", "old"): [1.5], ("m", "new"): [0.5]})
    write_csv(df, str(tmp_path / "csv"))
    read = read_timings(spark, str(tmp_path / "csv"))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, df.collect()))
    write_json(timing.speedups(read), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first()["speedup"] == 3.0
    (tmp_path / "bad.csv").write_text("customer_id,customer_name,metric_key,schema_type,run_number,execution_time_seconds,row_count,query_date\nx,t,m,old,1,1.0,1,d\n")
    with pytest.raises(Exception):
        read_timings(spark, str(tmp_path / "bad.csv")).collect()


# ---- logs -------------------------------------------------------------------------------------


def log_text(seed):
    """A log with whole, empty, broken and crashed chunks, and lines that mean nothing."""
    rng, moment, out = random.Random(seed), dt.datetime(2024, 3, 1), []

    def say(text):
        nonlocal moment
        moment += dt.timedelta(milliseconds=rng.randrange(1, 5000))
        out.append(f"{moment:%Y-%m-%d %H:%M:%S},{moment.microsecond // 1000:03d} - INFO - {text}")

    say("Processing customer 1")
    say("Processing chunk 1/9: 2024-01-01 00:00:00 to 2024-01-01 00:00:59.999")
    out.append("PHASE 3: DATA TRANSFORMATION")
    for tenant in (101, 102, 103):
        say(f"Processing customer {tenant}")
        for chunk in range(1, 30):
            raw, agg = rng.randrange(1, 90), rng.randrange(1, 30)
            say(f"Processing chunk {chunk}/1440: 2024-01-01 01:{chunk:02d}:00 to 2024-01-01 01:{chunk:02d}:59.999")
            kind = rng.choice(["whole", "whole", "empty", "crashed", "no insert", "noise"]) if tenant != 103 else "empty"
            if kind == "empty":
                say("  Fetched 0 aggregated rows for time chunk")
                say("  Compression for chunk: 0 raw → 0 aggregated rows (N/A)")
                continue
            say(f"  Fetched {agg} aggregated rows for time chunk")
            say(f"  Compression for chunk: {raw} raw → {agg} aggregated rows ({raw / agg:.2f}x)")
            if kind == "noise":
                out.extend(["no timestamp: Successfully inserted 3 rows", "", "traceback"])
            say(f"Transformed {agg} pre-aggregated rows into {agg} target rows")
            if kind == "crashed":
                continue
            say(f"Inserting {agg} rows into target table")
            if kind != "no insert":
                say(f"Successfully inserted {agg} rows")
            say(f"  Chunk {chunk} completed: {agg} source rows → {agg} target rows")
    return out


def read_by_state(lines):
    """The chunks of a log, read one line after the other."""
    tenant, open_chunk, seen, found = None, None, False, []
    for line in lines:
        seen = seen or logs.PHASE_MARKER in line
        stamp = re.match(logs.TIMESTAMP, line)
        if not seen or not stamp:
            continue
        at = dt.datetime.strptime(stamp.group(1), "%Y-%m-%d %H:%M:%S,%f")
        event, match = next(((e, m) for e, p in logs.EVENTS.items() if (m := re.search(p, line))), (None, None))
        if event == "tenant":
            tenant = int(match.group(1))
        elif event == "start":
            open_chunk = {"no": int(match.group(1)), "start": at, "tenant": tenant}
        elif open_chunk is not None and event == "compression":
            open_chunk["rows"] = tuple(map(int, match.groups()[:2]))
        elif open_chunk is not None and event == "completed":
            if all(s in open_chunk for s in logs.STAGES):
                found.append({**open_chunk, "completed": at})
            open_chunk = None
        elif open_chunk is not None and event:
            open_chunk[event] = at
    return found


@pytest.mark.parametrize("block_bytes", [700, 10_000_000])
def test_chunks_against_a_line_by_line_reading(spark, tmp_path, block_bytes):
    folder = tmp_path / "logs"
    folder.mkdir()
    texts = {f"{i}.log": log_text(i) for i in range(2)}
    for name, lines in texts.items():
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block_bytes)
    try:
        lines = read_logs(spark, str(folder))
        if block_bytes < 1000:
            assert lines.select("log_id", "block").distinct().count() > 10
        rows = logs.chunks(lines).where("is_complete").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, text in texts.items():
        expected = {
            (c["tenant"], c["no"]): (
                *c["rows"],
                (c["fetched"] - c["start"]).total_seconds(),
                (c["transformed"] - c["fetched"]).total_seconds(),
                (c["inserted"] - c["inserting"]).total_seconds(),
                (c["completed"] - c["start"]).total_seconds(),
            )
            for c in read_by_state(text)
        }
        got = {
            (r["customer_id"], r["chunk_no"]): (
                r["raw_rows"], r["agg_rows"], r["aggregate_seconds"], r["transform_seconds"], r["insert_seconds"], r["total_seconds"],
            )
            for r in rows
            if r["log_id"].endswith(name)
        }
        assert got == expected and len(got) > 10


def test_tenant_stats_span_and_means(spark):
    text = log_text(0)
    lines = spark.createDataFrame([("a", i // 9, i, v) for i, v in enumerate(text)], "log_id string, block int, pos bigint, value string")
    stats = {r["customer_id"]: r for r in logs.tenant_stats(logs.chunks(lines)).collect()}
    by_tenant = defaultdict(list)
    for chunk in read_by_state(text):
        by_tenant[chunk["tenant"]].append(chunk)
    assert set(stats) == set(by_tenant) == {101, 102}
    for tenant, chunks in by_tenant.items():
        row = stats[tenant]
        assert row["total_chunks"] == len(chunks)
        assert row["total_raw_rows"] == sum(c["rows"][0] for c in chunks)
        ratios = [float(f"{c['rows'][0] / c['rows'][1]:.2f}") for c in chunks]
        assert row["avg_compression_ratio"] == pytest.approx(statistics.mean(ratios))
        first = next(
            dt.datetime.strptime(v[:23], "%Y-%m-%d %H:%M:%S,%f")
            for i, v in enumerate(text)
            if "Processing chunk 1/1440" in v and f"Processing customer {tenant}" in text[i - 1]
        )
        assert row["total_time_seconds"] == pytest.approx((chunks[-1]["completed"] - first).total_seconds())


def test_log_without_marker_fails(spark):
    lines = spark.createDataFrame(
        [("a", 0, 0, "2024-03-01 00:00:00,000 - Processing customer 1")], "log_id string, block int, pos bigint, value string"
    )
    with pytest.raises(Exception, match="log without"):
        logs.chunks(lines).collect()


def test_log_with_neither_marker_nor_event_fails(spark):
    rows = [("a", 0, 0, f"2024-03-01 00:00:00,000 - {logs.PHASE_MARKER}"), ("b", 0, 0, "nothing of interest")]
    lines = spark.createDataFrame(rows, "log_id string, block int, pos bigint, value string")
    with pytest.raises(Exception, match="log without .*: b"):
        logs.chunks(lines)
    assert logs.chunks(lines.where("log_id = 'a'")).count() == 0
