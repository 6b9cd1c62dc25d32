"""Benchmark: load a wide-map fact into a flat table, then run each query shape on both.

Prints one JSON line. BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local threads.
The fact is derived from lineitem: one day, three tenants, COPIES raw rows per line item, about 180 metrics
of a tenant in several map columns. Writing the raw fact is preparation and is not counted. BENCH_DIR names
a folder for what is written; without it the session's warehouse is used. It is emptied at the end.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from widefold.fixtures import FIRST_DAY, lineitem_fact  # noqa: E402
from widefold.functions.times import window_end  # noqa: E402
from widefold.operators import discovery, flatten, locate, metrics, preagg, report, validate, views  # noqa: E402
from widefold.operators.mapping import discover_mapping  # noqa: E402
from widefold.plans.day_load import load_days  # noqa: E402
from widefold.plans.small_side import clear_intermediates, materialise, shared_folder  # noqa: E402
from widefold.sources.wide import read_wide, write_wide  # noqa: E402

RUNS = 3
COPIES = 1
TENANT = 1
DAY_END = str(window_end(FIRST_DAY, 24))
WINDOW_END = str(window_end(FIRST_DAY, 6))


def session(cpus: int) -> SparkSession:
    folder = os.environ.get("BENCH_DIR")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("widefold-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config(map={"spark.checkpoint.dir": folder} if folder else {})
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def elapsed(action) -> float:
    begin = time.perf_counter()
    action()
    return time.perf_counter() - begin


def median_time(build: Callable[[], DataFrame]) -> float:
    """Median over RUNS, after one run that is not counted.

    Each run builds its DataFrame anew: one that has run keeps its shuffle files and would only
    read them again.
    """
    elapsed(lambda: build().collect())
    return sorted(elapsed(lambda: build().collect()) for _ in range(RUNS))[RUNS // 2]


def run(df: DataFrame) -> None:
    """Work out all rows without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def flatten_split(wide: DataFrame) -> dict[str, float]:
    """Where the time of flatten goes, over the sessions of a hash's eighth: its small jobs while building, the
    sums alone, the raw rows' standard columns alone, and all of it with the grouping and the projection of the
    positional columns."""
    wide = wide.where("pmod(xxhash64(sessionId), 8) = 0")
    mapping, entries = discover_mapping(wide)
    built = []
    split = {"building": elapsed(lambda: built.append(flatten.flatten(wide, mapping, entries)))}
    placed = materialise(flatten.slots(entries, mapping.keys, "last"))
    split["sums"] = elapsed(lambda: run(flatten.slot_sums(wide, placed, "int", "minute")))
    split["standard_columns"] = elapsed(lambda: run(preagg.representative(wide)))
    first = built[0].select("timestampMs", "customerId", "clientId", "sessionId", "int1")
    split["grouping_one_column"] = elapsed(lambda: run(first))
    split["whole"] = elapsed(lambda: run(built[0]))
    return {k: round(v, 2) for k, v in split.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus)
    folder = f"{shared_folder(spark)}/bench"
    write_wide(lineitem_fact(spark, sf_dir, COPIES), f"{folder}/wide")
    wide = read_wide(spark, f"{folder}/wide", by_date=True)
    raw_rows = wide.count()

    times: dict[str, float] = {}
    discover_mapping(wide.limit(1000))  # warm-up
    times["discover_and_number"] = elapsed(lambda: discover_mapping(wide))
    loads = []
    times["load_day"] = elapsed(lambda: loads.append(load_days(wide, f"{folder}/flat", mode="replace")))
    load = loads[0]
    flat, mapping = load.flat, load.mapping
    column = mapping.keys.where(f"customer_id = {TENANT} AND key = 'event_count'").first()["column"]
    view = views.tenant_view(flat, mapping, TENANT)

    shapes = {"dims": WINDOW_END, "country": WINDOW_END, "minute": DAY_END, "minute_window": WINDOW_END}
    for name, end in shapes.items():
        shape = name.split("_")[0]
        times[f"map_{name}"] = median_time(
            lambda: metrics.map_metric(wide, TENANT, "metricIntGroup15", "event_count", shape, FIRST_DAY, end)
        )
        times[f"flat_{name}"] = median_time(
            lambda: metrics.flat_metric(flat, TENANT, column, shape, FIRST_DAY, end)
        )
    times["direct_dims"] = median_time(lambda: metrics.direct_metric(flat, TENANT, column, FIRST_DAY, DAY_END))
    times["view_dims"] = median_time(lambda: metrics.view_metric(view, "event_count", FIRST_DAY, DAY_END))

    located = materialise(locate.metric_locator(wide, mapping.keys))
    patterns = locate.pattern_rows(located)
    times["locator"] = median_time(lambda: locate.metric_locator(wide, mapping.keys))
    times["report_flat_dims"] = median_time(lambda: report.flat_report(flat, located, "dims", FIRST_DAY, DAY_END))
    times["report_map_dims"] = median_time(lambda: report.map_report(wide, located, "dims", FIRST_DAY, DAY_END))

    def totals() -> DataFrame:
        old = report.map_report(wide, patterns, "minute", FIRST_DAY, DAY_END)
        return validate.compare_totals(old, report.flat_report(flat, patterns, "minute", FIRST_DAY, DAY_END))

    times["validate_totals"] = median_time(totals)
    validate.require_valid(totals())
    times["chunk_grid"] = median_time(lambda: discovery.chunk_grid(wide, 60))
    times["compression_stats"] = median_time(lambda: preagg.compression_stats(wide))

    map_mean = sum(times[f"map_{n}"] for n in shapes) / len(shapes)
    flat_mean = sum(times[f"flat_{n}"] for n in shapes) / len(shapes)
    line = {
        "metric": "load of one day plus all query shapes",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "raw_rows": raw_rows,
        "load_rows_per_second": round(raw_rows / times["load_day"]),
        "map_mean": round(map_mean, 4),
        "flat_mean": round(flat_mean, 4),
        "map_over_flat": round(map_mean / flat_mean, 3),
        "view_over_direct": round(times["view_dims"] / times["direct_dims"], 3),
        "int_columns": mapping.int_columns,
        "flatten_split": flatten_split(wide),
    }
    clear_intermediates(spark)
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
