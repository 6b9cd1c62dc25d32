"""Registered queries that write something and read it back, and loads in several steps."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.oracle import DIMS_FLOW, DIMS_METRIC, END, START, TENANT
from checks.oracle_stores import CHANGED_CLIENT, CUT, HALF_DAYS
from widefold.fixtures import load_log, timing_samples
from widefold.functions.times import day_range
from widefold.model import GROUP_KEYS, column_class, flat_schema, group_columns
from widefold.operators import flatten, logs, metrics, preagg, timing
from widefold.plans import checksums, key_catalogue, stored_views
from widefold.plans.day_load import Load, load_days
from widefold.plans.small_side import shared_folder
from widefold.plans.stored import Stored
from widefold.plans.task_size import materialise_in_small_tasks, small_tasks
from widefold.sources import flat as flat_source
from widefold.sources import mappings
from widefold.sources.logs import read_logs
from widefold.sources.timings import read_timings, write_csv, write_json
from widefold.sources.wide import scan, write_wide

DIGITS = 6


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def totals_by_key(load: Load) -> DataFrame:
    """customer_id, kind, key and total of every metric of every tenant of a flat table."""
    names = [c for c in load.flat.columns if column_class(c) in ("int", "float")]
    sums = load.flat.groupBy(F.col("customerId").alias("customer_id")).agg(
        *[F.sum(F.col(c).cast("double")).alias(c) for c in names]
    )
    cells = ", ".join(f"struct('{c}' AS column, {c} AS total)" for c in names)
    return sums.selectExpr("customer_id", f"inline(array({cells}))").join(load.mapping.keys, ["customer_id", "column"]).select(
        "customer_id", "kind", "key", F.round("total", 3).alias("total")
    )


def load_two_days(t: Stored) -> DataFrame:
    """The days before CUT without clicks, then the others without views, into one table.

    The second load brings keys that sort before known ones, and lacks some that are known.
    """
    path = new_folder(t.wide.sparkSession)
    early = t.wide.where((F.col("timestampMs") < CUT) & (F.col("flowId") != "click"))
    late = t.wide.where((F.col("timestampMs") >= CUT) & (F.col("flowId") != "view"))
    load_days(early, path)
    return totals_by_key(load_days(late, path))


def load_half_days(t: Stored) -> DataFrame:
    """All days in three ranges cut at noon, the last one first and the first one twice."""
    path = new_folder(t.wide.sparkSession)
    ranges = list(zip(HALF_DAYS[:-1], HALF_DAYS[1:], strict=True))
    for start, end in [*reversed(ranges), ranges[0]]:
        load = load_days(t.wide, path, start, end)
    return all_rows(load)


def load_vanished_tenant(t: Stored) -> DataFrame:
    """A range that begins and ends inside days, loaded again from a fact without tenant 1."""
    path = new_folder(t.wide.sparkSession)
    load_days(t.wide, path, HALF_DAYS[0], HALF_DAYS[-1])
    return all_rows(load_days(t.wide.where("customerId <> 1"), path, HALF_DAYS[1], HALF_DAYS[2]))


def load_one_tenant(t: Stored) -> DataFrame:
    """The same range, loaded again for tenant 1 alone and by the hour; other tenants stay."""
    path = new_folder(t.wide.sparkSession)
    load_days(t.wide, path, HALF_DAYS[0], HALF_DAYS[-1], grain="hour")
    fewer = t.wide.where("flowId <> 'click'")
    return all_rows(load_days(fewer, path, HALF_DAYS[1], HALF_DAYS[2], grain="hour", tenants=[1]))


def all_rows(load: Load) -> DataFrame:
    """Metrics by group and key, which does not depend on the order in which loads number new keys."""
    names = [c for c in load.flat.columns if column_class(c) in ("int", "float")]
    cells = ", ".join(f"struct('{c}' AS column, CAST({c} AS DOUBLE) AS value)" for c in names)
    keys = load.mapping.keys.withColumnRenamed("customer_id", "customerId")
    rows = load.flat.selectExpr(*GROUP_KEYS, "platform", "appVersion", f"inline(array({cells}))")
    return rows.join(keys, ["customerId", "column"]).select(
        *GROUP_KEYS, "platform", "appVersion", "kind", "key", F.round("value", 3).alias("value")
    )


def discover_in_steps(t: Stored) -> DataFrame:
    """Keys of all kinds from a catalogue that has seen the days before CUT first and the others later."""
    spark, path = t.wide.sparkSession, new_folder(t.wide.sparkSession)
    rows = t.wide.drop("eventDate")
    write_wide(rows.where(F.col("timestampMs") < CUT), path)
    key_catalogue.update_catalogue(spark, path)
    write_wide(rows.where(F.col("timestampMs") >= CUT), path, "append")
    found = key_catalogue.catalogued_entries(spark, path, key_catalogue.KINDS)
    return found.where("key IS NOT NULL")


def metric_by_catalogue(t: Stored) -> DataFrame:
    """A metric of the map path that opens only the files which hold it."""
    spark, path = t.wide.sparkSession, new_folder(t.wide.sparkSession)
    write_wide(t.wide.drop("eventDate"), path)
    key_catalogue.update_catalogue(spark, path)
    fact = key_catalogue.scan_for_key(spark, path, TENANT, "metricIntGroup1", DIMS_METRIC, START, END)
    return metrics.map_metric(fact, TENANT, "metricIntGroup1", DIMS_METRIC, "dims", START, END, DIMS_FLOW)


def coarser(t: Stored, grains: list[str]) -> DataFrame:
    """The flat fact of the last grain, each grain made from the one before it."""
    state = stored_groups(flatten.summed_state(t.wide, t.mapping, t.entries, grains[0]))
    for grain in grains[1:]:
        state = stored_groups(flatten.coarser_state(state, grain))
    return plain_floats(flatten.positional(state))


def stored_groups(state: flatten.SummedState) -> flatten.SummedState:
    return dataclasses.replace(state, rows=materialise_in_small_tasks(state.rows))


def stored_view(t: Stored) -> DataFrame:
    """Tenant 1 through its stored view, after a first load that lacks some keys and a second one."""
    spark, path, name = t.wide.sparkSession, new_folder(t.wide.sparkSession), f"flat_{uuid.uuid4().hex}"
    for fact in (t.wide.where((F.col("timestampMs") < CUT) & (F.col("flowId") == "view")), t.wide):
        load = load_days(fact, path)
        stored_views.publish_views(spark, path, name, load.mapping)
    view = spark.table(stored_views.view_of(name, TENANT))
    return plain_floats(view)


def find_difference(t: Stored) -> DataFrame:
    """Cells in which a table differs from one whose fact has other counts of one client."""
    spark, paths = t.wide.sparkSession, [new_folder(t.wide.sparkSession) for _ in range(2)]
    twice = F.transform_values("metricIntGroup15", lambda k, v: v * 2)
    is_changed = (F.col("clientId") == CHANGED_CLIENT) & (F.col("flowId") == "purchase")
    changed = t.wide.withColumn("metricIntGroup15", F.when(is_changed, twice).otherwise(F.col("metricIntGroup15")))
    left, right = (load_days(fact, path).flat for fact, path in zip((t.wide, changed), paths, strict=True))
    return checksums.compare_tables(spark, *paths, left, right)


def plain_floats(df: DataFrame) -> DataFrame:
    """Float columns as rounded doubles, without the storage column of the day."""
    names = [c for c in df.columns if c != "eventDate"]
    kinds = dict(df.dtypes)
    return df.select(*[F.round(F.col(f"`{c}`").cast("double"), 4).alias(c) if kinds[c] == "float" else F.col(f"`{c}`") for c in names])


def stored_mapping(t: Stored, as_json: bool) -> DataFrame:
    spark, path = t.wide.sparkSession, new_folder(t.wide.sparkSession)
    if as_json:
        mappings.write_numeric_json(t.mapping, path)
        return mappings.read_numeric_json(spark, path).keys
    mappings.write_mapping(t.mapping, path)
    return mappings.read_mapping(spark, path).keys


def created_table(t: Stored, variant: str) -> DataFrame:
    """A created table filled with the group keys alone: what it gives for the columns left out."""
    spark, name = t.wide.sparkSession, f"made_{uuid.uuid4().hex}"
    strings = 2 if variant == "v2" else 0
    flat_source.create_flat_table(spark, name, flat_schema(3, 1, strings, variant), new_folder(spark))
    rows = t.flat.select(*GROUP_KEYS, "eventDate")
    spark.sql(f"INSERT INTO {name} ({', '.join(rows.columns)}) SELECT * FROM {{rows}}", rows=rows)
    more = [F.count_if(F.col("string2") == "").alias("blank_strings")] if strings else []
    out = spark.table(name).groupBy(F.col("customerId").alias("customer_id")).agg(
        F.count("*").alias("rows"), F.sum("int3").alias("int3"), F.count("float1").alias("floats"),
        F.count_if(F.col("browserName") == "").alias("blank_browsers"), *more,
    )
    return out


def written_twice(t: Stored, mode: str) -> DataFrame:
    """The flat table written twice: rows and the sum of its first column."""
    path, rows = new_folder(t.wide.sparkSession), t.flat.count()
    for _ in range(2):
        flat_source.write_flat(t.flat.drop("eventDate"), path, mode, at_most=rows)
    schema = flat_schema(t.mapping.int_columns, t.mapping.float_columns)
    return flat_source.read_flat(t.wide.sparkSession, path, schema).groupBy(F.col("customerId").alias("customer_id")).agg(
        F.count("*").alias("rows"), F.sum("int1").alias("int1")
    )


def file_overlaps(t: Stored, sort_key: str) -> DataFrame:
    spark, path = t.wide.sparkSession, new_folder(t.wide.sparkSession)
    flat_source.write_flat(t.flat.drop("eventDate"), path, "replace", sort_key, t.flat.count())
    return flat_source.file_overlaps(spark.read.parquet(path), sort_key)


def timings_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    write_csv(timing_samples(spark, sf_dir).select(*TIMING_COLUMNS), path)
    return rounded(timing.metric_stats(read_timings(spark, path)), DIGITS)


def results_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    stats = rounded(timing.metric_stats(timing_samples(spark, sf_dir)), DIGITS)
    write_json(stats, path)
    return spark.read.schema(stats.schema).json(path)


TIMING_COLUMNS = [
    "customer_id", "customer_name", "metric_key", "schema_type", "run_number", "execution_time_seconds", "row_count",
    "query_date",
]


def log_lines(t: Stored) -> DataFrame:
    """The load log written as text, one file per log with its lines in order, and read back."""
    path = new_folder(t.wide.sparkSession)
    lines = load_log(t.wide).repartition("log_id").sortWithinPartitions("log_id", "block", "pos")
    with small_tasks(t.wide.sparkSession):
        lines.select("log_id", "value").write.partitionBy("log_id").text(path)
    return read_logs(t.wide.sparkSession, f"{path}/*")


def log_events(t: Stored) -> DataFrame:
    lines = log_lines(t)
    events = logs.after_marker(logs.parse_events(lines), lines.select("log_id").distinct())
    return events.groupBy("event").agg(F.count("*").alias("events"))


def log_chunks(t: Stored) -> DataFrame:
    names = [
        "customer_id", "chunk_no", "period", "started", "raw_rows", "agg_rows", "ratio",
        "aggregate_seconds", "transform_seconds", "insert_seconds", "total_seconds",
    ]
    return logs.chunks(log_lines(t)).where("is_complete").select(*names)


def log_tenant_stats(t: Stored) -> DataFrame:
    return rounded(logs.tenant_stats(logs.chunks(log_lines(t))), DIGITS)


def preaggregated(grain: str) -> Callable[[Stored], DataFrame]:
    """All standard columns, and all maps as their sorted entries."""

    def written(group: str, kind: str) -> F.Column:
        shown = "string" if kind == "int" else "decimal(18,3)"
        entries = F.transform(
            F.array_sort(F.map_entries(group)),
            lambda e: F.concat(e["key"], F.lit("="), e["value"].cast(shown).cast("string")),
        )
        return F.array_join(entries, ",").alias(group)

    def query(t: Stored) -> DataFrame:
        rows = preagg.preaggregate(t.wide, grain)
        maps = [written(g, kind) for kind in ("int", "float") for g in group_columns(kind)]
        return rows.select(*[c for c in rows.columns if "Group" not in c], *maps)

    return query


def summed(t: Stored) -> DataFrame:
    ints = preagg.sum_map_long(t.wide, "int", "day").withColumn("kind", F.lit("int"))
    floats = preagg.sum_map_long(t.wide, "float", "day").withColumn("kind", F.lit("float"))
    return ints.withColumn("value", F.col("value").cast("double")).unionByName(
        floats.withColumn("value", F.round("value", 4))
    )


def rows_of_a_day(t: Stored) -> DataFrame:
    return scan(t.wide, *day_range("2024-01-05")).groupBy(F.col("customerId").alias("customer_id")).agg(
        F.count("*").alias("rows")
    )


def on_tables() -> dict[str, Callable[[Stored], DataFrame]]:
    return {
        "load_two_days": load_two_days,
        "load_half_days": load_half_days,
        "load_vanished_tenant": load_vanished_tenant,
        "load_one_tenant": load_one_tenant,
        "discover_in_steps": discover_in_steps,
        "metric_by_catalogue": metric_by_catalogue,
        "flatten_hour_from_minutes": lambda t: coarser(t, ["minute", "hour"]),
        "flatten_day_from_hours": lambda t: coarser(t, ["minute", "hour", "day"]),
        "stored_view": stored_view,
        "find_difference": find_difference,
        "mapping_from_json": lambda t: stored_mapping(t, True),
        "mapping_from_tables": lambda t: stored_mapping(t, False),
        "created_table": lambda t: created_table(t, "v1"),
        "created_table_v2": lambda t: created_table(t, "v2"),
        "appended_twice": lambda t: written_twice(t, "append"),
        "replaced_days": lambda t: written_twice(t, "partitions"),
        "file_overlaps_client": lambda t: file_overlaps(t, "client"),
        "file_overlaps_hour": lambda t: file_overlaps(t, "hour"),
        "log_events": log_events,
        "log_chunks": log_chunks,
        "log_tenant_stats": log_tenant_stats,
        "preagg_minute": preaggregated("minute"),
        "preagg_day": preaggregated("day"),
        "preagg_hour": preaggregated("hour"),
        "sum_map_long": summed,
        "rows_of_a_day": rows_of_a_day,
    }


def on_folder() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"timings_from_csv": timings_from_csv, "results_from_json": results_from_json}
