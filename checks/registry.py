"""The registered queries: each operator applied to the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import stores
from checks.oracle import (
    CHUNK_MINUTES,
    COUNT_METRIC,
    DIMS_FLOW,
    DIMS_METRIC,
    END,
    SHORT_END,
    START,
    TENANT,
    WINDOW_HOURS,
)
from checks.stores import DIGITS, plain_floats, rounded
from widefold.fixtures import timing_samples, wide_fact
from widefold.functions.maps import any_group_has, first_group_with, map_value
from widefold.functions.times import window_end
from widefold.model import group_columns
from widefold.operators import (
    discovery,
    flatten,
    locate,
    mapping,
    metrics,
    preagg,
    profile,
    report,
    timing,
    validate,
    views,
)
from widefold.operators.mapping import KeyMapping
from widefold.plans.small_side import materialise
from widefold.plans.stored import Stored, stored
from widefold.plans.task_size import materialise_in_small_tasks
from widefold.sources.mappings import tag_document
from widefold.sources.wide import count_where, scan, without_excluded

Query = Callable[[SparkSession, str], DataFrame]


def tables(spark: SparkSession, sf_dir: str) -> Stored:
    return stored(spark, sf_dir, wide_fact)


def on_tables(query: Callable[[Stored], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(tables(spark, sf_dir))


def on_samples(query: Callable[[DataFrame], DataFrame]) -> Query:
    """Queries over timing samples, doubles rounded for comparison."""
    return lambda spark, sf_dir: rounded(query(timing_samples(spark, sf_dir)), DIGITS)


def joined_keys(df: DataFrame) -> DataFrame:
    return df.withColumn("keys", F.array_join("keys", ","))


# ---- discovery and mapping --------------------------------------------------------------------


def discover(kind: str) -> Query:
    return on_tables(lambda t: discovery.discover_keys(t.wide, (kind,)))


def tag_lists(t: Stored) -> DataFrame:
    """Tag keys of each tenant in falling order, each one twice, with the wrong count that gives."""
    document = tag_document(discovery.discover_entries(t.wide, ("string",)))
    falling = F.reverse("keys")
    return document.select(
        "customer_id", F.concat(falling, F.col("keys")).alias("keys"), (F.col("key_count") * 2).alias("key_count")
    )


def unmapped(t: Stored) -> DataFrame:
    """Keys that a mapping made from the first hour lacks."""
    early, _ = mapping.discover_mapping(scan(t.wide, START, SHORT_END))
    return flatten.unmapped_keys(t.wide, early)


# ---- pre-aggregation and flattening -----------------------------------------------------------


def flattened(grain: str, conflict: str = "last") -> Query:
    return on_tables(
        lambda t: plain_floats(materialise_in_small_tasks(flatten.flatten(t.wide, t.mapping, t.entries, grain, conflict)))
    )


# ---- metric queries ---------------------------------------------------------------------------


def column_of(m: KeyMapping, key: str) -> str:
    wanted = m.keys.sparkSession.createDataFrame([(TENANT, key)], "customer_id int, metric_key string")
    return mapping.physical_column(wanted, m.keys).first()["target_physical_column"]


def map_metric(shape: str, key: str, group: str, end: str, flow: str | None = None) -> Query:
    return on_tables(lambda t: metrics.map_metric(t.wide, TENANT, group, key, shape, START, end, flow))


def flat_metric(shape: str, key: str, end: str) -> Query:
    return on_tables(lambda t: metrics.flat_metric(t.flat, TENANT, column_of(t.mapping, key), shape, START, end))


def view_of(t: Stored) -> DataFrame:
    return views.tenant_view(t.flat, t.mapping, TENANT)


def view_columns(view: DataFrame) -> DataFrame:
    """A selection of a view's columns, metrics by name."""
    return view.select(
        "timestampMs", "clientId", "sessionId", "event_count",
        F.col("f_1_view_success").alias("view_success"), "retries",
        F.round(F.col("view_value").cast("double"), 4).alias("view_value"),
    )


def registered_view(t: Stored) -> DataFrame:
    return t.flat.sparkSession.table(views.register_view(t.flat, t.mapping, TENANT))


# ---- locator, reports, validation -------------------------------------------------------------


def locator(t: Stored) -> DataFrame:
    return locate.metric_locator(scan(t.wide, START, END), t.mapping.keys)


def selected_locator(t: Stored) -> DataFrame:
    """Locator of two metrics for every tenant."""
    wanted = t.mapping.tenants.select(
        "customer_id", F.explode(F.array(F.lit("event_count"), F.lit("retries"))).alias("metric_key")
    )
    return locate.metric_locator(t.wide, t.mapping.keys, wanted)


def end_of(shape: str) -> str:
    """The end of a report's range; a bounded one ends with the window."""
    return str(window_end(START, WINDOW_HOURS)) if shape == "minute_window" else END


def flat_report(shape: str) -> Query:
    return on_tables(lambda t: report.flat_report(t.flat, locator(t), shape, START, end_of(shape)))


def map_report(shape: str) -> Query:
    """Shapes other than 'dims' read the pattern metric over all flows."""
    rows = locator if shape == "dims" else lambda t: locate.pattern_rows(locator(t))
    return on_tables(lambda t: report.map_report(t.wide, rows(t), shape, START, end_of(shape)))


def both_reports(t: Stored) -> tuple[DataFrame, DataFrame]:
    located = materialise(locator(t))
    old = report.map_report(t.wide, located, "dims", START, END)
    return old, report.flat_report(t.flat, located, "dims", START, END)


def totals(t: Stored) -> DataFrame:
    return validate.compare_totals(*both_reports(t))


def build() -> dict[str, Query]:
    event_group = "metricIntGroup15"
    window = str(window_end(START, WINDOW_HOURS))
    ints = group_columns("int")
    out: dict[str, Query] = {
        "discover_int_keys": discover("int"),
        "discover_float_keys": discover("float"),
        "discover_tag_keys": discover("string"),
        "key_lists": on_tables(lambda t: joined_keys(discovery.key_lists(discovery.discover_entries(t.wide)))),
        "distinct_tenants": on_tables(lambda t: discovery.tenants_by_day(t.wide)),
        "day_list": on_tables(lambda t: discovery.day_list(t.wide)),
        "chunk_grid": on_tables(lambda t: discovery.chunk_grid(t.wide, CHUNK_MINUTES)),
        "assign_columns": on_tables(lambda t: mapping.assign_columns(discovery.discover_keys(t.wide))),
        "reverse_mapping": on_tables(lambda t: mapping.reverse_mapping(t.mapping.keys)),
        "max_columns": on_tables(lambda t: mapping.max_columns(t.mapping.keys)),
        "normalise_tags": on_tables(lambda t: joined_keys(mapping.normalise_tags(tag_lists(t)))),
        "tag_columns": on_tables(lambda t: mapping.tag_mapping(mapping.normalise_tags(tag_lists(t)))),
        "string_columns": on_tables(lambda t: mapping.string_columns_needed(mapping.normalise_tags(tag_lists(t)))),
        "flatten_minute": flattened("minute"),
        "flatten_hour": flattened("hour"),
        "flatten_day": flattened("day"),
        "flatten_day_sum": flattened("day", "sum"),
        "unmapped_keys": on_tables(unmapped),
        "compression_stats": on_tables(lambda t: rounded(preagg.compression_stats(t.wide), DIGITS)),
        "run_totals": on_tables(lambda t: preagg.run_totals(preagg.compression_stats(t.wide))),
        "metric_map_dims": map_metric("dims", DIMS_METRIC, "metricIntGroup1", END, DIMS_FLOW),
        "metric_map_country": map_metric("country", COUNT_METRIC, event_group, END),
        "metric_map_minute": map_metric("minute", COUNT_METRIC, event_group, END),
        "metric_map_minute_window": map_metric("minute", COUNT_METRIC, event_group, window),
        "metric_flat_dims": flat_metric("dims", DIMS_METRIC, END),
        "metric_flat_country": flat_metric("country", COUNT_METRIC, END),
        "metric_flat_minute": flat_metric("minute", COUNT_METRIC, END),
        "metric_flat_minute_window": flat_metric("minute", COUNT_METRIC, window),
        "metric_direct_dims": on_tables(
            lambda t: metrics.direct_metric(t.flat, TENANT, column_of(t.mapping, DIMS_METRIC), START, END)
        ),
        "metric_view_dims": on_tables(lambda t: metrics.view_metric(registered_view(t), DIMS_METRIC, START, END)),
        "tenant_view_rows": on_tables(lambda t: view_columns(view_of(t))),
        "view_sample_row": on_tables(
            lambda t: view_columns(views.sample_row(view_of(t), ["timestampMs", "clientId", "sessionId"]))
        ),
        "verify_view": on_tables(lambda t: views.verify_view(view_of(t))),
        "tenant_summary": on_tables(lambda t: views.tenant_summary(t.flat, t.mapping)),
        "column_profile": on_tables(lambda t: rounded(profile.column_profile(t.flat), 3)),
        "class_profile": on_tables(lambda t: profile.class_profile(profile.column_profile(t.flat))),
        "rows_by_month": on_tables(lambda t: profile.rows_by_month(t.flat)),
        "rows_where": on_tables(lambda t: count_where(t.flat, (F.col("int1") > 0) & (F.col("platform") == "ios"))),
        "kept_columns": on_tables(
            lambda t: without_excluded(t.wide).drop(*ints, *group_columns("float"), "eventDate")
        ),
        "key_presence": on_tables(
            lambda t: t.wide.where(any_group_has(ints, "retries"))
            .groupBy(F.col("customerId").alias("customer_id"), first_group_with(ints, "retries").alias("first_group"))
            .agg(F.count("*").alias("rows"))
        ),
        "map_value_sum": on_tables(
            lambda t: t.wide.groupBy(F.col("customerId").alias("customer_id")).agg(
                F.count("*").alias("rows"), F.sum(map_value("metricIntGroup4", "retries")).alias("retries")
            )
        ),
        "metric_flows": on_tables(lambda t: locate.metric_flows(locate.flow_counts(t.wide))),
        "metric_group": on_tables(lambda t: locate.metric_group(locate.flow_counts(t.wide))),
        "metric_locator": on_tables(locator),
        "metric_locator_selected": on_tables(selected_locator),
        "pattern_rows": on_tables(lambda t: locate.pattern_rows(locator(t))),
        "validate_totals": on_tables(totals),
        "validate_groups": on_tables(
            lambda t: validate.compare_groups(*both_reports(t), metrics.shape_names("dims"))
        ),
        "validation_summary": on_tables(lambda t: validate.validation_summary(totals(t))),
        "timing_metric_stats": on_samples(timing.metric_stats),
        "timing_speedups": on_samples(lambda s: timing.fastest_first(timing.speedups(s))),
        "timing_by_tenant": on_samples(lambda s: timing.speedup_by_tenant(timing.speedups(s))),
        "timing_by_type": on_samples(lambda s: timing.speedup_by_type(timing.speedups(s))),
        "timing_overall": on_samples(timing.overall),
        "view_timing_stats": on_samples(timing.view_stats),
        "view_overhead": on_samples(lambda s: timing.largest_overhead_first(timing.view_overhead(s))),
        "view_overall": on_samples(lambda s: timing.view_overall(timing.view_overhead(s))),
        "view_by_tenant": on_samples(lambda s: timing.view_by_tenant(timing.view_overhead(s))),
    }
    out |= {name: on_tables(query) for name, query in stores.on_tables().items()}
    out |= stores.on_folder()
    for shape in report.QUERY_TYPES:
        out[f"metric_report_{shape}"] = flat_report(shape)
        out[f"metric_report_map_{shape}"] = map_report(shape)
    return out


