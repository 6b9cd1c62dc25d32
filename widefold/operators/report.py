"""All located metrics of all tenants in one pass, in long form."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from widefold.model import group_columns
from widefold.operators.locate import ALL_FLOWS
from widefold.operators.metrics import shape_columns, shape_names
from widefold.plans.small_side import join_lookup, materialise
from widefold.sources.wide import scan

# The query type of each report shape.
QUERY_TYPES = {
    "dims": "aggregation",
    "country": "groupby_country",
    "minute": "groupby_minute",
    "minute_window": "groupby_minute_filtered",
}


def grouping(shape: str) -> str:
    """The shape of metrics that a report shape groups by; a bounded one differs in its range alone."""
    return "minute" if shape == "minute_window" else shape


def flat_report(
    flat: DataFrame, locator: DataFrame, shape: str, start: str | datetime, end: str | datetime
) -> DataFrame:
    """customer_id, metric_key, query_type, the shape's columns, metric_sum, from the flat table.

    The columns the locator names (no more than the table is wide) are summed side by side, and
    only the sums are turned into rows. Rows not above 0 are left out of the sums, and a group
    without any is left out of the result. Stores the locator and gathers its column names when called.
    """
    query_type, shape = QUERY_TYPES[shape], grouping(shape)
    located = materialise(locator.select("customer_id", "metric_key", "target_physical_column"))
    columns = sorted(r[0] for r in located.select("target_physical_column").distinct().collect())
    if not columns:
        raise ValueError("the locator holds no metric")
    sums = [F.expr(f"sum(CASE WHEN {c} > 0 THEN {c} END) AS {c}") for c in columns]
    grouped = scan(flat, start, end).groupBy(F.col("customerId").alias("customer_id"), *shape_columns(shape)).agg(*sums)
    cells = ", ".join(f"struct('{c}' AS target_physical_column, {c} AS metric_sum)" for c in columns)
    long = grouped.selectExpr("customer_id", *shape_names(shape), f"inline(array({cells}))").where(
        "metric_sum IS NOT NULL"
    )
    joined = join_lookup(long, located, ["customer_id", "target_physical_column"])
    return joined.select(
        "customer_id", "metric_key", F.lit(query_type).alias("query_type"), *shape_names(shape), "metric_sum"
    )


def map_report(
    fact: DataFrame, locator: DataFrame, shape: str, start: str | datetime, end: str | datetime
) -> DataFrame:
    """The same from the map table: entries in the located map column, flow by flow.

    Only the map columns that the locator names are read. Their numbers, GROUPS_PER_KIND at most,
    are gathered when called.
    """
    query_type, shape = QUERY_TYPES[shape], grouping(shape)
    located = materialise(
        locator.select(
            F.col("customer_id").alias("customerId"),
            F.col("metric_key").alias("key"),
            F.regexp_extract("source_map_column", r"(\d+)$", 1).cast("int").alias("group_no"),
            F.col("flowid").alias("wanted_flow"),
        )
    )
    numbers = sorted(r["group_no"] for r in located.select("group_no").distinct().collect())
    if not numbers:
        raise ValueError("the locator holds no metric")
    names = group_columns("int")
    maps = F.array(*[F.struct(F.lit(n).alias("group_no"), F.col(names[n - 1]).alias("map")) for n in numbers])
    entries = (
        scan(fact, start, end)
        .select("customerId", "flowId", *shape_columns(shape), F.inline(maps))
        .select("customerId", "flowId", *shape_names(shape), "group_no", F.explode("map").alias("key", "value"))
        .where("value > 0")
    )
    joined = join_lookup(entries, located, ["customerId", "group_no", "key"])
    kept = joined.where((F.col("wanted_flow") == ALL_FLOWS) | (F.col("wanted_flow") == F.col("flowId")))
    return (
        kept.groupBy("customerId", "key", *shape_names(shape))
        .agg(F.sum("value").alias("metric_sum"))
        .select(
            F.col("customerId").alias("customer_id"),
            F.col("key").alias("metric_key"),
            F.lit(query_type).alias("query_type"),
            *shape_names(shape),
            "metric_sum",
        )
    )
