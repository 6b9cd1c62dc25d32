"""Where each metric of each tenant is found: its flow, its map column and its flat column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from widefold.functions.maps import key_arrays
from widefold.model import GROUP_PREFIX, group_columns
from widefold.operators.mapping import physical_column

TOP_FLOWS = 10
ALL_FLOWS = "ALL"
PATTERN_METRIC = "event_count"


def flow_counts(fact: DataFrame) -> DataFrame:
    """Per (customer_id, metric_key, flowid): rows that hold the metric, and the lowest map column.

    One scan, one shuffle of partial counts. A row that holds a key in several int maps counts
    once: an entry counts only when no lower map of the row holds its key.
    """
    arrays = key_arrays(group_columns("int"))
    entries = fact.select("customerId", "flowId", arrays.alias("all_keys")).select(
        "customerId", "flowId", "all_keys", F.posexplode("all_keys").alias("pos", "keys")
    )
    lower = F.flatten(F.slice("all_keys", 1, F.col("pos")))
    keyed = entries.select(
        F.col("customerId").alias("customer_id"),
        F.col("flowId").alias("flowid"),
        (F.col("pos") + 1).alias("group_no"),
        F.when(F.size("keys") > 0, lower).alias("lower_keys"),
        F.explode("keys").alias("metric_key"),
    )
    return keyed.groupBy("customer_id", "metric_key", "flowid").agg(
        F.count_if(~F.array_contains("lower_keys", F.col("metric_key"))).alias("cnt"),
        F.min("group_no").alias("group_no"),
    )


def metric_flows(counts: DataFrame, limit: int = TOP_FLOWS) -> DataFrame:
    """The most frequent flows of each metric, the lower flow name first among equals."""
    by_count = Window.partitionBy("customer_id", "metric_key").orderBy(F.desc("cnt"), "flowid")
    return (
        counts.withColumn("flow_rank", F.row_number().over(by_count))
        .where(F.col("flow_rank") <= limit)
        .select("customer_id", "metric_key", "flowid", "cnt", "flow_rank")
    )


def metric_group(counts: DataFrame) -> DataFrame:
    """The chosen flow of each metric, its map column there, and whether it has further flows."""
    best = F.min(F.struct((-F.col("cnt")).alias("order"), "flowid", "group_no"))
    chosen = counts.groupBy("customer_id", "metric_key").agg(
        best.alias("best"), (F.count("*") > 1).alias("has_multiple_flowids")
    )
    return chosen.select(
        "customer_id",
        "metric_key",
        F.col("best.flowid").alias("flowid"),
        F.concat(F.lit(GROUP_PREFIX["int"]), F.col("best.group_no").cast("string")).alias("source_map_column"),
        "has_multiple_flowids",
    )


def metric_locator(fact: DataFrame, mapping: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Locator rows of all metrics, or of the wanted (customer_id, metric_key) pairs.

    A wanted metric that no flow holds is an error, as is one without a column.
    """
    groups = metric_group(flow_counts(fact))
    if wanted is None:
        known = mapping.where("kind = 'int'").select("customer_id", F.col("key").alias("metric_key"))
        located = groups.join(known, ["customer_id", "metric_key"], "left_semi")
    else:
        message = F.concat(F.lit("no flow holds metric "), "metric_key")
        located = wanted.join(groups, ["customer_id", "metric_key"], "left").withColumn(
            "flowid", F.coalesce("flowid", F.raise_error(message))
        )
    return physical_column(located, mapping).select(
        "customer_id", "metric_key", "flowid", "source_map_column", "target_physical_column", "has_multiple_flowids"
    )


def pattern_rows(locator: DataFrame, metric: str = PATTERN_METRIC) -> DataFrame:
    """Locator rows of one metric, set to read every flow."""
    return locator.where(F.col("metric_key") == metric).withColumn("flowid", F.lit(ALL_FLOWS))


