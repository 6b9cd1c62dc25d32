"""Summaries of query-timing samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from widefold.functions.labels import improvement_percent, metric_type, ratio_or_zero
from widefold.operators.order_stats import median_positions, order_statistics, share_position

METRIC = ["customer_id", "customer_name", "metric_key"]
SECONDS = "execution_time_seconds"


def summary(samples: DataFrame, by: list[str], value: str = SECONDS, tails: bool = False) -> DataFrame:
    """Per group: runs, min, max, mean, median, sample deviation (0 for one run), and p95, p99 if asked."""
    positions = median_positions()
    if tails:
        positions |= {"p95": share_position(0.95), "p99": share_position(0.99)}
    return order_statistics(samples, by, value, positions).withColumn(
        "median", (F.col("lower_middle") + F.col("upper_middle")) / 2
    ).drop("lower_middle", "upper_middle")


def metric_stats(samples: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Per metric and schema type; extra columns such as query_type split further."""
    return summary(samples, [*METRIC, *(extra or []), "schema_type"])


def _average_of(kind_column: str, kind: str) -> Column:
    return F.avg(F.when(F.col(kind_column) == kind, F.col(SECONDS)))


def speedups(samples: DataFrame) -> DataFrame:
    """Per metric: mean of both schema types, speedup and improvement. NULL when one type has no run."""
    means = samples.groupBy(*METRIC).agg(
        _average_of("schema_type", "old").alias("old_avg"), _average_of("schema_type", "new").alias("new_avg")
    )
    old, new = F.col("old_avg"), F.col("new_avg")
    return means.withColumn("speedup", ratio_or_zero(old, new)).withColumn(
        "improvement_percent", improvement_percent(old, new)
    )


def _speedup_summary(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(
        F.count("*").alias("metrics_count"),
        F.avg("speedup").alias("avg_speedup"),
        F.min("speedup").alias("min_speedup"),
        F.max("speedup").alias("max_speedup"),
    )


def speedup_by_tenant(per_metric: DataFrame) -> DataFrame:
    return _speedup_summary(per_metric, "customer_name")


def speedup_by_type(per_metric: DataFrame) -> DataFrame:
    return _speedup_summary(per_metric.withColumn("metric_type", metric_type(F.col("metric_key"))), "metric_type")


def fastest_first(per_metric: DataFrame) -> DataFrame:
    """Metrics by speedup, largest first."""
    return per_metric.orderBy(F.desc("speedup"), "customer_id", "metric_key")


def overall(samples: DataFrame) -> DataFrame:
    """One row: statistics over all runs of each schema type, speedup of the means, improvement."""
    stats = summary(samples.where(F.col("schema_type").isin("old", "new")), ["schema_type"])
    names = ["runs", "avg", "min", "max", "median", "stdev"]
    sides = [
        F.max(F.when(F.col("schema_type") == side, F.col(n))).alias(f"{side}_{n}") for side in ("old", "new") for n in names
    ]
    old, new = F.col("old_avg"), F.col("new_avg")
    return stats.agg(*sides).select(
        "*",
        ratio_or_zero(old, new).alias("overall_speedup"),
        improvement_percent(old, new).alias("improvement_percent"),
    )


# ---- direct table against tenant view ---------------------------------------------------------


def view_stats(samples: DataFrame) -> DataFrame:
    """Per metric and access type, with p95 and p99."""
    return summary(samples, [*METRIC, "access_type"], tails=True)


def view_overhead(samples: DataFrame) -> DataFrame:
    """Per metric: mean of both access types, overhead in seconds and in percent."""
    means = samples.groupBy(*METRIC).agg(
        _average_of("access_type", "direct_table").alias("direct_mean"),
        _average_of("access_type", "through_view").alias("view_mean"),
    )
    overhead = F.col("view_mean") - F.col("direct_mean")
    return means.withColumn("overhead_seconds", overhead).withColumn(
        "overhead_percent", ratio_or_zero(F.col("overhead_seconds") * 100, F.col("direct_mean"))
    )


def largest_overhead_first(per_metric: DataFrame) -> DataFrame:
    return per_metric.orderBy(F.desc("overhead_percent"), "customer_id", "metric_key")


def view_overall(per_metric: DataFrame) -> DataFrame:
    """Per access type: statistics over the metrics' means, and the mean overhead in percent."""
    sides = F.array(
        F.struct(F.lit("direct_table").alias("access_type"), F.col("direct_mean").alias("mean")),
        F.struct(F.lit("through_view").alias("access_type"), F.col("view_mean").alias("mean")),
    )
    means = per_metric.select("overhead_percent", F.inline(sides))
    mean_overhead = means.groupBy("access_type").agg(F.avg("overhead_percent").alias("avg_overhead_percent"))
    return summary(means, ["access_type"], "mean", tails=True).join(mean_overhead, "access_type")


def view_by_tenant(per_metric: DataFrame) -> DataFrame:
    return per_metric.groupBy("customer_name").agg(
        F.avg("direct_mean").alias("direct_mean"),
        F.avg("view_mean").alias("view_mean"),
        F.avg("overhead_percent").alias("overhead_percent"),
    )
