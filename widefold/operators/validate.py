"""Comparison of the two ways to compute a metric."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

METRIC = ["customer_id", "metric_key", "query_type"]


def _totals(report: DataFrame, side: str) -> DataFrame:
    return report.groupBy(*METRIC).agg(
        F.count("*").alias(f"row_count_{side}"), F.sum("metric_sum").alias(f"{side}_total_sum")
    )


def compare_totals(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per metric: result rows and total of both sides, passed when the totals are equal.

    A metric that only one side has counts as 0 on the other.
    """
    both = _totals(old, "old").join(_totals(new, "new"), METRIC, "full_outer")
    numbers = ["row_count_old", "row_count_new", "old_total_sum", "new_total_sum"]
    filled = both.na.fill(0, numbers)
    return filled.select(
        *METRIC,
        (F.col("old_total_sum") == F.col("new_total_sum")).alias("passed"),
        *numbers,
        F.abs(F.col("old_total_sum") - F.col("new_total_sum")).alias("difference"),
    )


def compare_groups(old: DataFrame, new: DataFrame, groups: list[str]) -> DataFrame:
    """Groups whose sums differ, or that one side lacks: both sums and their difference.

    Stricter than compare_totals, which differences of opposite sign can pass.
    """
    keys = [*METRIC, *groups]
    sides = []
    for df, side in ((old, "old"), (new, "new")):
        named = [F.col(c).alias(f"{side}_{c}") for c in keys]
        sides.append(df.select(*named, F.col("metric_sum").alias(f"{side}_sum")))
    same = reduce(lambda a, b: a & b, (F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in keys))
    both = sides[0].join(sides[1], same, "full_outer")
    merged = [F.coalesce(f"old_{c}", f"new_{c}").alias(c) for c in keys]
    return both.where(~F.col("old_sum").eqNullSafe(F.col("new_sum"))).select(
        *merged,
        "old_sum",
        "new_sum",
        F.abs(_zero(F.col("old_sum")) - _zero(F.col("new_sum"))).alias("difference"),
    )


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def validation_summary(results: DataFrame) -> DataFrame:
    """Per tenant: metrics, passed, failed, and whether all passed."""
    return results.groupBy("customer_id").agg(
        F.count("*").alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.every("passed").alias("all_passed"),
    )


def require_valid(results: DataFrame) -> None:
    """Fail when any metric did not pass."""
    failed = results.where(~F.col("passed")).count()
    if failed:
        raise ValueError(f"{failed} metrics differ between the two paths")
