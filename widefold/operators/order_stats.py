"""Exact values at given positions of a sorted group, for groups of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from widefold.plans.small_side import materialise


def order_statistics(
    samples: DataFrame, by: list[str], value: str, positions: dict[str, Callable[[Column], Column]]
) -> DataFrame:
    """Per group: runs, min, max, avg, stdev (0 for one run), and for each name the value at the 0-based
    position positions[name](n). Values that are NULL are not counted.

    The samples are read once. Equal values are counted together, and the counts are dealt out in
    ranges of (group, value): as many as the session's shuffle partitions, joined by adaptive
    execution where they are small. So a large group is cut into as many ranges as its share of the
    values, whatever the other groups are. The ranges are stored, since the place of a value is
    worked out in two steps that must see the same ones: a running count over the ranges of a group
    gives the rank at which each begins, and each range is then ranked by its own task. Stores the
    counts when called.
    """
    counted = samples.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("c"))
    ranged = materialise(counted.repartitionByRange(*by, "v").withColumn("range_no", F.spark_partition_id()))
    totals = ranged.groupBy(*by, "range_no").agg(
        F.sum("c").alias("in_range"), F.sum(F.col("v") * F.col("c")).alias("sum_v"),
    )
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(c).alias(f"of_{c}") for c in by],
        F.col("range_no").alias("of_range"),
        F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("range_start"),
        F.sum("in_range").over(whole).alias("n"),
        (F.sum("sum_v").over(whole) / F.sum("in_range").over(whole)).alias("mean"),
    )
    up_to = Window.partitionBy(*by, "range_no").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.withColumn("last", F.sum("c").over(up_to))
    same = F.col("range_no") == F.col("of_range")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    ranked = inside.join(starts, same).withColumn("last", F.col("range_start") + F.col("last"))
    picks = []
    for name, position in positions.items():
        at = position(F.col("n")).cast("bigint")
        here = (at >= F.col("last") - F.col("c")) & (at < F.col("last"))
        picks.append(F.max(F.when(here, F.col("v"))).alias(name))
    n, mean = F.first("n"), F.first("mean")
    spread = F.sum(F.col("c") * (F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean")))
    return ranked.groupBy(*by).agg(
        n.alias("runs"), F.min("v").alias("min"), F.max("v").alias("max"), mean.alias("avg"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).otherwise(0.0).alias("stdev"), *picks,
    )


def median_positions() -> dict[str, Callable[[Column], Column]]:
    """The two middle positions; they are the same one when n is odd."""
    return {
        "lower_middle": lambda n: F.floor((n - 1) / 2),
        "upper_middle": lambda n: F.floor(n / 2),
    }


def share_position(share: float) -> Callable[[Column], Column]:
    """Position floor(n * share), the product taken in double precision."""
    return lambda n: F.floor(n.cast("double") * F.lit(share))
