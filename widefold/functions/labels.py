"""Labels and ratios used by the timing and log reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def metric_type(key: Column) -> Column:
    """Type of a metric, read from its name. The tests apply in this order."""
    return (
        F.when(key.contains("success"), "success_count")
        .when(key.contains("total_duration") | key.contains("time"), "duration")
        .otherwise("other")
    )


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).when(denominator <= 0, F.lit(0.0))


def improvement_percent(old: Column, new: Column) -> Column:
    """Share of the old time that the new one saves, in percent; 0 when the old time is 0."""
    return ratio_or_zero((old - new) * 100, old)


def duration_text(seconds: Column) -> Column:
    """'12.3s' below a minute, else '4m 5s'."""
    minutes = F.floor(seconds / 60)
    rest = F.bround(seconds - minutes * 60, 0).cast("int")
    return F.when(seconds < 60, F.format_string("%.1fs", F.bround(seconds, 1))).otherwise(
        F.format_string("%dm %ds", minutes, rest)
    )


def period_label(start_text: Column, end_text: Column) -> Column:
    """'HH:MM-HH:MM' from two 'YYYY-MM-DD HH:MM:SS' texts."""
    return F.concat(F.substring(start_text, 12, 5), F.lit("-"), F.substring(end_text, 12, 5))
