"""Sums of one metric of one tenant, from the map table, the flat table or a tenant view."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from widefold.functions.times import start_of
from widefold.model import DIMENSIONS
from widefold.sources.wide import scan

SHAPES = ("dims", "country", "minute")


def shape_columns(shape: str) -> list[Column]:
    """Group columns of a report shape."""
    if shape == "dims":
        return [F.col(c) for c in DIMENSIONS]
    if shape == "country":
        return [F.col("country")]
    if shape == "minute":
        return [start_of("minute", "timestampMs").alias("minute")]
    raise ValueError(f"unknown shape: {shape}")


def shape_names(shape: str) -> list[str]:
    return {"dims": list(DIMENSIONS), "country": ["country"], "minute": ["minute"]}[shape]


def sum_by_shape(rows: DataFrame, value: Column, shape: str, only_positive: bool = True) -> DataFrame:
    """Sum of a value per group of a shape; rows whose value is not above 0 may be left out."""
    kept = rows.where(value > 0) if only_positive else rows
    return kept.groupBy(*shape_columns(shape)).agg(F.sum(value).alias("metric_sum"))


def map_metric(
    fact: DataFrame,
    tenant: int,
    group: str,
    key: str,
    shape: str,
    start: str | datetime,
    end: str | datetime,
    flow: str | None = None,
) -> DataFrame:
    """Metric from the map table, ordered by its groups. Each raw row must be above 0."""
    rows = scan(fact, start, end, tenant, flow)
    return sum_by_shape(rows, F.col(group)[key], shape).orderBy(*shape_names(shape))


def flat_metric(
    flat: DataFrame, tenant: int, column: str, shape: str, start: str | datetime, end: str | datetime
) -> DataFrame:
    """Metric from the flat table, ordered by its groups.

    The flat table has no flow, so the condition above 0 stands in for it.
    """
    return sum_by_shape(scan(flat, start, end, tenant), F.col(column), shape).orderBy(*shape_names(shape))


def direct_metric(
    flat: DataFrame, tenant: int, column: str, start: str | datetime, end: str | datetime
) -> DataFrame:
    """Metric by dimensions from the flat table, groups that sum to 0 included."""
    return sum_by_shape(scan(flat, start, end, tenant), F.col(column), "dims", only_positive=False)


def view_metric(view: DataFrame, metric: str, start: str | datetime, end: str | datetime) -> DataFrame:
    """The same through a tenant view, by the metric's own name."""
    return sum_by_shape(scan(view, start, end), F.col(f"`{metric}`"), "dims", only_positive=False)
