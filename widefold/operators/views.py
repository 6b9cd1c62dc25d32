"""Tenant views: positional columns under their metric names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from widefold.model import STANDARD_COLUMNS
from widefold.operators.mapping import KeyMapping


def tenant_view(flat: DataFrame, mapping: KeyMapping, tenant: int) -> DataFrame:
    """Standard columns and the tenant's metrics by name, int before float, each sorted by name.

    Only the tenant's column names come to the driver; they are part of the view's schema.
    """
    named = (
        mapping.keys.where((F.col("customer_id") == tenant) & F.col("kind").isin("int", "float"))
        .select("kind", "key", "column")
        .collect()
    )
    ordered = sorted(named, key=lambda r: (r["kind"] != "int", r["key"]))
    extra = ["eventDate"] if "eventDate" in flat.columns else []
    metrics = [F.col(r["column"]).alias(r["key"]) for r in ordered]
    return flat.where(F.col("customerId") == tenant).select(*STANDARD_COLUMNS, *extra, *metrics)


def view_name(tenant: int) -> str:
    return f"tenant_{tenant}_view"


def register_view(flat: DataFrame, mapping: KeyMapping, tenant: int) -> str:
    """Create or replace the tenant's temporary view; gives its name."""
    name = view_name(tenant)
    tenant_view(flat, mapping, tenant).createOrReplaceTempView(name)
    return name


def verify_view(view: DataFrame) -> DataFrame:
    """Row count and whether there are rows, in one pass."""
    rows = F.count("*")
    return view.agg(rows.alias("row_count"), (rows > 0).alias("has_data"))


def sample_row(df: DataFrame, order_by: list[str]) -> DataFrame:
    """One row, the first in the given order."""
    return df.orderBy(*order_by).limit(1)


def tenant_summary(flat: DataFrame, mapping: KeyMapping) -> DataFrame:
    """Per tenant of the mapping: rows, whether there are rows, int metrics, float metrics."""
    rows = flat.groupBy(F.col("customerId").alias("customer_id")).agg(F.count("*").alias("row_count"))
    metrics = mapping.keys.groupBy("customer_id").agg(
        F.count_if(F.col("kind") == "int").alias("int_metrics"),
        F.count_if(F.col("kind") == "float").alias("float_metrics"),
    )
    return (
        mapping.tenants.join(rows, "customer_id", "left")
        .join(metrics, "customer_id", "left")
        .na.fill(0, ["row_count", "int_metrics", "float_metrics"])
        .withColumn("has_data", F.col("row_count") > 0)
    )
