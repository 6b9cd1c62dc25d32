"""Profiles of a flat table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from widefold.functions.times import month_key
from widefold.model import column_class


def column_profile(flat: DataFrame) -> DataFrame:
    """Per tenant and positional column: rows other than 0 and their sum.

    All columns are aggregated side by side, one row per tenant; only those rows are turned into
    one row per column.
    """
    names = [c for c in flat.columns if column_class(c) in ("int", "float")]
    counts = [F.expr(f"count_if({c} != 0) AS {c}_used") for c in names]
    sums = [F.expr(f"sum(CAST({c} AS DOUBLE)) AS {c}_sum") for c in names]
    wide = flat.groupBy(F.col("customerId").alias("customer_id")).agg(*counts, *sums)
    cells = [
        f"struct('{c}' AS column, '{column_class(c)}' AS column_class, {c}_used AS used_rows, {c}_sum AS total)"
        for c in names
    ]
    return wide.selectExpr("customer_id", f"inline(array({', '.join(cells)}))")


def class_profile(profile: DataFrame) -> DataFrame:
    """Per column class: columns, columns that any tenant uses, used cells."""
    per_column = profile.groupBy("column_class", "column").agg(F.sum("used_rows").alias("used_rows"))
    return per_column.groupBy("column_class").agg(
        F.count("*").alias("columns"),
        F.count_if(F.col("used_rows") > 0).alias("columns_in_use"),
        F.sum("used_rows").alias("used_cells"),
    )


def column_counts(flat: DataFrame) -> dict[str, int]:
    """Number of int, float, string and metadata columns, read from the schema."""
    classes = [column_class(c) for c in flat.columns if c != "eventDate"]
    return reduce(lambda n, c: {**n, c: n.get(c, 0) + 1}, classes, {"total": len(classes)})


def rows_by_month(flat: DataFrame) -> DataFrame:
    """Rows of each month and tenant."""
    return flat.groupBy(month_key("timestampMs").alias("month"), F.col("customerId").alias("customer_id")).agg(
        F.count("*").alias("rows")
    )
