"""Tenant views in the catalog, which other sessions read by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from widefold.model import STANDARD_COLUMNS, flat_schema
from widefold.operators.mapping import KeyMapping
from widefold.sources.flat import create_flat_table
from widefold.sources.loads import VERSION_COLUMN, Record, read_record


def quoted(name: str) -> str:
    """A name as an identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def live_condition(record: Record) -> str:
    """SQL of the condition that a folder is live; constant per day, so that it prunes folders."""
    if not record.live:
        return "false"
    pairs = ", ".join(
        f"DATE{text(d.isoformat())}, array({', '.join(text(v) for v in record.live[d])})" for d in sorted(record.live)
    )
    return f"coalesce(array_contains(element_at(map({pairs}), eventDate), {VERSION_COLUMN}), false)"


def view_sql(view: str, table: str, tenant: int, names: list[tuple[str, str]], condition: str) -> str:
    """Creates a tenant's view: standard columns, the day, then metrics by name.

    names: key and positional column. A key that is called like a standard column, or like another key but for
    the case, gets its column's name behind it, since a view tells its columns apart without regard to case.
    """
    standard = [*STANDARD_COLUMNS, "eventDate"]
    taken = {c.lower() for c in standard}
    metrics = []
    for key, column in names:
        shown = key if key.lower() not in taken else f"{key}_{column}"
        taken.add(shown.lower())
        metrics.append(f"{quoted(column)} AS {quoted(shown)}")
    columns = ",\n  ".join([*map(quoted, standard), *metrics])
    return (
        f"CREATE OR REPLACE VIEW {quoted(view)} AS\nSELECT\n  {columns}\nFROM {quoted(table)}\n"
        f"WHERE customerId = {int(tenant)} AND {condition}"
    )


def table_of(name: str, number: int) -> str:
    return f"{name}_load_{number}"


def view_of(name: str, tenant: int) -> str:
    return f"{name}_tenant_{tenant}"


def publish_views(spark: SparkSession, path: str, name: str, mapping: KeyMapping) -> list[str]:
    """Create or replace the views of all tenants of a loaded table as its last load left it; gives their names.

    Call it after each load: the views name the live versions and the keys known by then. The folders are listed
    once, into the catalog, from which queries then choose theirs. Each call has a table of its own in the catalog over the same folders, so that no session answers from a file list that it
    has cached for an earlier load; tables of earlier calls are dropped once no view refers to them. The
    data belongs to the path and stays.

    The tenants and their column names come to the driver; they are part of the views' schemas.
    """
    record = read_record(spark, path)
    table = table_of(name, record.number)
    schema = flat_schema(mapping.int_columns, mapping.float_columns)
    create_flat_table(spark, quoted(table), schema, path, drop=True, more_parts=[VERSION_COLUMN])
    spark.sql(f"ALTER TABLE {quoted(table)} RECOVER PARTITIONS")
    numeric = mapping.keys.where(F.col("kind").isin("int", "float"))
    per_tenant: dict[int, list] = {r["customer_id"]: [] for r in mapping.tenants.collect()}
    for r in numeric.select("customer_id", "kind", "key", "column").collect():
        per_tenant.setdefault(r["customer_id"], []).append((r["kind"] != "int", r["key"], r["column"]))
    condition, views = live_condition(record), []
    for tenant, found in sorted(per_tenant.items()):
        names = [(key, column) for _, key, column in sorted(found)]
        spark.sql(view_sql(view_of(name, tenant), table, tenant, names, condition))
        views.append(view_of(name, tenant))
    for row in spark.sql("SHOW TABLES").where(F.col("tableName").startswith(f"{name}_load_")).collect():
        if row["tableName"] != table:
            spark.sql(f"DROP TABLE IF EXISTS {quoted(row['tableName'])}")
    return views


def drop_views(spark: SparkSession, name: str) -> None:
    """Drop the views and tables of publish_views. The data stays."""
    shown = spark.sql("SHOW TABLES").where(
        F.col("tableName").startswith(f"{name}_tenant_") | F.col("tableName").startswith(f"{name}_load_")
    )
    for row in shown.collect():
        kind = "VIEW" if row["tableName"].startswith(f"{name}_tenant_") else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {quoted(row['tableName'])}")


def view_catalog(spark: SparkSession, name: str) -> DataFrame:
    """Name, tenant and number of columns of each view that is there."""
    rows = []
    for row in spark.sql("SHOW VIEWS").where(F.col("viewName").startswith(f"{name}_tenant_")).collect():
        view = row["viewName"]
        rows.append((view, int(view.rsplit("_", 1)[1]), len(spark.table(quoted(view)).columns)))
    schema = T.StructType([
        T.StructField("view_name", T.StringType()), T.StructField("customer_id", T.IntegerType()), T.StructField("columns", T.IntegerType()),
    ])
    return spark.createDataFrame(rows, schema)
