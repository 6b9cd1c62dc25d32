"""Dense numbering of each tenant's keys, and lookups in it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from widefold.model import GROUPS_PER_KIND
from widefold.operators.discovery import discover_entries, keys_of, tenants_of
from widefold.plans.small_side import materialise

RANKS_PER_COLUMN = GROUPS_PER_KIND + 1


@dataclass(frozen=True)
class KeyMapping:
    """A mapping whose keys are materialised.

    keys: customer_id, kind, key, idx, column.  tenants: customer_id.
    int_columns and float_columns are the width of the widest tenant.
    """

    keys: DataFrame
    tenants: DataFrame
    int_columns: int
    float_columns: int


def assign_columns(keys: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Number each tenant's sorted keys of a kind: customer_id, kind, key, idx, column.

    With an existing mapping only the keys it lacks are numbered, from the tenant's largest number
    on, so that a number never changes its meaning; else numbers begin at 1. A window holds the
    distinct keys of one tenant and kind, which is the width of its table.
    """
    by_key = Window.partitionBy("customer_id", "kind").orderBy("key")
    begin = F.lit(0)
    if existing is not None:
        keys = keys.join(existing, ["customer_id", "kind", "key"], "left_anti")
        used = existing.groupBy("customer_id", "kind").agg(F.max("idx").alias("used"))
        keys = keys.join(used, ["customer_id", "kind"], "left")
        begin = F.coalesce(F.col("used"), F.lit(0))
    numbered = keys.select("customer_id", "kind", "key", (begin + F.row_number().over(by_key)).alias("idx"))
    return numbered.withColumn("column", F.concat("kind", F.col("idx").cast("string")))


def reverse_mapping(mapping: DataFrame) -> DataFrame:
    """The same mapping, from column to key."""
    return mapping.select("customer_id", "kind", "column", "key")


def max_columns(mapping: DataFrame) -> DataFrame:
    """Columns of the widest tenant, per kind."""
    per_tenant = mapping.groupBy("customer_id", "kind").agg(F.max("idx").alias("n"))
    return per_tenant.groupBy("kind").agg(F.max("n").alias("max_columns"))


def key_mapping(keys: DataFrame, tenants: DataFrame) -> KeyMapping:
    """Materialise an assigned mapping and measure its width. tenants should be cheap to read again."""
    stored = materialise(keys)
    widths = {r["kind"]: r["max_columns"] for r in max_columns(stored).collect()}
    return KeyMapping(stored, tenants, widths.get("int", 0), widths.get("float", 0))


def mapping_from_entries(entries: DataFrame) -> KeyMapping:
    """Mapping of all keys that a materialised discovery found."""
    return key_mapping(assign_columns(keys_of(entries)), tenants_of(entries))


def extended_mapping(entries: DataFrame, existing: KeyMapping) -> tuple[KeyMapping, DataFrame]:
    """An existing mapping with the keys and tenants that it lacks, and the added rows alone."""
    added = materialise(assign_columns(keys_of(entries), existing.keys))
    tenants = materialise(existing.tenants.unionByName(tenants_of(entries)).distinct())
    return key_mapping(existing.keys.unionByName(added), tenants), added


def discover_mapping(fact: DataFrame) -> tuple[KeyMapping, DataFrame]:
    """Discover and number the numeric keys of a fact. Also gives the discovered entries."""
    entries = materialise(discover_entries(fact))
    return mapping_from_entries(entries), entries


def physical_column(wanted: DataFrame, mapping: DataFrame) -> DataFrame:
    """Column of each wanted (customer_id, metric_key); int before float, an error if there is none."""
    kind_rank = F.when(F.col("kind") == "int", 0).otherwise(1)
    numeric = mapping.where(F.col("kind").isin("int", "float"))
    best = numeric.groupBy("customer_id", F.col("key").alias("metric_key")).agg(
        F.min_by("column", kind_rank).alias("target_physical_column")
    )
    message = F.concat(
        F.lit("no column for metric "), F.col("metric_key"), F.lit(" of tenant "), F.col("customer_id").cast("string")
    )
    return wanted.join(best, ["customer_id", "metric_key"], "left").withColumn(
        "target_physical_column", F.coalesce("target_physical_column", F.raise_error(message))
    )


def slots(entries: DataFrame, mapping: DataFrame, conflict: str) -> DataFrame:
    """Where the value of each map entry goes: customer_id, kind, group_no, key, idx, slot.

    A key that sits in several map columns of a tenant has one slot per map column, the highest
    map column first, so that the highest one present can be chosen after summing ('last').
    With 'sum' all of them share one slot.
    """
    if conflict not in ("last", "sum"):
        raise ValueError(f"unknown conflict rule: {conflict}")
    placed = entries.where(F.col("key").isNotNull()).join(mapping, ["customer_id", "kind", "key"])
    highest_first = Window.partitionBy("customer_id", "kind", "idx").orderBy(F.desc("group_no"))
    rank = F.row_number().over(highest_first) - 1 if conflict == "last" else F.lit(0)
    return placed.select(
        "customer_id", "kind", "group_no", "key", "idx", (F.col("idx") * RANKS_PER_COLUMN + rank).alias("slot")
    )


# ---- tag keys ---------------------------------------------------------------------------------


def normalise_tags(tags: DataFrame) -> DataFrame:
    """Drop repeated keys of a tenant's list, keeping the first, and correct key_count.

    Takes customer_id, keys, key_count. Gives customer_id, keys, key_count, count_was_wrong.
    """
    keys = F.array_distinct(F.coalesce("keys", F.array().cast("array<string>")))
    count = F.size(keys)
    return tags.select(
        "customer_id",
        keys.alias("keys"),
        count.alias("key_count"),
        (F.coalesce("key_count", count) != count).alias("count_was_wrong"),
    )


def tag_mapping(normalised: DataFrame) -> DataFrame:
    """Number a tenant's tag keys in list order: customer_id, kind, key, idx, column."""
    return normalised.select("customer_id", F.posexplode("keys").alias("pos", "key")).select(
        "customer_id",
        F.lit("string").alias("kind"),
        "key",
        (F.col("pos") + 1).alias("idx"),
        F.concat(F.lit("string"), (F.col("pos") + 1).cast("string")).alias("column"),
    )


def string_columns_needed(normalised: DataFrame, declared_max: int = 0) -> DataFrame:
    """Number of string columns a table needs: the longest key list, or the declared number if larger."""
    longest = F.coalesce(F.max("key_count"), F.lit(0))
    return normalised.agg(F.greatest(longest, F.lit(declared_max)).alias("string_columns"))
