"""Which tenants and which map keys occur in the raw fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from widefold.functions.maps import is_not_blank
from widefold.functions.times import chunk_of, chunk_starts, days_between
from widefold.model import GROUPS_PER_KIND, group_columns


def tenants_by_day(fact: DataFrame) -> DataFrame:
    """Distinct tenants of each day."""
    return (
        fact.select(F.to_date("timestampMs").alias("event_date"), F.col("customerId").alias("customer_id"))
        .distinct()
        .orderBy("event_date", "customer_id")
    )


def discover_entries(fact: DataFrame, kinds: tuple[str, ...] = ("int", "float")) -> DataFrame:
    """Distinct (customer_id, kind, group_no, key) of the maps, and one row with a NULL key per tenant.

    One scan reads all maps. The keys are counted down to their distinct values within each task
    before the shuffle, so the shuffle carries keys, not rows. The row with the NULL key keeps a
    tenant that has no keys at all.
    """
    columns = [g for kind in kinds for g in group_columns(kind)]
    kind_of, number_of = _position_labels(kinds)
    tenant_marker = F.array(F.lit(None).cast("string"))
    arrays = F.array(*[F.map_keys(c) for c in columns], tenant_marker)
    return (
        fact.select(F.col("customerId").alias("customer_id"), F.posexplode(arrays).alias("pos", "keys"))
        .select("customer_id", "pos", F.explode("keys").alias("key"))
        .distinct()
        .where(F.col("key").isNull() | is_not_blank(F.col("key")))
        .select("customer_id", kind_of.alias("kind"), number_of.alias("group_no"), "key")
    )


def _position_labels(kinds: tuple[str, ...]) -> tuple[Column, Column]:
    position = F.col("pos")
    kind = F.lit(None).cast("string")
    for i in reversed(range(len(kinds))):
        upper = (i + 1) * GROUPS_PER_KIND
        kind = F.when(position < upper, F.lit(kinds[i])).otherwise(kind)
    number = F.when(position < len(kinds) * GROUPS_PER_KIND, position % GROUPS_PER_KIND + 1)
    return kind, number


def keys_of(entries: DataFrame) -> DataFrame:
    """Distinct (customer_id, kind, key) of discovered entries."""
    return entries.where(F.col("key").isNotNull()).select("customer_id", "kind", "key").distinct()


def tenants_of(entries: DataFrame) -> DataFrame:
    """Distinct tenants of discovered entries."""
    return entries.where(F.col("key").isNull()).select("customer_id").distinct()


def discover_keys(fact: DataFrame, kinds: tuple[str, ...] = ("int", "float")) -> DataFrame:
    """Distinct (customer_id, kind, key) over all rows given, whatever number of days they span."""
    return keys_of(discover_entries(fact, kinds))


def key_lists(entries: DataFrame) -> DataFrame:
    """Sorted key list of each map column, per tenant."""
    return (
        entries.where(F.col("key").isNotNull())
        .groupBy("customer_id", "kind", "group_no")
        .agg(F.array_sort(F.collect_list("key")).alias("keys"))
    )


def day_list(fact: DataFrame) -> DataFrame:
    """All days from the first to the last one of each tenant, with or without rows."""
    return _days_spanned(fact.select(F.col("customerId").alias("customer_id"), F.to_date("timestampMs").alias("day")))


def _days_spanned(days: DataFrame) -> DataFrame:
    spans = days.groupBy("customer_id").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    return spans.select(
        "customer_id", F.explode(days_between(F.col("first"), F.col("last"))).alias("event_date")
    )


def chunk_grid(fact: DataFrame, minutes: int) -> DataFrame:
    """Raw rows of every chunk of every day of a tenant, 0 for a chunk without rows.

    The days come from the counted chunks, not from the fact, so the fact is read once.
    """
    counted = fact.groupBy(
        F.col("customerId").alias("customer_id"),
        chunk_of(F.col("timestampMs"), minutes).alias("chunk_start"),
    ).agg(F.count("*").alias("raw_rows"))
    days = _days_spanned(counted.select("customer_id", F.to_date("chunk_start").alias("day")))
    grid = days.select("customer_id", F.explode(chunk_starts(F.col("event_date"), minutes)).alias("chunk_start"))
    return grid.join(counted, ["customer_id", "chunk_start"], "left").na.fill(0, ["raw_rows"])
