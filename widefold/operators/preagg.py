"""Pre-aggregation of raw rows to one row per (time, client, session, tenant)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from widefold.functions.times import check_chunk_minutes, chunk_of, start_of
from widefold.model import GROUP_KEYS, STANDARD_COLUMNS, group_columns

SNAPSHOT_COLUMNS = [c for c in STANDARD_COLUMNS if c not in GROUP_KEYS]


def at_grain(fact: DataFrame, grain: str, *columns: Column | str) -> DataFrame:
    """The group keys, timestampMs cut to the grain, and the given columns."""
    cut = start_of(grain, "timestampMs").alias("timestampMs")
    return fact.select(cut, *[k for k in GROUP_KEYS if k != "timestampMs"], *columns)


def snapshot_struct() -> Column:
    """The raw time, then the other standard columns. The least of a group is its earliest row.

    Rows of the same time are told apart by their other values, so the choice does not depend on
    the order in which rows arrive.
    """
    return F.struct(F.col("timestampMs").alias("at"), *SNAPSHOT_COLUMNS)


def representative(fact: DataFrame, grain: str = "minute") -> DataFrame:
    """Group keys and the standard columns of the earliest raw row of each group."""
    rows = at_grain(fact, grain, snapshot_struct().alias("snapshot"))
    picked = rows.groupBy(*GROUP_KEYS).agg(F.min("snapshot").alias("snapshot"))
    return picked.select(*GROUP_KEYS, *[F.col(f"snapshot.{c}").alias(c) for c in SNAPSHOT_COLUMNS])


def map_entries(fact: DataFrame, kind: str, grain: str = "minute") -> DataFrame:
    """One row per map entry: group keys, group_no, key, value.

    The time is cut before the maps are exploded, once per raw row.
    """
    groups = group_columns(kind)
    value_type = "bigint" if kind == "int" else "double"
    return (
        at_grain(fact, grain, *groups)
        .select(*GROUP_KEYS, F.posexplode(F.array(*groups)).alias("pos", "map"))
        .select(*GROUP_KEYS, (F.col("pos") + 1).alias("group_no"), F.explode("map").alias("key", "value"))
        .withColumn("value", F.col("value").cast(value_type))
    )


def sum_map_long(fact: DataFrame, kind: str, grain: str = "minute") -> DataFrame:
    """Sum of each key of each map column within a group, one row per key.

    A task sums its own rows before the shuffle, so a group that holds a large share of all rows
    reaches the shuffle as one row per key and task.
    """
    return map_entries(fact, kind, grain).groupBy(*GROUP_KEYS, "group_no", "key").agg(F.sum("value").alias("value"))


def sum_maps(fact: DataFrame, kinds: tuple[str, ...] = ("int", "float"), grain: str = "minute") -> DataFrame:
    """The same sums as maps, one column per map column, empty where a group has no entry."""
    grouped = summed_entries(fact, kinds, grain).groupBy(*GROUP_KEYS).agg(*entry_lists(kinds))
    return grouped.select(*GROUP_KEYS, *map_columns(kinds))


def summed_entries(fact: DataFrame, kinds: tuple[str, ...], grain: str) -> DataFrame:
    return union_all([sum_map_long(fact, k, grain).withColumnRenamed("value", f"{k}_value") for k in kinds])


def entry_lists(kinds: tuple[str, ...]) -> list[Column]:
    """Aggregates that gather the summed entries of a group, one list per kind.

    The sums of a group number at most its distinct keys, so the lists collected here do not grow
    with its rows. A list per map column would be shuffled with each row, empty or not.
    """
    return [
        F.expr(
            f"collect_list(struct(group_no, key, {kind}_value)) FILTER (WHERE {kind}_value IS NOT NULL) AS {kind}_entries"
        )
        for kind in kinds
    ]


def map_columns(kinds: tuple[str, ...]) -> list[Column]:
    """The map columns of a group from its lists."""
    return [
        F.expr(
            f"map_from_entries(transform(filter({kind}_entries, e -> e.group_no = {n}),"
            f" e -> struct(e.key AS key, e.{kind}_value AS value))) AS {name}"
        )
        for kind in kinds
        for n, name in enumerate(group_columns(kind), 1)
    ]


def preaggregate(fact: DataFrame, grain: str = "minute", kinds: tuple[str, ...] = ("int", "float")) -> DataFrame:
    """Standard columns and summed maps of each group. A group without entries has empty maps.

    Raw rows and sums meet in one grouping, in which a NULL key is a key like any other.
    """
    rows = at_grain(fact, grain, snapshot_struct().alias("snapshot"))
    grouped = union_all([rows, summed_entries(fact, kinds, grain)]).groupBy(*GROUP_KEYS).agg(
        F.min("snapshot").alias("snapshot"), *entry_lists(kinds)
    )
    joined = grouped.select(
        *GROUP_KEYS, *[F.col(f"snapshot.{c}").alias(c) for c in SNAPSHOT_COLUMNS], *map_columns(kinds)
    )
    value_types = {"int": "BIGINT", "float": "DOUBLE"}
    maps = [
        f"coalesce({g}, CAST(map() AS MAP<STRING, {value_types[kind]}>)) AS {g}" for kind in kinds for g in group_columns(kind)
    ]
    return joined.selectExpr(*STANDARD_COLUMNS, *maps)


def compression_by_chunk(fact: DataFrame, minutes: int = 1, grain: str = "minute") -> DataFrame:
    """Raw rows and groups of each chunk: customer_id, chunk_start, raw_rows, agg_rows.

    Groups are counted by a second grouping over the first, not by a distinct count.
    """
    check_chunk_minutes(minutes)
    groups = at_grain(fact, grain).groupBy(*GROUP_KEYS).agg(F.count("*").alias("n"))
    return groups.groupBy(
        F.col("customerId").alias("customer_id"), chunk_of(F.col("timestampMs"), minutes).alias("chunk_start")
    ).agg(F.sum("n").alias("raw_rows"), F.count("*").alias("agg_rows"))


def compression_stats(fact: DataFrame, minutes: int = 1, grain: str = "minute") -> DataFrame:
    """Per tenant: raw rows, groups, rows per group, and chunks that hold rows."""
    return (
        compression_by_chunk(fact, minutes, grain)
        .groupBy("customer_id")
        .agg(
            F.sum("raw_rows").alias("raw_rows"),
            F.sum("agg_rows").alias("agg_rows"),
            F.count("*").alias("chunks_with_rows"),
        )
        .withColumn("compression_factor", F.col("raw_rows") / F.col("agg_rows"))
    )


def run_totals(stats: DataFrame) -> DataFrame:
    """Totals over the tenants of compression_stats."""
    names = ["raw_rows", "agg_rows", "chunks_with_rows"]
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
    return stats.agg(F.count("*").alias("tenants"), *sums)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
