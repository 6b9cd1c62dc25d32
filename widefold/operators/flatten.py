"""From summed maps to positional columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from widefold.model import GROUP_KEYS, STANDARD_COLUMNS, group_columns
from widefold.operators.discovery import discover_entries, tenants_of
from widefold.operators.mapping import RANKS_PER_COLUMN, KeyMapping, slots
from widefold.operators.preagg import SNAPSHOT_COLUMNS, at_grain, map_entries, snapshot_struct, union_all
from widefold.plans.small_side import join_lookup, materialise


def flatten(
    fact: DataFrame,
    mapping: KeyMapping,
    entries: DataFrame | None = None,
    grain: str = "minute",
    conflict: str = "last",
) -> DataFrame:
    """Flat fact: one row per group, standard columns and int1..intN, float1..floatM.

    entries are the discovered entries of the same rows, found here when not given. Keys outside
    the mapping are left out; a tenant outside it is an error. A group without any mapped key
    keeps its row, with zeros.

    Plan: map entries meet the mapping by broadcast and are summed per (group, slot), with the
    sums begun inside each task, so a group that holds a large share of all rows is shuffled as a
    few rows. The sums and the raw rows' standard columns then meet in one grouping on the group
    keys, in which a NULL key is a key like any other; raw rows are reduced to the earliest inside
    each task. The summed entries of a group number at most the tenant's slots, so the list
    collected per group is bounded by the width of the table. The two sides and the two kinds read
    disjoint columns of the fact besides the keys.

    Runs small jobs when called: the mapping is checked against the tenants, and the slots are
    stored and counted.
    """
    return positional(summed_state(fact, mapping, entries, grain, conflict))


@dataclass(frozen=True)
class SummedState:
    """Groups of a grain before their keys get columns, which can be merged into groups of a coarser grain.

    rows: group keys, snapshot (the raw time and standard columns of the earliest row) and a map of sums by
    slot for each kind. placed: the slots, stored.
    """

    rows: DataFrame
    placed: DataFrame
    mapping: KeyMapping
    grain: str

    def widths(self) -> dict[str, int]:
        return {k: n for k, n in (("int", self.mapping.int_columns), ("float", self.mapping.float_columns)) if n}


GRAINS = ("millisecond", "minute", "hour", "day")


def summed_state(
    fact: DataFrame,
    mapping: KeyMapping,
    entries: DataFrame | None = None,
    grain: str = "minute",
    conflict: str = "last",
) -> SummedState:
    """The summed groups of raw rows; arguments as for flatten."""
    if entries is None:
        entries = materialise(discover_entries(fact))
    check_tenants(entries, mapping)
    placed = materialise(slots(entries, mapping.keys, conflict))
    widths = SummedState(fact, placed, mapping, grain).widths()
    parts = [at_grain(fact, grain, snapshot_struct().alias("snapshot"))]
    parts += [slot_sums(fact, placed, kind, grain) for kind in widths]
    return SummedState(_regrouped(parts, list(widths)), placed, mapping, grain)


def coarser_state(state: SummedState, grain: str) -> SummedState:
    """The groups of a coarser grain, from those of a finer one instead of the raw rows.

    A group's earliest raw row is the earliest of its parts' earliest rows, and sums by slot add up. Which map
    column of a key counts is only then chosen, as it may be another one in the whole group than in its parts.
    """
    if GRAINS.index(grain) < GRAINS.index(state.grain):
        raise ValueError(f"{grain} is finer than {state.grain}")
    kinds = list(state.widths())
    parts = [at_grain(state.rows, grain, "snapshot")]
    for kind in kinds:
        sums = at_grain(state.rows, grain, F.explode(f"{kind}_slots").alias("slot", "value"))
        parts.append(sums.groupBy(*GROUP_KEYS, "slot").agg(F.sum("value").alias(f"{kind}_sum")))
    return SummedState(_regrouped(parts, kinds), state.placed, state.mapping, grain)


def _regrouped(parts: list[DataFrame], kinds: list[str]) -> DataFrame:
    return union_all(parts).groupBy(*GROUP_KEYS).agg(F.min("snapshot").alias("snapshot"), *[_slot_map(k) for k in kinds])


def positional(state: SummedState) -> DataFrame:
    """The flat fact of summed groups."""
    widths = state.widths()
    flat = state.rows.select(
        *GROUP_KEYS, *[F.col(f"snapshot.{c}").alias(c) for c in SNAPSHOT_COLUMNS], *[f"{k}_slots" for k in widths]
    )
    ranks = state.placed.groupBy("kind", "idx").agg(F.max(F.col("slot") % RANKS_PER_COLUMN).alias("last_rank"))
    last_rank = {(r["kind"], r["idx"]): r["last_rank"] for r in ranks.where("last_rank > 0").collect()}
    columns = [
        _slot_value(kind, idx, last_rank.get((kind, idx), 0)) for kind, n in widths.items() for idx in range(1, n + 1)
    ]
    return flat.selectExpr(*STANDARD_COLUMNS, *columns)


def check_tenants(entries: DataFrame, mapping: KeyMapping) -> None:
    """Fail when the data holds a tenant that the mapping does not."""
    missing = tenants_of(entries).join(mapping.tenants, "customer_id", "left_anti").take(1)
    if missing:
        raise ValueError(f"no mapping for tenant {missing[0]['customer_id']}")


def slot_sums(fact: DataFrame, placed: DataFrame, kind: str, grain: str) -> DataFrame:
    """Sum per (group, slot) of the mapped entries of a kind: group keys, slot, <kind>_sum."""
    lookup = placed.where(F.col("kind") == kind).select(
        F.col("customer_id").alias("customerId"), "group_no", "key", "slot"
    )
    joined = join_lookup(map_entries(fact, kind, grain), lookup, ["customerId", "group_no", "key"])
    return joined.groupBy(*GROUP_KEYS, "slot").agg(F.sum("value").alias(f"{kind}_sum"))


def _slot_map(kind: str) -> Column:
    entry = F.struct("slot", f"{kind}_sum")
    present = F.col(f"{kind}_sum").isNotNull()
    return F.map_from_entries(F.collect_list(F.when(present, entry))).alias(f"{kind}_slots")


def _slot_value(kind: str, idx: int, last_rank: int) -> str:
    """SQL text of a positional column: its highest map column present, else 0."""
    first = idx * RANKS_PER_COLUMN
    held = ", ".join(f"{kind}_slots[{slot}]" for slot in range(first, first + last_rank + 1))
    stored = {"int": "BIGINT", "float": "FLOAT"}[kind]
    return f"CAST(coalesce({held}, 0) AS {stored}) AS {kind}{idx}"


def unmapped_keys(fact: DataFrame, mapping: KeyMapping) -> DataFrame:
    """Keys of the data that the mapping leaves out, with their entries: customer_id, kind, key, entries."""
    counted = []
    for kind in ("int", "float"):
        keys = F.flatten(F.array(*[_keys_or_none(g) for g in group_columns(kind)]))
        counted.append(
            fact.select(F.col("customerId").alias("customer_id"), F.explode(keys).alias("key"))
            .groupBy("customer_id", "key")
            .agg(F.count("*").alias("entries"))
            .withColumn("kind", F.lit(kind))
        )
    found = union_all(counted)
    return found.join(mapping.keys, ["customer_id", "kind", "key"], "left_anti").select(
        "customer_id", "kind", "key", "entries"
    )


def _keys_or_none(group: str) -> Column:
    return F.coalesce(F.map_keys(group), F.array().cast("array<string>"))
