"""Expressions over the map columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def map_value(group: str, key: str) -> Column:
    """Value of a key, 0 when the map does not hold it."""
    return F.coalesce(F.col(group)[key], F.lit(0))


def has_key(group: str, key: str) -> Column:
    """Whether a map holds a key; a NULL map holds none."""
    return F.coalesce(F.map_contains_key(group, key), F.lit(False))


def any_group_has(groups: list[str], key: str) -> Column:
    """Whether any of the maps holds a key."""
    return reduce(lambda a, b: a | b, (has_key(g, key) for g in groups))


def first_group_with(groups: list[str], key: str) -> Column:
    """Name of the first map that holds a key, NULL when none does."""
    return F.coalesce(*[F.when(has_key(g, key), F.lit(g)) for g in groups])


def key_arrays(groups: list[str]) -> Column:
    """The keys of each map, as an array of arrays; a NULL map has no keys."""
    none = F.array().cast("array<string>")
    return F.array(*[F.coalesce(F.map_keys(g), none) for g in groups])


def is_not_blank(key: Column) -> Column:
    """Whether a key holds anything other than white space."""
    return key.rlike(r"(?U)[^\s\x1c-\x1f]")
