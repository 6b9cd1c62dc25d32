"""Loading of raw rows into a flat table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from widefold.functions.times import in_range
from widefold.model import flat_schema
from widefold.operators.discovery import discover_entries, tenants_of
from widefold.operators.flatten import flatten
from widefold.operators.mapping import KeyMapping, discover_mapping, extended_mapping
from widefold.plans.small_side import join_lookup, materialise
from widefold.plans.task_size import small_tasks
from widefold.sources.flat import read_flat, write_version
from widefold.sources.loads import Record, add_to_record, days_of_version, new_version, read_record
from widefold.sources.mappings import add_to_mapping, has_mapping, read_mapping, write_mapping
from widefold.sources.wide import scan

MODES = ("partitions", "replace", "append")
GRAIN_SECONDS = {"millisecond": 0.001, "minute": 60, "hour": 3600, "day": 86400}


@dataclass(frozen=True)
class Load:
    mapping: KeyMapping
    entries: DataFrame
    flat: DataFrame


def load_days(
    fact: DataFrame,
    path: str,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    grain: str = "minute",
    mode: str = "partitions",
    sort_key: str = "client",
    conflict: str = "last",
    mapping: KeyMapping | None = None,
    tenants: list[int] | None = None,
) -> Load:
    """Discover keys, number them, flatten and publish the rows of a range, all tenants or those given.

    mode 'partitions' makes the table hold, for the range, what the fact holds: rows of the range that are there
    already go, those of a tenant that is no longer in the fact too, and all others stay. The range may
    be part of a day but not of a grain. Without a range the days and tenants that the fact holds are
    replaced as wholes. 'append' adds to what is there, and 'replace' begins the table anew.

    The rows are written as a new version of the days they touch; rows of these days that stay are read
    from the live version and written along. The load becomes visible as a whole with its line in the
    table's record (sources.loads), so one that is stopped changes nothing, and one that is run again, or
    in another order, gives the same table. Loads of one table must follow each other.

    The mapping is kept beside the table, in the folder <path>-mapping. A later load takes it from
    there, or the one that is given: known keys keep their columns, new ones follow behind, and
    the new numbers are stored before the data. Mode 'replace' begins anew.

    The raw fact is scanned four times, three where it has no float key: for its keys, for its
    standard columns, and for its maps of either kind. The scans read different columns, but for
    the group keys. Without a range its days and tenants are scanned too. Its rows are counted for the write.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    spark = fact.sparkSession
    span = _checked_range(start, end, grain)
    rows = scan(fact, start, end)
    if tenants is not None:
        rows = rows.where(F.col("customerId").isin(tenants))
    mapping, entries = _numbered(rows, path, mode, mapping)
    schema = flat_schema(mapping.int_columns, mapping.float_columns)
    flat = flatten(rows, mapping, entries, grain, conflict)

    known = read_record(spark, path)
    kept = None
    if mode == "partitions" and known.live:
        kept = _kept(rows, read_flat(spark, path, schema, known), span, tenants, known)
    version = new_version(known)
    # Groups are no more than raw rows, which a count tells from the range and tenants alone.
    at_most = rows.count() + (0 if kept is None else kept.count())
    with small_tasks(spark):
        write_version(flat if kept is None else flat.unionByName(kept.drop("eventDate")), path, version, sort_key, at_most)
    written = days_of_version(spark, path, version)
    record = add_to_record(
        spark, path, known, _live(known, version, written, span, mode, tenants), version, mode, grain, *(span or (None, None)),
        tenants, written,
    )
    return Load(mapping, entries, read_flat(spark, path, schema, record))


def _checked_range(
    start: str | datetime | None, end: str | datetime | None, grain: str
) -> tuple[datetime, datetime] | None:
    """The range as moments. A range that cuts a grain would give two rows of one group, so it is refused."""
    if start is None and end is None:
        return None
    if start is None or end is None:
        raise ValueError("give both ends of the range or none")
    span = tuple(v if isinstance(v, datetime) else datetime.fromisoformat(v) for v in (start, end))
    for moment in span:
        since_midnight = timedelta(hours=moment.hour, minutes=moment.minute, seconds=moment.second, microseconds=moment.microsecond)
        if since_midnight % timedelta(seconds=GRAIN_SECONDS[grain]):
            raise ValueError(f"the range cuts a {grain}: {moment}")
    if span[0] >= span[1]:
        raise ValueError("the range is empty")
    return span


def _numbered(
    rows: DataFrame, path: str, mode: str, mapping: KeyMapping | None
) -> tuple[KeyMapping, DataFrame]:
    """The mapping that covers the rows, stored beside the table, and the entries found in them."""
    spark, beside = rows.sparkSession, f"{path.rstrip('/')}-mapping"
    if mapping is None and mode != "replace" and has_mapping(spark, beside):
        mapping = read_mapping(spark, beside)
    if mapping is None:
        mapping, entries = discover_mapping(rows)
        write_mapping(mapping, beside)
        return mapping, entries
    entries = materialise(discover_entries(rows))
    mapping, added = extended_mapping(entries, mapping)
    if mode != "replace" and has_mapping(spark, beside):
        add_to_mapping(added, tenants_of(entries), beside)
    else:
        write_mapping(mapping, beside)
    return mapping, entries


def _days(span: tuple[datetime, datetime]) -> tuple[date, date]:
    """The first and last day that a range touches."""
    return span[0].date(), (span[1] - timedelta(microseconds=1)).date()


def _is_whole(day: date, span: tuple[datetime, datetime]) -> bool:
    begin = datetime.combine(day, datetime.min.time())
    return span[0] <= begin and begin + timedelta(days=1) <= span[1]


def _kept(
    rows: DataFrame,
    old: DataFrame,
    span: tuple[datetime, datetime] | None,
    tenants: list[int] | None,
    known: Record,
) -> DataFrame | None:
    """Rows of the touched days that stay, None where none can. Only days that are touched in part are read."""
    if span is not None:
        first, last = _days(span)
        partly = [d for d in known.live if first <= d <= last and (tenants is not None or not _is_whole(d, span))]
        if not partly:
            return None
        replaced: Column = in_range("timestampMs", *span)
        if tenants is not None:
            replaced = replaced & F.coalesce(F.col("customerId").isin(tenants), F.lit(False))
        return old.where(F.col("eventDate").isin(partly)).where(~replaced)
    loaded = materialise(rows.select(F.to_date("timestampMs").alias("eventDate"), "customerId").distinct())
    days = [r["eventDate"] for r in loaded.select("eventDate").distinct().collect()]
    if not any(d in known.live for d in days):
        return None
    there = loaded.withColumn("loaded", F.lit(True))
    touched = join_lookup(old.where(F.col("eventDate").isin(days)), there, ["eventDate", "customerId"], "left")
    return touched.where("loaded IS NULL").select(old.columns)


def _live(
    known: Record,
    version: str,
    written: list[date],
    span: tuple[datetime, datetime] | None,
    mode: str,
    tenants: list[int] | None,
) -> dict[date, list[str]]:
    """The live versions of each day after a load."""
    if mode == "replace":
        return {d: [version] for d in written}
    if mode == "append":
        return known.live | {d: [*known.live.get(d, []), version] for d in written}
    live = dict(known.live)
    if span is not None:
        # What stays of these days was written along.
        first, last = _days(span)
        live = {d: v for d, v in live.items() if not first <= d <= last}
    return live | {d: [version] for d in written}
