"""The record of loads of a flat table, which tells what of its folders is live.

A table that is filled by loads lies in folders by day, version and tenant. A load writes a version of the days
it touches and then adds a line to the record, beside the table in <path>-loads: its range, tenants and
days, and the versions of every day that are live from then on. Readers take the last line first, and Spark
prunes the folders of all other versions. A load that is stopped before its line is written leaves the
table as it was; what it had written is dead and can be dropped.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

VERSION_COLUMN = "version"
LINE = """
    load_id string, mode string, grain string, start timestamp_ntz, end timestamp_ntz, tenants array<int>,
    days array<date>, live array<struct<day: date, versions: array<string>>>
"""


@dataclass(frozen=True)
class Record:
    """The last line of a table's record: its number, and the live versions of each day."""

    number: int = 0
    live: dict[date, list[str]] = field(default_factory=dict)


def record_folder(path: str) -> str:
    return f"{path.rstrip('/')}-loads"


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def has_record(spark: SparkSession, path: str) -> bool:
    place, files = _folder(spark, f"{record_folder(path)}/number=*/part-*")
    return bool(files.globStatus(place))


def load_history(spark: SparkSession, path: str) -> DataFrame:
    """All lines of the record: number, load_id, mode, grain, start, end, tenants, days, live."""
    return spark.read.schema(f"{LINE}, number int").json(record_folder(path))


def read_record(spark: SparkSession, path: str) -> Record:
    """The last line, or an empty record. It has one entry per day of the table."""
    if not has_record(spark, path):
        return Record()
    last = load_history(spark, path).orderBy(F.desc("number")).select("number", "live").first()
    return Record(last["number"], {r["day"]: list(r["versions"]) for r in last["live"]})


def add_to_record(
    spark: SparkSession,
    path: str,
    known: Record,
    live: dict[date, list[str]],
    load_id: str,
    mode: str,
    grain: str,
    start: datetime | None,
    end: datetime | None,
    tenants: list[int] | None,
    days: list[date],
) -> Record:
    """Add a line after the one that the load began with; fails where another load has done so since."""
    rows = [(load_id, mode, grain, start, end, tenants, days, [(d, live[d]) for d in sorted(live)])]
    line = spark.createDataFrame(rows, LINE).coalesce(1)
    line.write.mode("errorifexists").json(f"{record_folder(path)}/number={known.number + 1}")
    return Record(known.number + 1, live)


def new_version(known: Record) -> str:
    return f"{known.number + 1:06d}-{uuid.uuid4().hex[:8]}"


def days_of_version(spark: SparkSession, path: str, version: str) -> list[date]:
    """The days that a load has written, by their folders."""
    place, files = _folder(spark, f"{path}/eventDate=*/{VERSION_COLUMN}={version}")
    found = files.globStatus(place) or []
    return sorted(date.fromisoformat(f.getPath().getParent().getName().split("=")[1]) for f in found)


def is_live(live: dict[date, list[str]]) -> Column:
    """Condition on eventDate and version, both folders, so that dead versions are not listed for reading."""
    if not live:
        return F.lit(False)
    versions = F.create_map(*[
        x for d in sorted(live) for x in (F.lit(d), F.array(*[F.lit(v) for v in live[d]]))
    ])
    return F.coalesce(F.array_contains(versions[F.col("eventDate")], F.col(VERSION_COLUMN)), F.lit(False))


def drop_dead_versions(spark: SparkSession, path: str) -> int:
    """Delete the versions that the last line no longer names; gives their number.

    Not while a load runs or an earlier state is still being read.
    """
    live = read_record(spark, path).live
    place, files = _folder(spark, f"{path}/eventDate=*/{VERSION_COLUMN}=*")
    dropped = 0
    for status in files.globStatus(place) or []:
        folder = status.getPath()
        day = date.fromisoformat(folder.getParent().getName().split("=")[1])
        if folder.getName().split("=")[1] not in live.get(day, []):
            files.delete(folder, True)
            dropped += 1
    return dropped
