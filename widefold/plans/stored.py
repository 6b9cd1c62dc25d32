"""The wide fact of a data folder and its flat table, written once per session."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from widefold.operators.mapping import KeyMapping
from widefold.plans.day_load import load_days
from widefold.plans.small_side import shared_folder
from widefold.sources.wide import read_wide, write_wide


@dataclass(frozen=True)
class Stored:
    wide: DataFrame
    flat: DataFrame
    mapping: KeyMapping
    entries: DataFrame


_stored: dict[tuple[str, str, str, str], Stored] = {}


def stamp(spark: SparkSession, folder: str) -> str:
    """Changes when a table of a data folder does: names, sizes and times of what lies in it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    entries = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    seen = sorted(f"{e.getPath().getName()} {e.getLen()} {e.getModificationTime()}" for e in entries)
    return hashlib.sha256("\n".join(seen).encode()).hexdigest()


def stored(spark: SparkSession, sf_dir: str, build: Callable[[SparkSession, str], DataFrame]) -> Stored:
    """Write the wide fact that build derives and load it into a flat table; later calls of the application reuse
    both, until the data folder changes."""
    session = spark.sparkContext.applicationId
    key = (session, sf_dir, stamp(spark, sf_dir), build.__name__)
    if key not in _stored:
        name = hashlib.sha256("|".join(key).encode()).hexdigest()[:16]
        folder = f"{shared_folder(spark)}/tables-{session}/{name}"
        write_wide(build(spark, sf_dir), f"{folder}/wide")
        wide = read_wide(spark, f"{folder}/wide", by_date=True)
        load = load_days(wide, f"{folder}/flat", mode="replace")
        _stored[key] = Stored(wide, load.flat, load.mapping, load.entries)
    return _stored[key]
