"""Bounds of what a task takes in, for jobs on raw rows and their groups that the package runs itself."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from widefold.plans.small_side import materialise

#: Stored files that a task reads, of ROWS_PER_FILE rows each (sources.wide).
FILES_PER_TASK = 4
#: Shuffled bytes that adaptive execution joins into a task. A group takes 240 bytes there, and in memory 1.3 KB by reckoning.
SHUFFLED_BYTES = 8 * 1024 * 1024

SHUFFLED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
OPEN_COST = "spark.sql.files.openCostInBytes"
SPLIT = "spark.sql.files.maxPartitionBytes"


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """In the block, tasks of a job take in less than by Spark's own settings; stricter ones of the session stay.

    Spark sizes tasks by bytes in files and shuffles. Rows of many empty columns take ten times that in memory and
    more. It looks at the settings when a job runs, so a job belongs into the block as a whole.
    """
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    now = {name: in_bytes(spark.conf.get(name)) for name in (SHUFFLED, OPEN_COST, SPLIT)}
    bounds = {
        SHUFFLED: min(now[SHUFFLED], SHUFFLED_BYTES),
        OPEN_COST: max(now[OPEN_COST], now[SPLIT] // FILES_PER_TASK),
    }
    before = {name: spark.conf.get(name, None) for name in bounds}
    for name, value in bounds.items():
        spark.conf.set(name, f"{value}b")
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def materialise_in_small_tasks(df: DataFrame) -> DataFrame:
    """materialise, by a job of small tasks."""
    with small_tasks(df.sparkSession):
        return materialise(df)
