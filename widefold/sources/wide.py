"""Scans of the raw wide-map fact."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from widefold.functions.times import in_range
from widefold.model import EXCLUDED_COLUMNS, wide_schema


#: Days that a task of write_wide keeps a file open for. Rows of further days are sorted first.
OPEN_DAYS = 100
#: Rows of a stored file. A scan packs at most spark.sql.files.maxPartitionBytes / openCostInBytes files (32)
#: into a task, so this bounds a task's rows however well they compress.
ROWS_PER_FILE = 25_000


def write_wide(fact: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a raw fact as Parquet, one folder per day, so that a scan of a range opens its days only.

    A row of 45 maps takes some kilobytes in memory, though a few dozen bytes in a file. So a task does not
    sort its rows by day but writes the days side by side, and files hold a bounded number of rows.
    """
    rows = fact.withColumn("eventDate", F.to_date("timestampMs"))
    with open_files(fact.sparkSession, OPEN_DAYS):
        rows.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("eventDate").parquet(path)


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """In the block, a task that writes into folders keeps up to most files open instead of sorting its rows."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_wide(spark: SparkSession, path: str, by_date: bool = False) -> DataFrame:
    """Raw fact from Parquet, with the fixed schema; by_date where it is stored in folders by eventDate."""
    schema = wide_schema()
    if by_date:
        schema = T.StructType([*schema.fields, T.StructField("eventDate", T.DateType())])
    return spark.read.schema(schema).parquet(path)


def scan(
    fact: DataFrame,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    tenant: int | None = None,
    flow: str | None = None,
) -> DataFrame:
    """Rows of a time range, tenant and flow. Each given condition reaches the Parquet scan.

    A table partitioned by eventDate also gets the matching partition condition, since Spark does
    not derive it from the condition on timestampMs.
    """
    if (start is None) != (end is None):
        raise ValueError("give both ends of the range or none")
    out = fact
    if start is not None:
        out = out.where(in_range("timestampMs", start, end))
        if "eventDate" in fact.columns:
            last_instant = _moment(end) - timedelta(microseconds=1)
            out = out.where(F.col("eventDate").between(_day(_moment(start)), _day(last_instant)))
    if tenant is not None:
        out = out.where(F.col("customerId") == tenant)
    if flow is not None:
        out = out.where(F.col("flowId") == flow)
    return out


def _moment(value: str | datetime) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def _day(value: date) -> Column:
    return F.lit(value.strftime("%Y-%m-%d")).cast("date")


def without_excluded(fact: DataFrame) -> DataFrame:
    """The fact without the columns that a flat table does not carry."""
    return fact.drop(*EXCLUDED_COLUMNS)


def count_where(df: DataFrame, condition: Column | str | None = None) -> DataFrame:
    """Number of rows that meet a condition."""
    rows = df if condition is None else df.where(condition)
    return rows.agg(F.count("*").alias("rows"))
