"""Joins of a fact to a lookup table whose size is measured first, and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """This application's own folder for intermediate tables, in a place every executor can read.

    It lies in spark.checkpoint.dir; where the session sets none, in its warehouse. A warehouse on
    a local disk will do for a local master only: elsewhere each executor would write to its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir")
        on_disk = "://" not in root or root.startswith("file:")
        if on_disk and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/widefold-{spark.sparkContext.applicationId}"


def clear_intermediates(spark: SparkSession) -> None:
    """Delete all that this application has written there. Results not yet stored become unreadable."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """For the time of the block, results may be read; afterwards what they were made from is deleted."""
    try:
        yield
    finally:
        clear_intermediates(spark)


def materialise(df: DataFrame) -> DataFrame:
    """Write a result as a table in the shared folder and read it back.

    Later plans read the table instead of repeating the work, and a lost executor loses nothing.
    Unlike checkpoint(), a table does not carry the filters that made it into later plans, where
    they would be tested again on every row of the other side of a join. The table stays until
    clear_intermediates, or the end of an intermediates block.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Size of a lookup table: octets of its strings plus a fixed cost per value."""
    width = F.lit(16)
    for field in df.schema.fields:
        width = width + 8
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            width = width + F.coalesce(F.size(column), F.lit(0)) * 8
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def join_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Join a fact to a lookup table that a caller has materialised. Measures it when called.

    Up to limit_bytes the lookup table is broadcast and the fact is not shuffled. A larger one is
    joined by shuffle. There adaptive execution measures the partitions of the fact and cuts one
    that a hot key has made large into pieces of the advisory size, as many as it takes; each meets
    the same part of the lookup table.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if measured_bytes(lookup) <= limit_bytes:
        return fact.join(F.broadcast(lookup), on, how)
    return fact.join(lookup.hint("merge"), on, how)
