"""Load logs from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Lines as log_id, block, pos, value.

    A block is the piece of a file that one task reads; its offset orders the blocks of a file.
    Inside a block the row id grows with the line order.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("log_id"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )
