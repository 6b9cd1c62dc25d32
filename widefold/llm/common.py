"""Helpers of the text operators."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows to a salt of a hot group, and of a bucket that is handled by one task.
ROWS_PER_SALT = 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder. Python workers are told where this package lies on the driver; a cluster
    that does not have it there gets it by --py-files."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key() -> Column:
    """Tells rows of one doc_id apart by their text. Rows equal in both are one row to an operator."""
    return F.xxhash64("doc_id", whole_text())


def as_struct(docs: DataFrame) -> Column:
    """A whole row as one column, `whole`, so that no column of it can clash with those of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality on columns where null equals null; still a hash or merge join."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, worked out once. Spark may put the expression of a column in place of its name, and
    inside a lambda it would then be worked out for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
