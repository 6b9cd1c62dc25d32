"""Timing samples from CSV, and result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def timing_schema(kind_column: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("customer_id", T.IntegerType()),
            T.StructField("customer_name", T.StringType()),
            T.StructField("metric_key", T.StringType()),
            T.StructField(kind_column, T.StringType()),
            T.StructField("run_number", T.IntegerType()),
            T.StructField("execution_time_seconds", T.DoubleType()),
            T.StructField("row_count", T.LongType()),
            T.StructField("query_date", T.StringType()),
        ]
    )


def read_timings(spark: SparkSession, path: str, kind_column: str = "schema_type") -> DataFrame:
    """Samples from CSV with a header; kind_column is 'schema_type' or 'access_type'. Bad values fail."""
    reader = spark.read.schema(timing_schema(kind_column)).option("header", True).option("mode", "FAILFAST")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
