"""Flat fact tables: creation, writes and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from widefold.functions.times import start_of
from widefold.model import DEFAULTED_COLUMNS, column_class
from widefold.sources.loads import VERSION_COLUMN, Record, has_record, is_live, read_record

PARTITION_COLUMNS = ["eventDate", "customerId"]

# Order of the rows inside a file, after tenant and day.
SORT_KEYS = {
    "client": ["clientId", "sessionId", "timestampMs"],
    "hour": ["hour", "clientId", "sessionId", "timestampMs"],
}

# Columns whose ranges, after day and tenant, tell the files of a tenant apart.
RANGE_KEYS = {"client": ["clientId"], "hour": ["hour", "clientId"]}


#: Rows of a range that a task of a write sorts, as long as that takes no more ranges than the most: up to 200 a
#: shuffle writes without holding rows in memory (spark.shuffle.sort.bypassMergeThreshold).
ROWS_PER_RANGE = 100_000
MOST_RANGES = 200


def write_flat(
    flat: DataFrame, path: str, mode: str = "partitions", sort_key: str = "client", at_most: int | None = None
) -> None:
    """Write a flat fact as Parquet, one folder per day and tenant, rows sorted inside each file.

    mode: 'partitions' replaces the days and tenants that the data holds, so a repeated load gives
    the same table; 'replace' replaces the whole table; 'append' adds to it.

    Rows are dealt out by ranges of day, tenant and the first columns of the sort key. A large
    tenant is cut into several files whose ranges follow each other, so that the least and greatest
    values of a file tell whether a query needs it. There are spark.sql.shuffle.partitions ranges;
    adaptive execution joins small ones. It does so by their bytes in the shuffle, of which a row takes a tenth of
    what it takes in memory; where at_most, an upper bound of the rows, asks for more ranges than there are
    cores, ranges are made for so many rows instead.
    """
    modes = {"partitions": ("overwrite", "dynamic"), "replace": ("overwrite", "static"), "append": ("append", "static")}
    save_mode, overwrite = modes[mode]
    (
        in_order(flat, sort_key, at_most)
        .write.mode(save_mode)
        .option("partitionOverwriteMode", overwrite)
        .option("compression", "zstd")
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )


def in_order(flat: DataFrame, sort_key: str, at_most: int | None = None) -> DataFrame:
    """The rows with eventDate, dealt out by ranges and sorted as write_flat says."""
    placed = flat.withColumn("eventDate", F.to_date("timestampMs"))
    if sort_key == "hour":
        placed = placed.withColumn("hour", start_of("hour", "timestampMs"))
    ranges = min(MOST_RANGES, (at_most or 0) // ROWS_PER_RANGE + 1)
    number = [ranges] if ranges > flat.sparkSession.sparkContext.defaultParallelism else []
    ordered = placed.repartitionByRange(*number, *PARTITION_COLUMNS, *RANGE_KEYS[sort_key]).sortWithinPartitions(
        *PARTITION_COLUMNS, *SORT_KEYS[sort_key]
    )
    return ordered.drop("hour")


def write_version(
    flat: DataFrame, path: str, version: str, sort_key: str = "client", at_most: int | None = None
) -> None:
    """Add a version of the days that the rows hold. It becomes visible with its line in the record."""
    rows = in_order(flat, sort_key, at_most).withColumn(VERSION_COLUMN, F.lit(version))
    rows.write.mode("append").option("compression", "zstd").partitionBy(
        "eventDate", VERSION_COLUMN, "customerId"
    ).parquet(path)


def file_overlaps(flat: DataFrame, sort_key: str = "client") -> DataFrame:
    """customer_id, and how many of the tenant's files begin before one ahead of them has ended.

    Files of one day and tenant are compared by the range of the columns that tell them apart. A
    shared boundary is no overlap. 0 means that a condition on these columns can skip files.
    """
    keys = [start_of("hour", "timestampMs") if k == "hour" else F.col(k) for k in RANGE_KEYS[sort_key]]
    place = F.struct(*[k.alias(n) for n, k in zip(RANGE_KEYS[sort_key], keys, strict=True)])
    files = flat.groupBy("eventDate", "customerId", F.col("_metadata.file_path").alias("file")).agg(
        F.min(place).alias("first"), F.max(place).alias("last")
    )
    ahead = Window.partitionBy("eventDate", "customerId").orderBy("first", "last", "file").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        files.withColumn("reached", F.max("last").over(ahead))
        .groupBy(F.col("customerId").alias("customer_id"))
        .agg(F.count_if(F.col("first") < F.col("reached")).alias("overlaps"))
    )


def table_schema(schema: T.StructType) -> T.StructType:
    """Schema of a stored flat table: the day column is added for partitioning."""
    return T.StructType([*schema.fields, T.StructField("eventDate", T.DateType())])


def read_flat(spark: SparkSession, path: str, schema: T.StructType, record: Record | None = None) -> DataFrame:
    """Flat fact from Parquet, with a given schema, so that no file is opened to infer one.

    Of a table that loads have filled, the versions that a record names are read, by default its last
    line. Files of earlier loads lack the columns that later ones added. The reader gives 0 there, as the
    column's default; a coalesce after the scan would keep conditions such as intN > 0 from it.
    """
    stored = table_schema(with_zeros(schema))
    names = [f.name for f in schema.fields]
    if record is None and not has_record(spark, path):
        return spark.read.schema(stored).parquet(path).select(*names, "eventDate")
    record = record or read_record(spark, path)
    if not record.live:
        return spark.createDataFrame([], stored).select(*names, "eventDate")
    return read_versions(spark, path, schema, record).drop(VERSION_COLUMN)


def read_versions(spark: SparkSession, path: str, schema: T.StructType, record: Record) -> DataFrame:
    """The rows of the versions that a record names, with eventDate and version."""
    stored = table_schema(with_zeros(schema))
    versioned = T.StructType([*stored.fields, T.StructField(VERSION_COLUMN, T.StringType())])
    live = spark.read.schema(versioned).parquet(path).where(is_live(record.live))
    return live.select(*[f.name for f in schema.fields], "eventDate", VERSION_COLUMN)


def with_zeros(schema: T.StructType) -> T.StructType:
    """The schema with the numeric positional columns defaulting to 0 where a file lacks them."""
    fields = []
    for field in schema.fields:
        if column_class(field.name) in ("int", "float"):
            zero = f"CAST(0 AS {field.dataType.simpleString()})"
            field = T.StructField(
                field.name, field.dataType, field.nullable, {"CURRENT_DEFAULT": zero, "EXISTS_DEFAULT": zero}
            )
        fields.append(field)
    return T.StructType(fields)


def create_flat_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str | None = None,
    drop: bool = False,
    more_parts: list[str] | None = None,
) -> None:
    """Create an empty flat table whose columns fall back to 0 or '' when a writer leaves them out.

    more_parts: names of further folders, by string, between day and tenant.
    """
    if drop:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    folders = [T.StructField(c, T.StringType()) for c in more_parts or []]
    columns = ", ".join(_column_ddl(f) for f in [*table_schema(schema).fields, *folders])
    parts = ", ".join([PARTITION_COLUMNS[0], *(more_parts or []), *PARTITION_COLUMNS[1:]])
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({parts}){place}")


def _column_ddl(field: T.StructField) -> str:
    defaulted = field.name in DEFAULTED_COLUMNS or column_class(field.name) != "metadata"
    if not defaulted:
        return f"{field.name} {field.dataType.simpleString()}"
    zero = "''" if isinstance(field.dataType, T.StringType) else f"CAST(0 AS {field.dataType.simpleString()})"
    return f"{field.name} {field.dataType.simpleString()} DEFAULT {zero}"
