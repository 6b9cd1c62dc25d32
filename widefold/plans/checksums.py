"""Order-free checksums of a loaded flat table, and the rows in which two tables differ.

Checksums are kept beside the table, in <path>-sums, per version, day, tenant and column, so a version is read for
them once. Two tables are compared from their checksums first; rows are read of the days and tenants that differ
alone, and of these the columns that differ.

A cell counts with the hash of its group keys and its value, and one that is 0, '' or NULL counts nothing. So
neither the order of rows nor a column that the files of an older load lack makes a difference.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from widefold.model import GROUP_KEYS
from widefold.plans.small_side import join_lookup, materialise
from widefold.plans.task_size import materialise_in_small_tasks
from widefold.sources.flat import read_versions
from widefold.sources.loads import VERSION_COLUMN, read_record

#: Bits of a cell's hash. Their sum over two thousand million rows still fits a bigint.
HASH_BITS = 32
#: Stands for the group keys themselves.
KEYS = "(keys)"
PART = ["event_date", "customer_id", "column"]
SUMS = "version string, event_date date, customer_id int, column string, rows long, checksum long"


def sums_folder(path: str) -> str:
    return f"{path.rstrip('/')}-sums"


def _hash(*values: Column) -> Column:
    return F.xxhash64(*values).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _is_default(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(column == "", F.lit(True))
    if isinstance(field.dataType, T.NumericType):
        return F.coalesce(column == 0, F.lit(True))
    return column.isNull()


def column_sums(flat: DataFrame) -> DataFrame:
    """version, event_date, customer_id, column, rows and checksum of rows with eventDate and version.

    Each task sums its rows before the shuffle, which so carries a row per version, day, tenant and task.
    """
    fields = [f for f in flat.schema.fields if f.name not in (*GROUP_KEYS, "eventDate", VERSION_COLUMN)]
    key = F.xxhash64(*GROUP_KEYS)
    sums = [F.sum(_hash(key)).alias(KEYS)]
    sums += [F.sum(F.when(~_is_default(f), _hash(key, F.lit(f.name), F.col(f.name)))).alias(f.name) for f in fields]
    parts = flat.groupBy(VERSION_COLUMN, F.col("eventDate").alias("event_date"), F.col("customerId").alias("customer_id"))
    cells = [F.struct(F.lit(n).alias("column"), F.coalesce(f"`{n}`", F.lit(0)).alias("checksum")) for n in [KEYS, *[f.name for f in fields]]]
    return parts.agg(F.count("*").alias("rows"), *sums).select(
        VERSION_COLUMN, "event_date", "customer_id", "rows", F.inline(F.array(*cells))
    ).where((F.col("checksum") != 0) | (F.col("column") == KEYS)).select(*[s.split()[0] for s in SUMS.split(", ")])


def _kept(spark: SparkSession, path: str) -> DataFrame | None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sums_folder(path)}/load=*/_SUCCESS")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place):
        return None
    return spark.read.schema(f"{SUMS}, load int").parquet(sums_folder(path)).drop("load")


def update_checksums(spark: SparkSession, path: str, schema: T.StructType) -> list[str]:
    """Work out the checksums of live versions that have none yet; gives these versions."""
    record = read_record(spark, path)
    live = {v for versions in record.live.values() for v in versions}
    kept = _kept(spark, path)
    done = set() if kept is None else {r[0] for r in kept.select("version").distinct().collect()}
    new = sorted(live - done)
    if new:
        rows = read_versions(spark, path, schema, record).where(F.col(VERSION_COLUMN).isin(new))
        column_sums(rows).write.mode("overwrite").parquet(f"{sums_folder(path)}/load={record.number}")
    return new


def table_sums(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """event_date, customer_id, column, rows and checksum of what is live, brought up to date first."""
    update_checksums(spark, path, schema)
    record = read_record(spark, path)
    pairs = [(d, v) for d, versions in record.live.items() for v in versions]
    live = spark.createDataFrame(pairs, "event_date date, version string")
    kept = _kept(spark, path)
    if kept is None:
        return spark.createDataFrame([], SUMS).drop("version")
    summed = kept.join(F.broadcast(live), ["event_date", "version"]).groupBy(*PART)
    return summed.agg(F.sum("rows").alias("rows"), F.sum("checksum").alias("checksum"))


def differing_parts(left: DataFrame, right: DataFrame) -> DataFrame:
    """event_date, customer_id and column in which two tables differ, from their sums.

    Days are compared first, then the tenants and columns of the days that differ.
    """

    def by_day(sums: DataFrame, side: str) -> DataFrame:
        return sums.groupBy("event_date").agg(
            F.sum(_hash(*[F.col(c) for c in [*PART, "rows", "checksum"]])).alias(f"{side}_sum"), F.count("*").alias(f"{side}_n")
        )

    days = by_day(left, "left").join(by_day(right, "right"), "event_date", "full_outer")
    same = F.col("left_sum").eqNullSafe(F.col("right_sum")) & F.col("left_n").eqNullSafe(F.col("right_n"))
    changed = materialise(days.where(~same).select("event_date"))

    def of_days(sums: DataFrame, side: str) -> DataFrame:
        inside = sums.join(F.broadcast(changed), "event_date", "left_semi")
        return inside.select(*PART, *[F.col(c).alias(f"{side}_{c}") for c in ("rows", "checksum")])

    both = of_days(left, "left").join(of_days(right, "right"), PART, "full_outer")
    equal = [
        F.coalesce(f"left_{c}", F.lit(0)) == F.coalesce(f"right_{c}", F.lit(0)) for c in ("rows", "checksum")
    ]
    # Rows are told by the keys alone; another column that one side lacks is all zeros there.
    keys_equal = (F.col("column") != KEYS) | equal[0]
    return both.where(~(keys_equal & equal[1])).select(*PART)


def differing_rows(left: DataFrame, right: DataFrame, parts: DataFrame) -> DataFrame:
    """Group keys, column, left_value and right_value, as text, of the cells in which two flat tables differ.

    parts comes from differing_parts. Only its days and columns are read. The column '(keys)' stands for a row
    that one side lacks.
    """
    stored = materialise(parts)
    days = [r[0] for r in stored.select("event_date").distinct().collect()]
    columns = sorted(r[0] for r in stored.select("column").distinct().collect())
    names = [c for c in columns if c != KEYS]
    tenants = materialise(stored.select(F.col("event_date").alias("eventDate"), F.col("customer_id").alias("customerId")).distinct())

    def cells(flat: DataFrame, side: str) -> DataFrame:
        rows = flat.where(F.col("eventDate").isin(days)) if days else flat.where("false")
        rows = join_lookup(rows, tenants, ["eventDate", "customerId"])
        shown = [F.struct(F.lit(KEYS).alias("column"), F.lit("").alias(f"{side}_value"))]
        for f in flat.schema.fields:
            if f.name in names:
                value = F.when(~_is_default(f), F.col(f.name).cast("string"))
                shown.append(F.struct(F.lit(f.name).alias("column"), value.alias(f"{side}_value")))
        spread = rows.select(*GROUP_KEYS, F.inline(F.array(*shown)))
        return spread.where(F.col(f"{side}_value").isNotNull())

    a, b = cells(left, "left"), cells(right, "right").withColumnsRenamed({c: f"r_{c}" for c in [*GROUP_KEYS, "column"]})
    keys = [*GROUP_KEYS, "column"]
    match = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in keys])
    both = a.join(b, match, "full_outer").where(~F.col("left_value").eqNullSafe(F.col("right_value")))
    return both.select(*[F.coalesce(c, f"r_{c}").alias(c) for c in keys], "left_value", "right_value")


def compare_tables(spark: SparkSession, left_path: str, right_path: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """differing_rows of two loaded tables, whose rows are left and right, stored."""
    sums = [table_sums(spark, p, df.drop("eventDate").schema) for p, df in ((left_path, left), (right_path, right))]
    return materialise_in_small_tasks(differing_rows(left, right, differing_parts(*sums)))
