"""Which map keys occur in which file of a raw fact, kept up to date by scanning new files only.

The catalogue lies beside a fact that write_wide has stored, in <path>-keys. A scan adds the entries of files
that are new or have changed, and then a snapshot: all files that are there, each with the scan that holds its
entries. The last snapshot tells which entries are live, so a scan that is stopped changes nothing.

It serves discovery, which unites the keys of all files without opening one again, and the map path, which
opens only the files that hold a key with a value above 0.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from widefold.functions.maps import is_not_blank
from widefold.model import GROUPS_PER_KIND, group_columns
from widefold.plans.small_side import join_lookup, materialise
from widefold.sources.wide import read_wide

KINDS = ("int", "float", "string")
#: Up to so many files are named one by one; of more, the whole table is read.
MOST_NAMED = 10_000


def catalogue_folder(path: str) -> str:
    return f"{path.rstrip('/')}-keys"


def _name(path: Column) -> Column:
    """A file by its day folder and its own name."""
    return F.regexp_extract(path, "(eventDate=[^/]+/[^/]+)$", 1)


def files_present(spark: SparkSession, path: str) -> DataFrame:
    """file, length and modified of all files of the fact. None is opened."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    )
    return listed.select(_name(F.col("path")).alias("file"), "length", F.col("modificationTime").alias("modified"))


def has_catalogue(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{catalogue_folder(path)}/files/scan=*/_SUCCESS")
    return bool(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place))


def last_snapshot(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """Number of the last scan, and file, length, modified and scan of the files it has seen."""
    schema = "file string, length long, modified timestamp, entries_of int, scan int"
    if not has_catalogue(spark, path):
        return 0, spark.createDataFrame([], schema).drop("scan")
    snapshots = spark.read.schema(schema).parquet(f"{catalogue_folder(path)}/files")
    last = snapshots.select("scan").distinct().agg(F.max("scan").alias("n")).first()["n"]
    return last, snapshots.where(F.col("scan") == last).drop("scan")


def file_entries(fact: DataFrame) -> DataFrame:
    """Distinct file, customer_id, kind, group_no and key of the maps, with the key's highest value in the file.

    A tenant of a file also has a row without key. Strings have no highest value. Rows are reduced in
    each task before the shuffle.
    """
    columns = [(kind, n, name) for kind in KINDS for n, name in enumerate(group_columns(kind), 1)]
    entry = "array<struct<key: string, value: double>>"
    no_number = "transform(map_keys({0}), k -> named_struct('key', k, 'value', CAST(NULL AS DOUBLE)))"
    lists = [
        F.expr(no_number.format(name) if kind == "string" else f"CAST(map_entries({name}) AS {entry})")
        for kind, _, name in columns
    ]
    tenant = F.expr(f"CAST(array(named_struct('key', NULL, 'value', NULL)) AS {entry})")
    position = F.col("pos")
    kind_of = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.floor(position / GROUPS_PER_KIND) + 1).cast("int"))
    is_entry = position < len(columns)
    return (
        fact.select(
            _name(F.col("_metadata.file_path")).alias("file"), F.col("customerId").alias("customer_id"),
            F.posexplode(F.array(*lists, tenant)).alias("pos", "entries"),
        )
        .select("file", "customer_id", "pos", F.explode("entries").alias("e"))
        .groupBy("file", "customer_id", "pos", F.col("e.key").alias("key"))
        .agg(F.max("e.value").alias("highest"))
        .where(F.col("key").isNull() | is_not_blank(F.col("key")))
        .select(
            "file", "customer_id", F.when(is_entry, kind_of).alias("kind"),
            F.when(is_entry, (position % GROUPS_PER_KIND + 1).cast("int")).alias("group_no"), "key", "highest",
        )
    )


def rows_of_files(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """The rows of files of the fact. Day folders without any of them are not read."""
    day = F.to_date(F.regexp_extract("file", "eventDate=([^/]+)/", 1)).alias("day")
    days = [r["day"] for r in files.select(day).distinct().collect()]
    rows = read_wide(spark, path, by_date=True)
    rows = rows.where(F.col("eventDate").isin(days)) if days else rows.where("false")
    wanted = files.select(F.col("file").alias("wanted_file"))
    return rows.select("*", "_metadata").join(F.broadcast(wanted), _name(F.col("_metadata.file_path")) == F.col("wanted_file"), "left_semi")


def update_catalogue(spark: SparkSession, path: str) -> int:
    """Scan the files that are new or have changed; gives their number."""
    last, seen = last_snapshot(spark, path)
    present = materialise(files_present(spark, path))
    known = present.join(seen, ["file", "length", "modified"], "left")
    snapshot = materialise(known.select("file", "length", "modified", "entries_of"))
    new = snapshot.where("entries_of IS NULL")
    count = new.count()
    if count == 0 and snapshot.count() == seen.count():
        return 0
    folder, number = catalogue_folder(path), last + 1
    entries = file_entries(rows_of_files(spark, path, new))
    # What a stopped scan of this number has left is replaced.
    entries.write.mode("overwrite").parquet(f"{folder}/entries/scan={number}")
    snapshot.withColumn("entries_of", F.coalesce("entries_of", F.lit(number))).write.mode("overwrite").parquet(
        f"{folder}/files/scan={number}"
    )
    return count


def live_entries(spark: SparkSession, path: str) -> DataFrame:
    """file, customer_id, kind, group_no, key and highest of the files of the last snapshot."""
    _, files = last_snapshot(spark, path)
    schema = "file string, customer_id int, kind string, group_no int, key string, highest double, scan int"
    entries = spark.read.schema(schema).parquet(f"{catalogue_folder(path)}/entries")
    live = materialise(files.select("file", F.col("entries_of").alias("scan")))
    return join_lookup(entries, live, ["file", "scan"]).drop("scan")


def catalogued_entries(spark: SparkSession, path: str, kinds: tuple[str, ...] = ("int", "float")) -> DataFrame:
    """What discover_entries finds in the fact, from the catalogue, which is brought up to date first."""
    update_catalogue(spark, path)
    wanted = F.col("key").isNull() | F.col("kind").isin(*kinds)
    return live_entries(spark, path).where(wanted).select("customer_id", "kind", "group_no", "key").distinct()


def scan_for_key(
    spark: SparkSession,
    path: str,
    tenant: int,
    group: str,
    key: str,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
) -> DataFrame:
    """The fact without the files that hold no value above 0 of a tenant's key in a map column.

    Days outside the range are left out too. Files that the catalogue has not seen are read.
    """
    kind = "int" if group in group_columns("int") else "float"
    number = group_columns(kind).index(group) + 1
    held = live_entries(spark, path).where(
        (F.col("customer_id") == tenant) & (F.col("kind") == kind) & (F.col("group_no") == number) & (F.col("key") == key)
    )
    _, seen = last_snapshot(spark, path)
    unseen = files_present(spark, path).join(seen, ["file", "length", "modified"], "left_anti").select("file")
    wanted = held.where("highest > 0").select("file").unionByName(unseen).distinct()
    files = [r["file"] for r in wanted.limit(MOST_NAMED + 1).collect()]
    whole = read_wide(spark, path, by_date=True)
    if len(files) > MOST_NAMED:
        return whole
    if start is not None:
        first, last = str(start)[:10], str(end)[:10]
        files = [f for f in files if first <= f.split("=")[1][:10] <= last]
    if not files:
        return whole.where("false")
    base = path.rstrip("/")
    return spark.read.schema(whole.schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in sorted(files)])


def days_catalogued(spark: SparkSession, path: str) -> list[date]:
    """The days whose files the last snapshot holds."""
    _, files = last_snapshot(spark, path)
    day = F.to_date(F.regexp_extract("file", "eventDate=([^/]+)/", 1)).alias("day")
    return sorted(r["day"] for r in files.select(day).distinct().collect())
