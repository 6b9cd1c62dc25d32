"""Exact dedup as a stream with keyed state.

Rows are read as a stream of files. The state, kept on disk by RocksDB and never expired, is keyed by the
digest of the normalised text, and holds how many rows had it, the least doc_id and the locator of that
row: its file and its place there. A later run takes in new files only. Where the state has met a digest
more than once, the rows of that digest are compared byte by byte with the row that stays, which is
found by its locator. Rows whose bytes differ in spite of one digest are grouped by their texts.

Of rows with equal texts the one with the least doc_id stays; among repeated rows the one that comes
first in its file. A null doc_id is greater than any other. Null text is empty, and empty texts are
equal. An empty folder gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from widefold.llm.common import ROWS_PER_SALT, read_table, whole_text
from widefold.plans.small_side import materialise, shared_folder

#: Input of one micro-batch. Each is committed, so a stream that is stopped goes on from there.
BYTES_PER_BATCH = 256 << 30
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # Many small stores each reserve disk for their logs otherwise.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Lets Spark build a Bloom filter of the wanted rows, whatever the sizes, and drop most others before
#: their texts are shuffled. Its size is bounded by spark.sql.optimizer.runtime.bloomFilter.maxNumBits.
FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def normalised() -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(whole_text(), r"[\x20\x09-\x0D]+", " ")


def digest_of(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other settings for the time of the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def located(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, text (normalised), digest, and the locator of each row of a Parquet folder."""
    whole = rows.select(
        "doc_id", normalised().alias("text"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
    )
    return whole.withColumn("digest", digest(F.col("text")))


def ingest(
    spark: SparkSession, path: str, state: str, digest: Callable[[Column], Column] = digest_of,
    bytes_per_batch: int = BYTES_PER_BATCH,
) -> None:
    """Take the files of a folder, or one file, that the state has not seen yet into the state.

    Rows of one digest are reduced inside each task before the shuffle, so copies that make up a third
    of all rows cost one row per task.
    """
    # A stream reads folders; a pattern that fits one name only lets it read a single file, too.
    stream = spark.readStream.schema(SCHEMA).option("maxBytesPerTrigger", bytes_per_batch).parquet(
        f"{path[:-1]}[{path[-1]}]"
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row"))
    counted = located(stream, digest).groupBy("digest").agg(first.alias("first"), F.count("*").alias("n"))
    with settings(spark, STATE):
        running = counted.writeStream.outputMode("update").format("noop").option("checkpointLocation", state)
        running.trigger(availableNow=True).start().awaitTermination()


def repeated(spark: SparkSession, state: str) -> DataFrame:
    """digest, n, keep_id, keep_file and keep_row of every digest that the state has met more than once."""
    with settings(spark, STATE):
        found = spark.read.format("statestore").load(state).where("value.count > 1")
        return materialise(found.select(
            "key.digest", F.col("value.count").alias("n"), F.col("value.min.doc_id").alias("keep_id"),
            F.col("value.min.file").alias("keep_file"), F.col("value.min.row").alias("keep_row"),
        ))


def is_keeper() -> Column:
    return (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))


def colliding(docs: DataFrame, told: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests under which texts differ.

    Which rows have a repeated digest is worked out without their texts; then only their texts are
    moved. A group's keeper is repeated once per ROWS_PER_SALT copies, so that its copies are
    compared by many tasks.
    """
    spark = docs.sparkSession
    row_id = F.coalesce("doc_id", F.lit(0)).alias("id")
    members = materialise(told.join(groups, "digest").select(row_id, "file", "row", "digest", "n", "keep_file", "keep_row"))
    whole = located(docs, digest_of).select(row_id, "file", "row", "text")
    with settings(spark, FILTER):
        joined = whole.join(members.where("n > 1"), ["id", "file", "row"])
        texts = materialise(joined.withColumn("salts", F.ceil(F.col("n") / ROWS_PER_SALT).cast("int")))
    keepers = texts.where(is_keeper()).select(
        "digest", F.col("text").alias("kept_text"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    )
    copies = texts.where(~is_keeper()).select(
        "digest", "text", F.pmod(F.xxhash64("file", "row"), F.col("salts")).cast("int").alias("salt")
    )
    return copies.join(keepers.hint("merge"), ["digest", "salt"]).where("text <> kept_text").select("digest").distinct()


def by_text(rows: DataFrame) -> DataFrame:
    """The groups of rows whose digests collide, told apart by their texts."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")).alias("first")
    groups = rows.groupBy("digest", "text").agg(first, F.count("*").alias("n"))
    return rows.join(groups, ["digest", "text"]).select(
        *rows.columns, "n", F.col("first.doc_id").alias("keep_id"),
        F.col("first.file").alias("keep_file"), F.col("first.row").alias("keep_row"),
    )


def exact_groups(
    docs: DataFrame, state: str, digest: Callable[[Column], Column] = digest_of
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of the folder that was taken in.

    docs reads that folder. Runs the comparison of bytes when called.
    """
    spark = docs.sparkSession
    groups = repeated(spark, state)
    rows = located(docs, digest)
    told = rows if digest is digest_of else rows.withColumn("sha", digest_of(F.col("text")))
    told = materialise(told.drop("text"))
    collided = materialise(colliding(docs, told, groups))
    whole = told.join(groups, "digest", "left")
    if not collided.isEmpty():
        exact = by_text(rows.join(collided, "digest", "left_semi"))
        exact = exact.withColumn("sha", digest_of(F.col("text"))).drop("text")
        whole = whole.join(collided, "digest", "left_anti").unionByName(exact, allowMissingColumns=True)
    sha = F.col("sha") if "sha" in whole.columns else F.col("digest")
    single = F.col("n").isNull()
    return whole.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (single | is_keeper()).alias("kept"),
        sha.alias("text_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = f"{shared_folder(spark)}/seen-{uuid.uuid4().hex}"
    ingest(spark, f"{sf_dir}/documents.parquet", state)
    return exact_groups(read_table(spark, sf_dir, "documents"), state)


ORACLE_SQL = r"""
WITH rows AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
FROM rows WINDOW w AS (PARTITION BY text)
"""
