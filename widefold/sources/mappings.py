"""Reading and writing of key mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from widefold.operators.mapping import KeyMapping, key_mapping

NUMERIC_DOCUMENT = """
    struct<
      max_columns: struct<int_columns: int, float_columns: int>,
      customers: map<string, struct<int_mapping: map<string,string>, float_mapping: map<string,string>>>
    >
"""
# The names inside the JSON documents, here and in numeric_document.
TAG_ENTRY = "struct<keys: array<string>, key_count: int>"
TAG_DOCUMENT = f"struct<customers: map<string, {TAG_ENTRY}>, max_keys_per_customer: int>"
TAG_NON_TENANTS = ["max_keys_per_customer", "metadata", "customers"]


def _document(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON document. A mapping document holds keys, not data, and stays small."""
    return spark.read.text(path, wholetext=True)


def read_numeric_json(spark: SparkSession, path: str) -> KeyMapping:
    """Mapping from a nested JSON document; fails when max_columns or customers is absent."""
    parsed = _document(spark, path).select(F.from_json("value", NUMERIC_DOCUMENT).alias("d"))
    checked = parsed.select(
        F.when(
            F.col("d.max_columns").isNull() | F.col("d.customers").isNull(),
            F.raise_error(F.lit("a mapping needs max_columns and customers")),
        )
        .otherwise(F.col("d.customers"))
        .alias("customers"),
        "d.max_columns.*",
    )
    widths = checked.select("customers", "int_columns", "float_columns").first()
    tenants = checked.select(F.explode("customers").alias("customer_id", "entry")).withColumn(
        "customer_id", F.col("customer_id").cast("int")
    )
    parts = [
        tenants.select("customer_id", F.lit(kind).alias("kind"), F.explode(f"entry.{kind}_mapping").alias("key", "column"))
        for kind in ("int", "float")
    ]
    keys = parts[0].unionByName(parts[1]).select(
        "customer_id",
        "kind",
        "key",
        F.regexp_extract("column", r"(\d+)$", 1).cast("int").alias("idx"),
        "column",
    )
    mapping = key_mapping(keys, tenants.select("customer_id").distinct())
    return KeyMapping(
        mapping.keys,
        mapping.tenants,
        max(mapping.int_columns, widths["int_columns"] or 0),
        max(mapping.float_columns, widths["float_columns"] or 0),
    )


def numeric_document(mapping: KeyMapping) -> DataFrame:
    """The nested document as one row: max_columns and customers, with both directions per tenant.

    The document is one JSON object, so it suits mappings that fit a file; write_mapping has no limit.
    """
    by_idx = F.array_sort(F.collect_list(F.struct("idx", "key", "column")))
    per_kind = mapping.keys.groupBy("customer_id").pivot("kind", ["int", "float"]).agg(by_idx)
    none = F.array().cast("array<struct<idx:int,key:string,column:string>>")
    listed = mapping.tenants.join(per_kind, "customer_id", "left").select(
        "customer_id", *[F.coalesce(k, none).alias(k) for k in ("int", "float")]
    )
    fields = []
    for kind in ("int", "float"):
        keys, columns = F.col(f"{kind}.key"), F.col(f"{kind}.column")
        fields += [
            keys.alias(f"{kind}_keys"),
            F.map_from_arrays(keys, columns).alias(f"{kind}_mapping"),
            F.map_from_arrays(columns, keys).alias(f"reverse_{kind}_mapping"),
            F.size(kind).alias(f"{kind}_columns"),
        ]
    entry = F.struct(F.col("customer_id").cast("string"), F.struct(*fields))
    widths = F.struct(
        F.lit(mapping.int_columns).alias("int_columns"), F.lit(mapping.float_columns).alias("float_columns")
    )
    return listed.agg(F.map_from_entries(F.collect_list(entry)).alias("customers")).select(
        widths.alias("max_columns"), "customers"
    )


def write_numeric_json(mapping: KeyMapping, path: str) -> None:
    """Write the nested document."""
    numeric_document(mapping).write.mode("overwrite").json(path)


def add_to_mapping(added: DataFrame, tenants: DataFrame, path: str) -> None:
    """Add rows to the tables of write_mapping. Tenants that are there already do no harm."""
    added.write.mode("append").parquet(f"{path}/keys")
    tenants.write.mode("append").parquet(f"{path}/tenants")


def has_mapping(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/tenants")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def write_mapping(mapping: KeyMapping, path: str) -> None:
    """Write the mapping as tables: long rows and tenants. This form has no size limit."""
    mapping.keys.write.mode("overwrite").parquet(f"{path}/keys")
    mapping.tenants.write.mode("overwrite").parquet(f"{path}/tenants")


def read_mapping(spark: SparkSession, path: str) -> KeyMapping:
    """Mapping from the tables of write_mapping."""
    return key_mapping(spark.read.parquet(f"{path}/keys"), spark.read.parquet(f"{path}/tenants").distinct())


def read_tag_json(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Tag lists (customer_id, keys, key_count) and the declared maximum, from either JSON layout.

    Tenants sit under 'customers', or else at the top level beside 'metadata' and
    'max_keys_per_customer'.
    """
    documents = _document(spark, path)
    nested = documents.select(F.from_json("value", TAG_DOCUMENT).alias("d"))
    flat = documents.select(F.from_json("value", "map<string,string>").alias("top"))
    declared = nested.agg(F.coalesce(F.max("d.max_keys_per_customer"), F.lit(0)).alias("n")).first()["n"]
    under_customers = nested.select(F.explode("d.customers").alias("customer_id", "entry"))
    at_top = (
        flat.where(~F.map_contains_key("top", "customers"))
        .select(F.explode("top").alias("customer_id", "text"))
        .where(~F.col("customer_id").isin(TAG_NON_TENANTS))
        .select("customer_id", F.from_json("text", TAG_ENTRY).alias("entry"))
    )
    tags = under_customers.unionByName(at_top).select(
        F.col("customer_id").cast("int").alias("customer_id"), "entry.keys", "entry.key_count"
    )
    return tags, declared


def tag_document(entries: DataFrame) -> DataFrame:
    """Sorted tag keys of each tenant: customer_id, keys, key_count. A tenant without tags has none."""
    keys = F.array_sort(F.collect_set("key"))
    return entries.groupBy("customer_id").agg(keys.alias("keys")).withColumn("key_count", F.size("keys"))
