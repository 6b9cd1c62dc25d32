"""Wide-map facts, timing samples and load logs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from widefold.functions.times import start_of, ts_literal
from widefold.model import wide_schema
from widefold.operators.discovery import chunk_grid
from widefold.operators.logs import PHASE_MARKER
from widefold.operators.preagg import compression_by_chunk

# Fixed values of the derived fact.
PLATFORMS = ["web", "ios", "android", "tv"]
DEVICE_CATEGORIES = ["phone", "tablet", "console"]
COUNTRIES = ["us", "de", "in", "br", "jp"]
FIRST_DAY = "2024-01-01 00:00:00"
LAST_DAY = "2024-01-31 00:00:00"

KEYS_PER_STATUS = 10
LINES_PER_CHUNK = 10
LINES_PER_BLOCK = 64
CHUNK_MINUTES = 60

# Events that a task turns into raw rows, as long as that takes no more tasks than the most.
EVENTS_PER_TASK = 20_000
MOST_TASKS = 200


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _complete(rows: DataFrame, given: dict[str, Column]) -> DataFrame:
    """All columns of the wide schema: the given ones, and 0, '' or an empty map for the rest."""
    columns = []
    for field in wide_schema().fields:
        kind = field.dataType.simpleString()
        if field.name in given:
            columns.append(given[field.name].cast(field.dataType).alias(field.name))
        else:
            default = "map()" if kind.startswith("map") else "''" if kind == "string" else "0"
            columns.append(F.expr(f"CAST({default} AS {kind}) AS {field.name}"))
    return rows.select(*columns)


def dealt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, dealt out by time while they are narrow: a file of one row group is read by one task.

    Up to 200 parts a shuffle writes without holding rows in memory (spark.shuffle.sort.bypassMergeThreshold).
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    parts = min(MOST_TASKS, events.count() // EVENTS_PER_TASK + 1)
    return events.repartitionByRange(parts, "ts", "event_id")


def wide_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide-map fact of the events table, one raw row per event.

    'retries' sits in two map columns, and one key of map column 7 is blank.
    """
    events = dealt_events(spark, sf_dir)
    user, kind = F.col("user_id"), F.col("event_type")
    tenant = (user % 3).cast("int")
    ts = start_of("millisecond", "ts")
    day_text = F.replace(F.to_date("ts").cast("string"), F.lit("-"), F.lit(""))
    prefix = F.concat(F.lit("f_"), tenant.cast("string"), F.lit("_"), kind)
    no_ints = F.create_map().cast("map<string,int>")

    def single(key: Column, value: Column, when: Column | None = None) -> Column:
        entry = F.create_map(key, value.cast("int"))
        return entry if when is None else F.when(when, entry).otherwise(no_ints)

    has_duration = ~((tenant == 0) & (kind == "signup"))
    given = {
        "timestampMs": ts,
        "customerId": tenant,
        "clientId": user.cast("string"),
        "sessionId": F.concat(user.cast("string"), F.lit("-"), day_text),
        "flowId": kind,
        "flowStartTimeMs": start_of("hour", "ts"),
        "watermarkMs": ts,
        "appVersion": F.concat(F.lit("1."), (F.col("event_id") % 7).cast("string")),
        "partitionId": F.col("event_id") % 16,
        "retentionDate": F.date_add(F.to_date("ts"), 30),
        "platform": _pick(PLATFORMS, user),
        "deviceCategory": _pick(DEVICE_CATEGORIES, user),
        "countryIso": _pick(COUNTRIES, user),
        "country": user % 5,
        "metricIntGroup1": single(F.concat(prefix, F.lit("_success")), F.col("value") > 100),
        "metricIntGroup2": single(F.concat(prefix, F.lit("_total_duration")), F.round(F.col("value") * 100), has_duration),
        "metricIntGroup4": single(F.lit("retries"), F.lit(1), kind == "click"),
        "metricIntGroup7": single(F.lit(" "), F.lit(5), kind == "error"),
        "metricIntGroup9": single(F.lit("retries"), F.lit(10), kind == "purchase"),
        "metricIntGroup15": single(F.lit("event_count"), F.lit(1)),
        "metricFloatGroup1": F.create_map(F.concat(kind, F.lit("_value")), F.col("value").cast("float")),
        "tagGroup1": F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), kind, F.lit("")),
    }
    return _complete(events, given)


def lineitem_fact(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """A larger wide-map fact of one day: a client is a supplier, a session an order.

    One raw row per line item and copy; a copy has orders of its own. Keys come from the status of a
    line and its part, so that a tenant has about 180 of them in three map columns.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn(
        "l_orderkey", F.explode(F.array(*[F.col("l_orderkey") * copies + i for i in range(copies)]))
    )
    supplier = F.col("l_suppkey")
    status = F.concat_ws("_", "l_returnflag", "l_linestatus", (F.col("l_partkey") % KEYS_PER_STATUS).cast("string"))

    def single(name: str, value: Column) -> Column:
        return F.create_map(F.concat(status, F.lit(name)), value.cast("int"))

    second_of_day = (F.col("l_orderkey") * 7 + F.col("l_partkey")) % 86400
    ts = ts_literal(FIRST_DAY) + F.make_dt_interval(secs=second_of_day.cast("decimal(18,6)"))
    given = {
        "timestampMs": ts,
        "customerId": supplier % 3,
        "clientId": supplier.cast("string"),
        "sessionId": F.col("l_orderkey").cast("string"),
        "flowId": F.col("l_returnflag"),
        "flowStartTimeMs": ts,
        "watermarkMs": ts,
        "retentionDate": F.date_add(F.to_date(ts), 30),
        "platform": _pick(PLATFORMS, supplier),
        "deviceCategory": _pick(DEVICE_CATEGORIES, supplier),
        "countryIso": _pick(COUNTRIES, supplier),
        "country": supplier % 5,
        "metricIntGroup1": single("_quantity", F.col("l_quantity")),
        "metricIntGroup2": single("_price", F.round(F.col("l_extendedprice") * 100)),
        "metricIntGroup3": F.create_map(
            F.concat(status, F.lit("_success")), F.lit(1)
        ),
        "metricIntGroup15": F.create_map(F.lit("event_count"), F.lit(1)),
    }
    return _complete(lines, given)


def timing_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One timing sample per event, with both kind columns."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    tenant = (F.col("user_id") % 3).cast("int")
    suffix = F.element_at(
        F.array(F.lit("_success"), F.lit("_total_duration"), F.lit("")), (F.col("event_id") % 3 + 1).cast("int")
    )
    first = F.col("user_id") % 2 == 0
    return events.select(
        tenant.alias("customer_id"),
        F.concat(F.lit("tenant-"), tenant.cast("string")).alias("customer_name"),
        F.concat("event_type", suffix).alias("metric_key"),
        F.when(first, "old").otherwise("new").alias("schema_type"),
        F.when(first, "direct_table").otherwise("through_view").alias("access_type"),
        F.col("event_id").cast("int").alias("run_number"),
        F.col("value").alias("execution_time_seconds"),
        F.lit(1).cast("bigint").alias("row_count"),
        F.to_date("ts").cast("string").alias("query_date"),
    )


def load_log(fact: DataFrame) -> DataFrame:
    """Lines of a load log of the fact: log_id, block, pos, value.

    One chunk per tenant and hour. A chunk without rows gets the short form, and a chunk whose raw
    rows divide by 11 lacks its last insert line. The lines before the phase marker must not count.
    Tenant t is logged as 101 + t.
    """
    counted = compression_by_chunk(fact, CHUNK_MINUTES).select("customer_id", "chunk_start", "agg_rows")
    grid = chunk_grid(fact, CHUNK_MINUTES).join(counted, ["customer_id", "chunk_start"], "left").na.fill(0)
    hours = (F.unix_date(F.to_date("chunk_start")) - F.unix_date(F.lit("2024-01-01").cast("date"))) * 24 + F.hour(
        "chunk_start"
    )
    numbered = grid.withColumn("chunk_no", hours + 1).withColumn(
        "started",
        F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
        + F.make_dt_interval(days=F.col("customer_id") * 2, mins=F.col("chunk_no")),
    )
    raw, agg = F.col("raw_rows"), F.col("agg_rows")
    fetched = 100 + raw * 13
    transformed = fetched + 50 + agg * 7
    inserted = transformed + 25 + agg * 3

    def line(order: int, ms: Column | int, text: Column, when: Column | None = None) -> Column:
        moment = F.col("started") + F.make_dt_interval(secs=(F.lit(ms) / 1000).cast("decimal(18,6)"))
        entry = F.struct(
            F.lit(order).alias("order"),
            F.concat(F.date_format(moment, "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" - INFO - "), text).alias("value"),
        )
        return entry if when is None else F.when(when, entry)

    tenant_text = (F.col("customer_id") + 101).cast("string")
    start_text = F.date_format("chunk_start", "yyyy-MM-dd HH:mm:ss")
    end_text = F.date_format(F.col("chunk_start") + F.expr("interval 59 minutes 59 seconds"), "yyyy-MM-dd HH:mm:ss")
    number, raws, aggs = (F.col(c).cast("string") for c in ("chunk_no", "raw_rows", "agg_rows"))
    ratio = F.when(agg > 0, F.concat(F.format_string("%.2f", raw / agg), F.lit("x"))).otherwise("N/A")
    some = agg > 0
    entries = F.array(
        line(0, 0, F.concat(F.lit("Processing customer "), tenant_text), F.col("chunk_no") == 1),
        line(1, 0, F.concat(F.lit("Processing chunk "), number, F.lit("/720: "), start_text, F.lit(" to "), end_text, F.lit(".999"))),
        line(2, fetched, F.concat(F.lit("  Fetched "), aggs, F.lit(" aggregated rows for time chunk"))),
        line(3, fetched, F.concat(F.lit("  Compression for chunk: "), raws, F.lit(" raw → "), aggs, F.lit(" aggregated rows ("), ratio, F.lit(")"))),
        line(4, fetched, F.concat(F.lit("  No data found for chunk "), number), ~some),
        line(5, transformed, F.concat(F.lit("Transformed "), aggs, F.lit(" pre-aggregated rows into "), aggs, F.lit(" target rows")), some),
        line(6, transformed + 5, F.concat(F.lit("Inserting "), aggs, F.lit(" rows into target table")), some),
        line(7, inserted, F.concat(F.lit("Successfully inserted "), aggs, F.lit(" rows")), some & (raw % 11 != 0)),
        line(8, inserted + 1, F.concat(F.lit("  Chunk "), number, F.lit(" completed: "), aggs, F.lit(" source rows → "), aggs, F.lit(" target rows")), some),
    )
    body = numbered.select("customer_id", "chunk_no", F.explode(entries).alias("line")).where("line IS NOT NULL")
    place = (F.col("customer_id") * 1_000_000 + F.col("chunk_no")) * LINES_PER_CHUNK + F.col("line.order")
    lines = body.select(place.cast("bigint").alias("pos"), F.col("line.value").alias("value"))
    opening = fact.sparkSession.createDataFrame(
        [
            (0, "2024-03-01 00:00:00,000 - INFO - Processing customer 999"),
            (1, "2024-03-01 00:00:00,000 - INFO - Processing chunk 1/720: 2024-01-01 00:00:00 to 2024-01-01 00:59:59.999"),
            (2, "2024-03-01 00:00:00,000 - INFO - Chunk 1 completed: 1 source rows → 1 target rows"),
            (3, PHASE_MARKER),
        ],
        "pos bigint, value string",
    )
    return opening.unionByName(lines).select(
        F.lit("load.log").alias("log_id"), F.floor(F.col("pos") / LINES_PER_BLOCK).alias("block"), "pos", "value"
    )
