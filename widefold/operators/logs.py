"""Per-chunk and per-tenant statistics from load logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from widefold.functions.labels import duration_text, period_label
from widefold.functions.times import seconds_between
from widefold.plans.small_side import join_lookup, materialise

# The texts a load log is made of. A line takes the first event that matches.
PHASE_MARKER = "PHASE 3: DATA TRANSFORMATION"
TIMESTAMP = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})"
EVENTS = {
    "tenant": r"Processing customer (\d+)",
    "start": r"Processing chunk (\d+)/\d+: (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) to (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})",
    "compression": r"Compression for chunk: (\d+) raw → (\d+) aggregated rows \((\d+\.\d+)x\)",
    "fetched": r"Fetched (\d+) aggregated rows",
    "transformed": r"Transformed (\d+) pre-aggregated rows",
    "inserting": r"Inserting (\d+) rows into target table",
    "inserted": r"Successfully inserted (\d+) rows",
    "completed": r"Chunk (\d+) completed",
}
STAGES = ["fetched", "transformed", "inserting", "inserted"]

LINE_KEYS = ["log_id", "block", "pos"]


def parse_events(lines: DataFrame) -> DataFrame:
    """Typed events of log lines (log_id, block, pos, value); lines without an event are left out.

    block numbers the pieces of a log in order and pos orders the lines of a piece.
    """
    value = F.col("value")
    at_text = F.regexp_extract(value, TIMESTAMP, 1)
    event = F.lit(None).cast("string")
    for name, pattern in reversed(EVENTS.items()):
        event = F.when(value.rlike(pattern), F.lit(name)).otherwise(event)
    typed = lines.select(
        *LINE_KEYS,
        value.contains(PHASE_MARKER).alias("is_marker"),
        F.when(at_text != "", F.to_timestamp_ntz(at_text, F.lit("yyyy-MM-dd HH:mm:ss,SSS"))).alias("at"),
        event.alias("event"),
        "value",
    )
    kept = typed.withColumn("event", F.when(F.col("at").isNotNull(), F.col("event"))).where(
        F.col("is_marker") | F.col("event").isNotNull()
    )

    def part(name: str, group: int) -> Column:
        return F.when(F.col("event") == name, F.regexp_extract("value", EVENTS[name], group))

    return kept.select(
        *LINE_KEYS,
        "is_marker",
        "at",
        "event",
        part("tenant", 1).cast("int").alias("tenant"),
        part("start", 1).cast("int").alias("chunk_no"),
        period_label(part("start", 2), part("start", 3)).alias("period"),
        part("compression", 1).cast("bigint").alias("raw_rows"),
        part("compression", 2).cast("bigint").alias("agg_rows"),
        part("compression", 3).cast("double").alias("ratio"),
    )


def after_marker(events: DataFrame, logs: DataFrame | None = None) -> DataFrame:
    """Events from the first phase marker of each log on; a log without one is an error.

    logs: log_id of all logs; without it a log that holds neither marker nor event is not noticed.
    """
    blocks = events.groupBy("log_id", "block").agg(F.min(F.when(F.col("is_marker"), F.col("pos"))).alias("marker_pos"))
    found = F.min(F.when(F.col("marker_pos").isNotNull(), F.struct("block", "marker_pos"))).alias("marker")
    first = blocks.groupBy("log_id").agg(found)
    if logs is not None:
        first = logs.join(first, "log_id", "left")
    error = F.raise_error(F.concat(F.lit(f"log without '{PHASE_MARKER}': "), F.col("log_id").cast("string")))
    # Stored, so that the logs are looked at even where no event of theirs asks for the marker.
    checked = materialise(first.withColumn("marker", F.when(F.col("marker").isNull(), error).otherwise(F.col("marker"))))
    in_or_after = F.struct("block", F.col("pos").alias("marker_pos")) >= F.col("marker")
    return (
        join_lookup(events, checked, ["log_id"])
        .where(in_or_after & F.col("event").isNotNull())
        .drop("marker", "is_marker")
    )


def with_chunks(events: DataFrame) -> DataFrame:
    """Events with the tenant in force and with the chunk they belong to.

    A chunk begins at its start line and ends with its completion line. Each block of a log is
    numbered by itself, then one row per block carries the last chunk and tenant over to the
    blocks that follow, so no task reads more than one block of lines.
    """
    in_order = Window.partitionBy("log_id", "block").orderBy("pos")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.sum((F.col("event") == "start").cast("int")).over(so_far)
    ended = F.coalesce(F.sum((F.col("event") == "completed").cast("int")).over(before), F.lit(0))
    numbered = events.select(
        "*",
        (starts + ended).alias("segment"),
        F.last("tenant", ignorenulls=True).over(so_far).alias("tenant_here"),
    )
    boundaries = F.count_if(F.col("event").isin("start", "completed"))
    blocks = events.groupBy("log_id", "block").agg(
        boundaries.alias("segments"),
        F.max_by("tenant", F.when(F.col("tenant").isNotNull(), F.col("pos"))).alias("last_tenant"),
    )
    earlier = Window.partitionBy("log_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_segment = F.when(F.col("segments") > 0, F.struct("block", F.col("segments").alias("segment")))
    carried = blocks.select(
        "log_id",
        "block",
        F.last(open_segment, ignorenulls=True).over(earlier).alias("carried_segment"),
        F.last("last_tenant", ignorenulls=True).over(earlier).alias("carried_tenant"),
    )
    own = F.struct(F.col("block"), F.col("segment").cast("bigint").alias("segment"))
    return (
        numbered.join(carried, ["log_id", "block"])
        .withColumn("chunk", F.when(F.col("segment") > 0, own).otherwise(F.col("carried_segment")))
        .withColumn("tenant", F.coalesce("tenant_here", "carried_tenant"))
        .where(F.col("chunk").isNotNull())
        .drop("segment", "tenant_here", "carried_segment", "carried_tenant")
    )


def chunks(lines: DataFrame) -> DataFrame:
    """One row per chunk start, complete or not, with its stage times in seconds.

    The parsed events are materialised when this is called: they are read several times below, and the lines need to
    be matched against the patterns only once.
    """
    events = with_chunks(after_marker(materialise(parse_events(lines)), lines.select("log_id").distinct()))
    order = F.struct("block", "pos")

    def last_of(column: str, event: str) -> Column:
        return F.max_by(column, F.when(F.col("event") == event, order))

    grouped = events.groupBy("log_id", "chunk").agg(
        last_of("tenant", "start").alias("start_tenant"),
        last_of("tenant", "completed").alias("customer_id"),
        last_of("chunk_no", "start").alias("chunk_no"),
        last_of("period", "start").alias("period"),
        last_of("at", "start").alias("started"),
        *[last_of("at", stage).alias(stage) for stage in STAGES],
        last_of("at", "completed").alias("completed"),
        *[last_of(c, "compression").alias(c) for c in ("raw_rows", "agg_rows", "ratio")],
    )
    needed = ["customer_id", "chunk_no", "started", *STAGES, "completed"]
    whole = F.lit(True)
    for name in needed:
        whole = whole & F.col(name).isNotNull()
    return grouped.where(F.col("started").isNotNull()).select(
        "log_id",
        "start_tenant",
        "customer_id",
        "chunk_no",
        "period",
        "started",
        "completed",
        "raw_rows",
        "agg_rows",
        "ratio",
        whole.alias("is_complete"),
        seconds_between(F.col("started"), F.col("fetched")).alias("aggregate_seconds"),
        seconds_between(F.col("fetched"), F.col("transformed")).alias("transform_seconds"),
        seconds_between(F.col("inserting"), F.col("inserted")).alias("insert_seconds"),
        seconds_between(F.col("started"), F.col("completed")).alias("total_seconds"),
    )


def tenant_stats(chunk_rows: DataFrame) -> DataFrame:
    """Per tenant: rows, chunks, mean stage times, mean chunk ratio, span of the load.

    The span runs from the first chunk start, complete or not, to the last completion. A tenant
    without a complete chunk is left out. A chunk counts once for the tenant it started under and
    once for the tenant it completed under, in one pass.
    """
    twice = chunk_rows.withColumn("as_start", F.explode(F.array(F.lit(True), F.lit(False))))
    tenant = F.when(F.col("as_start"), F.col("start_tenant")).when(F.col("is_complete"), F.col("customer_id"))
    finished = twice.withColumn("customer_id", tenant).where(F.col("customer_id").isNotNull())

    def done(column: str) -> Column:
        return F.when(~F.col("as_start"), F.col(column))

    stats = finished.groupBy("customer_id").agg(
        F.coalesce(F.sum(done("raw_rows")), F.lit(0)).alias("total_raw_rows"),
        F.coalesce(F.sum(done("agg_rows")), F.lit(0)).alias("total_agg_rows"),
        F.count_if(~F.col("as_start")).alias("total_chunks"),
        *[F.avg(done(f"{stage}_seconds")).alias(f"avg_{stage}_seconds") for stage in ("aggregate", "transform", "insert", "total")],
        F.coalesce(F.avg(done("ratio")), F.lit(0.0)).alias("avg_compression_ratio"),
        F.min(F.when(F.col("as_start"), F.col("started"))).alias("first_started"),
        F.max(done("completed")).alias("last_completed"),
    )
    span = seconds_between(F.col("first_started"), F.col("last_completed"))
    return (
        stats.where("total_chunks > 0")
        .withColumn("total_time_seconds", span)
        .withColumn("total_time_text", duration_text(F.col("total_time_seconds")))
        .drop("first_started", "last_completed")
    )
