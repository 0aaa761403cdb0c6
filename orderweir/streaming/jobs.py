"""The streaming jobs: order fan-out, customer totals, change capture, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderweir.functions import columns as c
from orderweir.operators import cdc, projections
from orderweir.operators.latest import latest_per_key
from orderweir.operators.running import latest_totals
from orderweir.sources.changes import changes
from orderweir.sources.landing import Landing
from orderweir.sources.order_events import order_event_json, parse_order_events
from orderweir.streaming.changelog import FIELDS, log_snapshots, snapshots
from orderweir.streaming.sinks import append_batch


def run_available(writer, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, in bounded batches, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_every(writer, checkpoint: str, interval: str = "5 seconds") -> StreamingQuery:
    """Run on and on, one micro-batch per interval; the source's limit bounds its size."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def fan_out(messages: DataFrame, path: str):
    """One read of order messages feeds header, line and customer-contribution logs.

    Returns a stream writer; each micro-batch is parsed once and written three times.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        events = parse_order_events(batch).persist()
        try:
            append_batch(projections.sales_orders(events), batch_id, f"{path}/sales_order")
            append_batch(projections.line_items(events), batch_id, f"{path}/sales_order_line_item")
            append_batch(
                projections.customer_contributions(events), batch_id, f"{path}/customer_contribution"
            )
        finally:
            events.unpersist()

    return messages.writeStream.foreachBatch(write)


def totals_stream(events: DataFrame, arrival: str) -> DataFrame:
    """Customer totals of a stream of order events, for update mode.

    There is no watermark: however late an event is, it counts. State grows with
    the number of customers.
    """
    return latest_totals(
        projections.customer_contributions(events, arrival),
        key="customerId",
        arrival=arrival,
        event_time="updatedAt",
        sums=projections.CUSTOMER_SUMS,
        latest=projections.CUSTOMER_LATEST,
    )


def log_totals(totals: DataFrame, path: str):
    """Append updated totals to a log. A batch writes its own rows only, and a repeated batch replaces itself.

    Rows are whole totals: the last one of each key is its state, see `last_logged`.
    """
    return totals.writeStream.outputMode("update").foreachBatch(lambda batch, i: append_batch(batch, i, path))


def _last_rows(spark: SparkSession, path: str, keys: list[str], order: list[str], base: str | None) -> DataFrame:
    rows = spark.read.parquet(path)
    if base:
        packed = spark.read.parquet(base)
        upto = packed.agg(F.max("_upto")).first()[0]
        rows = packed.where(F.col("_upto") == upto).drop("_upto").unionByName(rows.where(F.col("_batch_id") > upto))
    return latest_per_key(rows, keys, [*order, "_batch_id"])


def last_logged(spark: SparkSession, path: str, keys: list[str], order: list[str], base: str | None = None) -> DataFrame:
    """The state that a log of updates describes: the last row of every key.

    base: a folder that `compact_log` wrote; then only batches after it are read from the log.
    """
    return _last_rows(spark, path, keys, order, base).drop("_ingest_ts", "_batch_id")


def compact_log(spark: SparkSession, path: str, target: str, keys: list[str], order: list[str], base: str | None = None) -> None:
    """Write the state of a log to `target`, with the last batch it covers; run it now and then, beside writers and readers.

    base: an earlier compaction to start from, which may be `target` itself: each one lies in a folder of its own.
    """
    upto = spark.read.parquet(path).agg(F.max("_batch_id")).first()[0]
    state = _last_rows(spark, path, keys, order, base).where(F.col("_batch_id") <= upto)
    writer = state.withColumn("_upto", F.lit(upto)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_upto").parquet(target)


def source_stream(landing: Landing, name: str, files_per_batch: int = 64) -> DataFrame:
    """A source table as a stream of its files."""
    return (
        landing.spark.readStream.schema(landing.source(name).schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", f"{name}*.parquet")
        .parquet(landing.folder)
    )


def customer_totals(landing: Landing, path: str) -> DataFrame:
    """Totals per customer from the orders file read as a stream."""
    spark = landing.spark
    orders = source_stream(landing, "orders")
    stream = orders.select(
        c.prefixed("CUST-", F.col("o_custkey")).alias("customer_id"),
        F.lit(1).cast("bigint").alias("order_count"),
        c.money(F.col("o_totalprice")).alias("total_spent"),
        c.prefixed("SO-", F.col("o_orderkey")).alias("last_order_id"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("arrival"),
    )
    totals = latest_totals(stream, "customer_id", "arrival", "updated_at", ["order_count", "total_spent"], ["last_order_id"])
    totals = totals.withColumn("total_spent", F.col("total_spent").cast(c.MONEY))
    run_available(log_totals(totals, f"{path}/log"), f"{path}/checkpoint")
    return last_logged(spark, f"{path}/log", ["customer_id"], [])


def event_totals(landing: Landing, path: str) -> DataFrame:
    """Nested order events read as a stream, parsed, and summed per customer."""
    spark = landing.spark
    order_event_json(landing).write.parquet(f"{path}/topic")
    messages = spark.readStream.schema("arrival bigint, value string").option("maxFilesPerTrigger", 64).parquet(f"{path}/topic")
    totals = totals_stream(parse_order_events(messages), "arrival")
    run_available(log_totals(totals, f"{path}/log"), f"{path}/checkpoint")
    return last_logged(spark, f"{path}/log", ["customerId"], [])


def fanned_out(landing: Landing, path: str) -> DataFrame:
    """Nested order events read once as a stream and fanned out; headers and lines put together again per order."""
    spark = landing.spark
    order_event_json(landing).write.parquet(f"{path}/topic")
    messages = spark.readStream.schema("arrival bigint, value string").option("maxFilesPerTrigger", 64).parquet(f"{path}/topic")
    run_available(fan_out(messages, f"{path}/logs"), f"{path}/checkpoint")
    read = lambda name: spark.read.parquet(f"{path}/logs/{name}")
    lines = read("sales_order_line_item").groupBy("orderId").agg(
        F.count("*").alias("lines"), F.sum("lineTotal").cast(c.MONEY).alias("lines_total")
    )
    contributions = read("customer_contribution").groupBy(F.col("lastOrderId").alias("orderId")).agg(F.sum("orderCount").alias("orders"))
    heads = read("sales_order").join(lines, "orderId", "left").join(contributions, "orderId", "left")
    return heads.select("orderId", "customerId", "orderTotal", "lineItemCount", F.coalesce("lines", F.lit(0)).alias("lines"), "lines_total", "orders")


def redelivered_changes(landing: Landing, path: str) -> DataFrame:
    """The change log delivered twice as a stream, reduced to one copy of each change."""
    spark = landing.spark
    sent = changes(landing).select("entity_id", "op", "ts_ms", "position")
    sent.unionByName(sent).write.parquet(f"{path}/topic")
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 64).parquet(f"{path}/topic")
    once = dedupe_stream(stream, ["entity_id"])
    run_available(
        once.writeStream.foreachBatch(lambda batch, i: append_batch(batch, i, f"{path}/log")), f"{path}/checkpoint"
    )
    return spark.read.parquet(f"{path}/log").drop("_ingest_ts", "_batch_id")


def enrich_events(landing: Landing, path: str) -> DataFrame:
    """Events as a stream, joined with the customer table, appended to a log."""
    spark = landing.spark
    events = source_stream(landing, "events")
    customer = landing.source("customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = events.join(customer, events.user_id == customer.c_custkey, "left").select(
        "event_id", "user_id", "event_type", "ts", F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
    )
    run_available(
        joined.writeStream.foreachBatch(lambda batch, batch_id: append_batch(batch, batch_id, f"{path}/log")),
        f"{path}/checkpoint",
    )
    return spark.read.parquet(f"{path}/log").drop("_ingest_ts", "_batch_id")


def customer_changelog(landing: Landing, path: str) -> DataFrame:
    """One running snapshot per order, from the orders file read as a stream."""
    orders = source_stream(landing, "orders")
    customer = landing.source("customer")
    contributions = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        c.prefixed("CUST-", F.col("o_custkey")).alias("customerId"),
        F.col("c_name").alias("customerName"),
        c.email_of(F.col("c_name")).alias("customerEmail"),
        F.col("c_mktsegment").alias("customerSegment"),
        F.lit(1).cast("bigint").alias("orderCount"),
        c.money(F.col("o_totalprice")).alias("totalSpent"),
        c.prefixed("SO-", F.col("o_orderkey")).alias("lastOrderId"),
        F.col("o_orderdate").alias("updatedAt"),
        F.lit("USD").alias("currency"),
        F.col("o_orderkey").alias("arrival"),
    )
    run_available(log_snapshots(snapshots(contributions, "arrival"), f"{path}/log"), f"{path}/checkpoint")
    return landing.spark.read.parquet(f"{path}/log").select(FIELDS)


def change_chain(landing: Landing, path: str) -> DataFrame:
    """Activity as change events: stream to an immutable log, then log to current state."""
    spark = landing.spark
    events = source_stream(landing, "events")
    row = F.struct("user_id", c.money(F.col("value")).alias("value"))
    deleted = F.col("event_type") == "error"
    decoded = events.select(
        F.col("user_id").alias("entity_id"),
        F.when(deleted, "d").otherwise("u").alias("op"),
        c.epoch_ms(F.col("ts")).alias("ts_ms"),
        F.col("event_id").alias("position"),
        F.when(~deleted, row).alias("after"),
    )
    run_available(changes_to_bronze(decoded, f"{path}/log"), f"{path}/checkpoint-log")
    log = spark.readStream.schema(spark.read.parquet(f"{path}/log").schema).parquet(f"{path}/log")
    run_available(bronze_to_current(log, ["entity_id"], f"{path}/last"), f"{path}/checkpoint-last")
    return current_of(spark, ["entity_id"], f"{path}/last").select("entity_id", "ts_ms", "value")


def changes_to_bronze(decoded: DataFrame, path: str):
    """First half of the change chain: an immutable log of decoded changes."""
    return decoded.writeStream.foreachBatch(lambda batch, batch_id: append_batch(batch, batch_id, path))


def bronze_to_current(bronze: DataFrame, keys: list[str], path: str, row: str = "after"):
    """Second half: the last change of each key in a batch, appended to a log of much fewer rows.

    `current_of` reads the state from it; no batch touches what earlier ones wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        known = batch.filter(F.col("op").isin(*cdc.EVERY_OPERATION))
        last = latest_per_key(known, keys, ["ts_ms", "position"])
        append_batch(last.select(*keys, "ts_ms", "position", "op", f"{row}.*"), batch_id, path)

    return bronze.writeStream.foreachBatch(write)


def current_of(spark: SparkSession, keys: list[str], path: str) -> DataFrame:
    """The live row of every key: its last change by (time, position) over all batches, unless that was a delete."""
    return last_logged(spark, path, keys, ["ts_ms", "position"]).filter("op <> 'd'")


def dedupe_stream(
    records: DataFrame, keys: list[str], arrival: str | None = None, keep_for: str = "1 hour"
) -> DataFrame:
    """Drop repeated deliveries that arrive within `keep_for` of the first one.

    State is kept by arrival, not by the time of the change: a change that is new but old by its own
    time, as in a replay, is never dropped. Without an `arrival` column it is the time of the batch.
    """
    timed = records.withColumn("_arrival", F.col(arrival).cast("timestamp") if arrival else F.current_timestamp())
    return (
        timed.withWatermark("_arrival", keep_for)
        .dropDuplicatesWithinWatermark([*keys, "position", "ts_ms"])
        .drop("_arrival")
    )
