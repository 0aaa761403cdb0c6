"""Nested order events: built from flat tables, read back from JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweir import schemas
from orderweir.functions import columns as c
from orderweir.sources.landing import Landing, line_item_id

# An event has to fit one broker message; larger orders are sent in parts.
LINES_PER_MESSAGE = 1000
# Lines whose events one task puts together; beyond that per shuffle partition there are more partitions, and so files.
LINES_PER_TASK = 400_000


def order_event_json(landing: Landing, lines_per_message: int | None = None) -> DataFrame:
    """JSON order events: `(arrival, value)`.

    Every event names its `part` of the order and the order's `lineCount`. An order has a part
    per `lines_per_message` lines, which a hash of the line spreads over them; part 0 always
    exists. Whoever counts orders takes part 0, whoever reads lines takes all parts.
    Lines move while they are a few numbers, and then once by order and part, over so many tasks that
    none grows with the table.
    """
    limit = lines_per_message or LINES_PER_MESSAGE
    line = landing.source("lineitem")
    part = landing.source("part")
    tasks = line.count() // LINES_PER_TASK + 1
    usual = int(landing.spark.conf.get("spark.sql.shuffle.partitions"))
    moved = lambda df, *keys: df.repartition(tasks, *keys) if tasks > usual else df
    counts = line.groupBy(F.col("l_orderkey").alias("key")).agg(F.count("*").alias("line_count"))
    parts = F.expr(f"1 + (line_count - 1) div {limit}")
    spread = F.pmod(F.xxhash64("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"), parts)
    lines = line.join(counts, line.l_orderkey == counts.key).join(part, line.l_partkey == part.p_partkey).select(
        "key",
        spread.alias("part"),
        F.struct(
            line_item_id().alias("lineItemId"),
            c.prefixed("SKU-", F.col("l_partkey")).alias("sku"),
            F.col("p_name").alias("productName"),
            F.col("l_quantity").cast("int").alias("quantity"),
            c.plain_text(c.money(F.col("p_retailprice"))).alias("unitPrice"),
            c.plain_text(c.money(F.col("l_extendedprice"))).alias("lineTotal"),
        ).alias("line"),
    )
    packed = moved(lines, "key", "part").groupBy("key", "part").agg(F.collect_list("line").alias("lineItems"))
    every_part = counts.select("key", "line_count", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("part"))
    orders = landing.source("orders")
    customer = landing.source("customer")
    name = F.split(F.col("c_name"), "#")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(every_part, F.col("o_orderkey") == F.col("key"), "left")
        .withColumns({"key": F.col("o_orderkey"), "part": F.coalesce("part", F.lit(0))})
        .join(packed, ["key", "part"], "left")
        .select(
            F.col("o_orderkey").alias("arrival"),
            F.to_json(
                F.struct(
                    c.prefixed("SO-", F.col("o_orderkey")).alias("orderId"),
                    F.col("part").cast("int").alias("part"),
                    F.coalesce("line_count", F.lit(0)).cast("int").alias("lineCount"),
                    c.iso_text(F.col("o_orderdate")).alias("orderTimestamp"),
                    F.lit("USD").alias("currency"),
                    c.plain_text(c.money(F.col("o_totalprice"))).alias("orderTotal"),
                    F.struct(
                        c.prefixed("CUST-", F.col("o_custkey")).alias("customerId"),
                        name[0].alias("firstName"),
                        name[1].alias("lastName"),
                        c.email_of(F.col("c_name")).alias("email"),
                        F.col("c_mktsegment").alias("segment"),
                    ).alias("customer"),
                    F.col("lineItems"),
                )
            ).alias("value"),
        )
    )


def is_header() -> Column:
    """True for the one event of an order that stands for it; events without parts are whole orders."""
    return F.coalesce(F.col("part"), F.lit(0)) == 0


def parse_order_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to typed event columns; works on a batch and on a stream.

    Other columns of the message (arrival, topic, offset) are kept. A record that
    is no JSON object has null in every event column.
    """
    others = [name for name in messages.columns if name != value]
    parsed = messages.select(*others, F.from_json(F.col(value), schemas.RAW_ORDER).alias("event"))
    return parsed.select(*others, "event.*")


def event_time() -> Column:
    return c.parse_iso(F.col("orderTimestamp"))
