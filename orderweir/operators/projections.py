"""Order events to header, line and customer records, and between wire and lakehouse types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweir import schemas
from orderweir.functions import columns as c
from orderweir.functions.envelope import unwrap
from orderweir.sources.order_events import event_time, is_header


def sales_orders(events: DataFrame) -> DataFrame:
    """One header row per order; a missing total is 0 and missing lines count as none."""
    return events.filter(is_header()).select(
        "orderId",
        event_time().alias("orderTimestamp"),
        F.col("customer.customerId").alias("customerId"),
        c.full_name(F.col("customer.firstName"), F.col("customer.lastName")).alias("customerName"),
        F.col("customer.email").alias("customerEmail"),
        F.col("customer.segment").alias("customerSegment"),
        "currency",
        c.money_or_zero(F.col("orderTotal")).alias("orderTotal"),
        F.coalesce("lineCount", c.array_size(F.col("lineItems"))).alias("lineItemCount"),
    )


def line_items(events: DataFrame) -> DataFrame:
    """One row per line with its order's columns; events without lines give none."""
    return events.select("*", F.explode("lineItems").alias("line")).select(
        "orderId",
        event_time().alias("orderTimestamp"),
        F.col("customer.customerId").alias("customerId"),
        c.full_name(F.col("customer.firstName"), F.col("customer.lastName")).alias("customerName"),
        F.col("line.lineItemId").alias("lineItemId"),
        F.col("line.sku").alias("sku"),
        F.col("line.productName").alias("productName"),
        F.coalesce(F.col("line.quantity"), F.lit(0)).alias("quantity"),
        c.money_or_zero(F.col("line.unitPrice")).alias("unitPrice"),
        c.money_or_zero(F.col("line.lineTotal")).alias("lineTotal"),
        "currency",
    )


def customer_contributions(events: DataFrame, *keep: str) -> DataFrame:
    """What one order adds to its customer's totals."""
    return events.filter(is_header()).select(
        F.col("customer.customerId").alias("customerId"),
        c.full_name(F.col("customer.firstName"), F.col("customer.lastName")).alias("customerName"),
        F.col("customer.email").alias("customerEmail"),
        F.col("customer.segment").alias("customerSegment"),
        F.lit(1).cast("bigint").alias("orderCount"),
        c.money_or_zero(F.col("orderTotal")).alias("totalSpent"),
        F.col("orderId").alias("lastOrderId"),
        event_time().alias("updatedAt"),
        "currency",
        *keep,
    )


# Inputs of the running-total operators for contributions.
CUSTOMER_SUMS = ["orderCount", "totalSpent"]
CUSTOMER_LATEST = ["customerName", "customerEmail", "customerSegment", "lastOrderId", "currency"]


def to_wire(records: DataFrame, topic: str, *keep: str) -> DataFrame:
    """Typed records to wire types: times as epoch milliseconds, amounts as plain text."""
    types = dict(records.dtypes)
    columns = []
    for field, wire, _, _ in schemas.PAYLOADS[topic]:
        value = F.col(field)
        if wire == schemas.TIMESTAMP_MS:
            value = c.epoch_ms(value)
        elif types[field].startswith("decimal"):
            value = c.plain_text(value)
        columns.append(value.alias(field))
    return records.select(*columns, *keep)


def to_lakehouse(messages: DataFrame, topic: str, *keep: str) -> DataFrame:
    """Messages of one topic to typed lakehouse rows; missing amounts stay null."""
    rows = c.parsed_once(messages, unwrap(F.col("value"), topic), "record", list(keep))
    columns = []
    for field, wire, column, kind in schemas.PAYLOADS[topic]:
        value = F.col("record")[field]
        if wire == schemas.TIMESTAMP_MS:
            value = c.from_epoch_ms(value)
        elif kind.startswith("decimal"):
            value = value.try_cast(kind)
        columns.append(value.alias(column))
    return rows.select(*keep, *columns)


def message_key(topic: Column, value: Column) -> Column:
    """The merge key of a message, by topic; null for unknown topics. The text is parsed once."""
    fields = ", ".join(f"{name} string" for name in dict.fromkeys(schemas.TOPIC_KEYS.values()))
    record = F.from_json(value, f"{fields}, payload struct<{fields.replace(' string', ': string')}>")

    key = lambda r: F.coalesce(*[
        F.when(topic == name, F.when(r["payload"].isNotNull(), r["payload"][field]).otherwise(r[field]))
        for name, field in schemas.TOPIC_KEYS.items()
    ])
    return F.transform(F.array(record), key)[0]


def drop_keyless(messages: DataFrame) -> DataFrame:
    """Only records of known topics that carry their merge key, with it as `merge_key`."""
    keyed = messages.withColumn("merge_key", message_key(F.col("topic"), F.col("value")))
    return keyed.filter(c.has_key(F.col("merge_key")))
