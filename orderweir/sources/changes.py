"""Change events in the before/after envelope, derived from the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir import schemas
from orderweir.functions import columns as c
from orderweir.sources.landing import Landing

ROW = "struct<user_id:bigint, value:string, k:int>"

# Kind of activity to change operation, and the table it is captured from.
OPERATIONS = {"signup": "c", "view": "r", "click": "u", "purchase": "u", "error": "d"}


def lookup(column, pairs: dict[str, str]):
    entries = [F.lit(text) for pair in pairs.items() for text in pair]
    return F.create_map(*entries)[column]


def change_messages(landing: Landing, topic_of: dict[str, str] | None = None) -> DataFrame:
    """`(topic, key, value)` messages with the envelope as JSON, one per activity row.

    `topic_of` maps the activity to its source topic; by default all rows come
    from the customer table.
    """
    events = landing.source("events")
    row = F.struct(
        F.col("user_id"),
        c.plain_text(c.money(F.col("value"))).alias("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    deleted = F.col("event_type") == "error"
    if topic_of:
        topic = lookup(F.col("event_type"), topic_of)
    else:
        topic = F.lit("mdm_mysql.mdm.customer360")
    return events.select(
        topic.alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        F.to_json(
            F.struct(
                F.when(deleted, row).alias("before"),
                F.when(~deleted, row).alias("after"),
                lookup(F.col("event_type"), OPERATIONS).alias("op"),
                c.epoch_ms(F.col("ts")).alias("ts_ms"),
                F.struct(
                    F.lit("mdm").alias("db"),
                    F.lit("public").alias("schema"),
                    F.lit("customer360").alias("table"),
                    F.col("event_id").alias("lsn"),
                ).alias("source"),
            )
        ).alias("value"),
    )


def parse_changes(messages: DataFrame, row: str = ROW) -> DataFrame:
    """Envelope columns of each message, wrapped in `{schema, payload}` or bare.

    Empty messages (tombstones) are dropped.
    """
    others = [name for name in messages.columns if name != "value"]
    envelope = schemas.cdc_envelope(row)
    message = F.from_json("value", f"payload struct<{envelope}>, {envelope}")
    parsed = c.parsed_once(messages.filter(F.col("value").isNotNull()), message, "message", others)
    bare = F.struct(*[F.col(f"message.{name}") for name in ("before", "after", "op", "ts_ms", "source")])
    return parsed.select(*others, F.coalesce("message.payload", bare).alias("change")).select(*others, "change.*")


def changes(landing: Landing) -> DataFrame:
    """Decoded change events of the captured topics, with the log position as a column."""
    return (
        parse_changes(change_messages(landing).filter(F.col("topic").isin(*schemas.CDC_TOPICS)))
        .withColumn("position", F.col("source.lsn"))
        .withColumn("entity_id", F.coalesce(F.col("after.user_id"), F.col("before.user_id")))
    )
