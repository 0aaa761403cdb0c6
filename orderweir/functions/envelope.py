"""The self-describing `{schema, payload}` message around a topic record."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweir import schemas


def schema_document(topic: str) -> str:
    """The constant `schema` half of the envelope, compact JSON."""
    fields = []
    for field, wire, _, _ in schemas.PAYLOADS[topic]:
        if wire == schemas.TIMESTAMP_MS:
            fields.append(
                {
                    "type": "int64",
                    "optional": True,
                    "name": "org.apache.kafka.connect.data.Timestamp",
                    "version": 1,
                    "field": field,
                }
            )
        else:
            fields.append({"type": wire, "optional": True, "field": field})
    document = {
        "type": "struct",
        "optional": False,
        "name": schemas.ENVELOPE_NAMES[topic],
        "fields": fields,
    }
    return json.dumps(document, separators=(",", ":"))


def payload_json(topic: str) -> Column:
    """The record's wire fields as JSON; declared-optional fields are written as null."""
    fields = [F.col(field) for field, _, _, _ in schemas.PAYLOADS[topic]]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_messages(records: DataFrame, topic: str, *keep: str) -> DataFrame:
    """Wire-typed records to `(topic, key, value)`, keyed by the business key, and columns to keep.

    The schema half is the same text in every message, so it is a literal and
    only the payload is rendered per row.
    """
    head = '{"schema":' + schema_document(topic) + ',"payload":'
    return records.select(
        F.lit(topic).alias("topic"),
        F.col(schemas.TOPIC_KEYS[topic]).alias("key"),
        F.concat(F.lit(head), payload_json(topic), F.lit("}")).alias("value"),
        *keep,
    )


def unwrap(value: Column, topic: str) -> Column:
    """The record inside a message: its payload if that is an object, else the message itself."""
    fields = schemas.payload_ddl(topic)
    message = F.from_json(value, f"payload struct<{fields}>, {fields}")
    bare = F.struct(*[message[field].alias(field) for field, _, _, _ in schemas.PAYLOADS[topic]])
    return F.coalesce(message["payload"], bare)
