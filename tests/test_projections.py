"""Golden rows for the event projections and the wire format."""

import datetime
import json
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from orderweir.functions.envelope import to_messages, unwrap
from orderweir.operators import projections
from orderweir.sources.order_events import order_event_json, parse_order_events


def event(**changes):
    base = {
        "orderId": "SO-1",
        "orderTimestamp": "2026-04-18T09:00:00.250+00:00",
        "currency": "USD",
        "orderTotal": "10.50",
        "customer": {
            "customerId": "CUST-1",
            "firstName": "Ava",
            "lastName": "Chen",
            "email": "a@example.com",
            "segment": "SMB",
        },
        "lineItems": [
            {
                "lineItemId": "SO-1-L1",
                "sku": "SKU-100",
                "productName": "Mouse",
                "quantity": 2,
                "unitPrice": "5.25",
                "lineTotal": "10.50",
            }
        ],
    }
    return json.dumps({**base, **changes})


def events(spark, *texts):
    return parse_order_events(spark.createDataFrame([(text,) for text in texts], "value string"))


def test_header(spark):
    got = projections.sales_orders(events(spark, event())).first()
    assert got.orderTimestamp == datetime.datetime(2026, 4, 18, 9, 0, 0, 250000)
    assert (got.customerName, got.orderTotal, got.lineItemCount) == ("Ava Chen", Decimal("10.50"), 1)


def test_offset_is_turned_into_utc(spark):
    got = projections.sales_orders(events(spark, event(orderTimestamp="2026-04-18T09:00:00+02:00"))).first()
    assert got.orderTimestamp == datetime.datetime(2026, 4, 18, 7, 0)


def test_missing_total_is_zero_in_projections(spark):
    got = projections.sales_orders(events(spark, event(orderTotal=None))).first()
    assert got.orderTotal == Decimal("0.00")


def test_missing_name_part_reads_null(spark):
    customer = json.loads(event())["customer"] | {"lastName": None}
    got = projections.sales_orders(events(spark, event(customer=customer))).first()
    assert got.customerName == "Ava null"


def test_no_lines(spark):
    parsed = events(spark, event(lineItems=[]), event(lineItems=None))
    assert [row.lineItemCount for row in projections.sales_orders(parsed).collect()] == [0, 0]
    assert projections.line_items(parsed).count() == 0


def test_unreadable_event_has_no_columns(spark):
    got = events(spark, "{bad").first()
    assert got.orderId is None and got.customer is None


def test_message_round_trip(spark):
    header = projections.to_wire(projections.sales_orders(events(spark, event())), "sales_order")
    message = to_messages(header, "sales_order").first()
    document = json.loads(message.value)
    assert message.key == "SO-1"
    assert document["schema"]["fields"][1] == {
        "type": "int64",
        "optional": True,
        "name": "org.apache.kafka.connect.data.Timestamp",
        "version": 1,
        "field": "orderTimestamp",
    }
    assert document["payload"]["orderTimestamp"] == 1776502800250
    assert document["payload"]["orderTotal"] == "10.50"


def test_missing_values_do_not_break_the_envelope(spark):
    header = projections.to_wire(projections.sales_orders(events(spark, event(currency=None))), "sales_order")
    assert json.loads(to_messages(header, "sales_order").first().value)["payload"]["currency"] is None


def test_unwrap_wrapped_bare_and_text_payload(spark):
    texts = [
        '{"payload": {"orderId": "SO-1", "orderTotal": "1.00"}}',
        '{"orderId": "SO-2", "orderTotal": "2.00"}',
        '{"orderId": "SO-3", "payload": "note", "orderTotal": "3.00"}',
    ]
    df = spark.createDataFrame([(text,) for text in texts], "value string")
    got = df.select(unwrap(F.col("value"), "sales_order").alias("r")).select("r.orderId", "r.orderTotal")
    assert rows(got) == [("SO-1", "1.00"), ("SO-2", "2.00"), ("SO-3", "3.00")]


def test_lakehouse_rows_keep_missing_amounts_null(spark):
    df = spark.createDataFrame(
        [('{"payload": {"orderId": "SO-1", "orderTotal": null, "orderTimestamp": 1776502800250}}',)], "value string"
    )
    got = projections.to_lakehouse(df, "sales_order").first()
    assert got.order_total is None
    assert got.order_timestamp == datetime.datetime(2026, 4, 18, 9, 0, 0, 250000)


def test_keyless_records_are_dropped(spark):
    df = spark.createDataFrame(
        [
            ("sales_order", '{"payload": {"orderId": "SO-1"}}'),
            ("sales_order", '{"payload": {"orderId": ""}}'),
            ("sales_order", '{"payload": {"orderId": null}}'),
            ("customer_sales", '{"customerId": "CUST-1"}'),
            ("other", '{"orderId": "SO-9"}'),
        ],
        "topic string, value string",
    )
    got = projections.drop_keyless(df).select("topic", "merge_key")
    assert rows(got) == [("customer_sales", "CUST-1"), ("sales_order", "SO-1")]


def test_large_orders_travel_in_parts(landing):
    """With a tiny limit many orders are split, and no line or total is lost or doubled."""
    whole = parse_order_events(order_event_json(landing))
    split = parse_order_events(order_event_json(landing, lines_per_message=4))
    assert split.count() > whole.count()
    lines = lambda df: rows(projections.line_items(df).select("lineItemId", "sku", "lineTotal"))
    assert lines(split) == lines(whole)
    total = lambda df: projections.sales_orders(df).agg(F.sum("orderTotal")).first()[0]
    assert total(split) == total(whole)
    headers = lambda df: rows(projections.sales_orders(df))
    assert headers(split) == headers(whole) and len(headers(split)) == landing.source("orders").join(
        landing.source("customer"), F.col("o_custkey") == F.col("c_custkey")).count()
    counted = lambda df: projections.customer_contributions(df).agg(F.sum("orderCount")).first()[0]
    assert counted(split) == counted(whole) == len(headers(whole))


def test_no_task_puts_more_events_together_than_its_lines(spark, landing, monkeypatch):
    """More lines than the shuffle partitions may hold: more tasks, the same events."""
    text = lambda df: sorted((e.orderId, e.part, e.lineCount, sorted(map(str, e.lineItems or []))) for e in df.collect())
    whole = text(parse_order_events(order_event_json(landing)))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    monkeypatch.setattr("orderweir.sources.order_events.LINES_PER_TASK", 400)
    try:
        made = order_event_json(landing)
        assert made.rdd.getNumPartitions() > landing.source("lineitem").count() // 400
        assert text(parse_order_events(made)) == whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
