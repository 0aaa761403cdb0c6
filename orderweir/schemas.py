"""Record shapes that cross a boundary: raw events, topic payloads, CDC envelopes, tables.

The field names and types are fixed values of the data model.
"""

from __future__ import annotations

# ---- raw order event: money and time are text on the wire -------------------
RAW_ORDER = """
orderId string, part int, lineCount int, orderTimestamp string, currency string, orderTotal string,
customer struct<customerId:string, firstName:string, lastName:string, email:string, segment:string>,
lineItems array<struct<lineItemId:string, sku:string, productName:string,
                       quantity:int, unitPrice:string, lineTotal:string>>
"""

# ---- topic payloads: (field, wire type, lakehouse column, lakehouse type) ----
TIMESTAMP_MS = "timestamp-ms"

PAYLOADS = {
    "sales_order": [
        ("orderId", "string", "order_id", "string"),
        ("orderTimestamp", TIMESTAMP_MS, "order_timestamp", "timestamp"),
        ("customerId", "string", "customer_id", "string"),
        ("customerName", "string", "customer_name", "string"),
        ("customerEmail", "string", "customer_email", "string"),
        ("customerSegment", "string", "customer_segment", "string"),
        ("currency", "string", "currency", "string"),
        ("orderTotal", "string", "order_total", "decimal(18,2)"),
        ("lineItemCount", "int32", "line_item_count", "int"),
    ],
    "sales_order_line_item": [
        ("orderId", "string", "order_id", "string"),
        ("orderTimestamp", TIMESTAMP_MS, "order_timestamp", "timestamp"),
        ("customerId", "string", "customer_id", "string"),
        ("customerName", "string", "customer_name", "string"),
        ("lineItemId", "string", "line_item_id", "string"),
        ("sku", "string", "sku", "string"),
        ("productName", "string", "product_name", "string"),
        ("quantity", "int32", "quantity", "int"),
        ("unitPrice", "string", "unit_price", "decimal(18,2)"),
        ("lineTotal", "string", "line_total", "decimal(18,2)"),
        ("currency", "string", "currency", "string"),
    ],
    "customer_sales": [
        ("customerId", "string", "customer_id", "string"),
        ("customerName", "string", "customer_name", "string"),
        ("customerEmail", "string", "customer_email", "string"),
        ("customerSegment", "string", "customer_segment", "string"),
        ("orderCount", "int64", "order_count", "bigint"),
        ("totalSpent", "string", "total_spent", "decimal(18,2)"),
        ("lastOrderId", "string", "last_order_id", "string"),
        ("updatedAt", TIMESTAMP_MS, "updated_at", "timestamp"),
        ("currency", "string", "currency", "string"),
    ],
}

# Field that identifies a record of each topic.
TOPIC_KEYS = {
    "sales_order": "orderId",
    "sales_order_line_item": "lineItemId",
    "customer_sales": "customerId",
}

# Record names in the self-describing envelope.
ENVELOPE_NAMES = {
    "sales_order": "com.example.realtime.SalesOrderProjection",
    "sales_order_line_item": "com.example.realtime.SalesOrderLineItemProjection",
    "customer_sales": "com.example.realtime.CustomerSalesProjection",
}

_SPARK_WIRE = {"string": "string", "int32": "int", "int64": "bigint", TIMESTAMP_MS: "bigint"}


def payload_ddl(topic: str) -> str:
    """The payload of a topic as a Spark schema string, wire types."""
    return ", ".join(f"{field} {_SPARK_WIRE[wire]}" for field, wire, _, _ in PAYLOADS[topic])


def lakehouse_columns(topic: str) -> list[str]:
    return [column for _, _, column, _ in PAYLOADS[topic]]


def lakehouse_key(topic: str) -> str:
    return next(column for field, _, column, _ in PAYLOADS[topic] if field == TOPIC_KEYS[topic])


# ---- change events ----------------------------------------------------------
def cdc_envelope(row: str) -> str:
    """Change envelope around a row struct, e.g. `struct<user_id:bigint, value:string>`."""
    return (
        f"before {row}, after {row}, op string, ts_ms bigint, "
        "source struct<db:string, schema:string, `table`:string, lsn:bigint>"
    )


# Source topics that are captured, and the curated topic each one feeds.
CDC_TOPICS = {
    "mdm_mysql.mdm.customer360": "mdm_customer",
    "mdm_mysql.mdm.product_master": "mdm_product",
}

# ---- layers -----------------------------------------------------------------
LAYERS = ("landing", "bronze", "silver", "gold")

# Landing tables as declared, used for create-if-absent and for drift checks.
LANDING = {
    "sales_order": (
        "orderid string, ordertimestamp timestamp, customerid string, customername string, "
        "customeremail string, customersegment string, currency string, "
        "ordertotal decimal(18,2), lineitemcount int"
    ),
    "sales_order_line_item": (
        "orderid string, ordertimestamp timestamp, customerid string, customername string, "
        "lineitemid string, sku string, productname string, quantity int, "
        "unitprice decimal(18,2), linetotal decimal(18,2), currency string"
    ),
    "customer_sales": (
        "customerid string, customername string, customeremail string, customersegment string, "
        "ordercount bigint, totalspent decimal(18,2), lastorderid string, updatedat timestamp, "
        "currency string"
    ),
    "mdm_customer360": (
        "customer_id string, customer_name string, customer_email string, customer_segment string, "
        "currency string, first_order_timestamp timestamp, last_order_timestamp timestamp, "
        "projected_order_count int, projected_total_spent decimal(18,2), "
        "projection_updated_at timestamp, updated_at timestamp"
    ),
    "mdm_product_master": (
        "product_id string, product_name string, currency string, first_seen_at timestamp, "
        "last_seen_at timestamp, orders_count int, units_sold int, "
        "avg_unit_price decimal(18,2), updated_at timestamp"
    ),
    "mdm_date": (
        "date_key int, full_date date, day_of_month int, day_of_week int, day_name string, "
        "week_of_year int, month_of_year int, month_name string, quarter_of_year int, "
        "year_number int, is_weekend boolean, created_at timestamp, updated_at timestamp"
    ),
}
