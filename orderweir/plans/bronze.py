"""Bronze: landing tables with clean names and types.

Each model is a list of SQL expressions over one landing table, so the same
definition serves a lazy frame and a catalog view. Bronze is never stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Model to (landing table, columns).
MODELS: dict[str, tuple[str, list[str]]] = {
    "stg_sales_order": (
        "sales_order",
        [
            "orderid as order_id",
            "ordertimestamp as order_timestamp",
            "customerid as customer_id",
            "customername as customer_name",
            "customeremail as customer_email",
            "customersegment as customer_segment",
            "currency",
            "cast(ordertotal as decimal(18,2)) as order_total",
            "cast(lineitemcount as int) as line_item_count",
        ],
    ),
    "stg_sales_order_line_item": (
        "sales_order_line_item",
        [
            "orderid as order_id",
            "ordertimestamp as order_timestamp",
            "customerid as customer_id",
            "customername as customer_name",
            "lineitemid as line_item_id",
            "sku",
            "productname as product_name",
            "cast(quantity as int) as quantity",
            "cast(unitprice as decimal(18,2)) as unit_price",
            "cast(linetotal as decimal(18,2)) as line_total",
            "currency",
        ],
    ),
    "stg_customer_sales": (
        "customer_sales",
        [
            "customerid as customer_id",
            "customername as customer_name",
            "customeremail as customer_email",
            "customersegment as customer_segment",
            "cast(ordercount as bigint) as order_count",
            "cast(totalspent as decimal(18,2)) as total_spent",
            "lastorderid as last_order_id",
            "updatedat as updated_at",
            "currency",
        ],
    ),
    "stg_mdm_customer360": (
        "mdm_customer360",
        [
            "customer_id",
            "customer_name",
            "customer_email",
            "customer_segment",
            "currency",
            "first_order_timestamp",
            "last_order_timestamp",
            "cast(projected_order_count as bigint) as projected_order_count",
            "cast(projected_total_spent as decimal(18,2)) as projected_total_spent",
            "projection_updated_at",
            "updated_at",
        ],
    ),
    "stg_mdm_product_master": (
        "mdm_product_master",
        [
            "product_id",
            "product_name",
            "currency",
            "first_seen_at",
            "last_seen_at",
            "cast(orders_count as bigint) as orders_count",
            "cast(units_sold as bigint) as units_sold",
            "cast(avg_unit_price as decimal(18,2)) as avg_unit_price",
            "updated_at",
        ],
    ),
    "stg_mdm_date": (
        "mdm_date",
        [
            "cast(date_key as int) as date_key",
            "full_date as date_day",
            "cast(day_of_month as int) as day_of_month",
            "cast(day_of_week as int) as day_of_week_iso",
            "day_name",
            "cast(week_of_year as int) as week_of_year",
            "cast(month_of_year as int) as month",
            "month_name",
            "cast(quarter_of_year as int) as quarter",
            "cast(year_number as int) as year",
            "is_weekend",
            "created_at",
            "updated_at",
        ],
    ),
}


def stage(model: str, landing: DataFrame) -> DataFrame:
    return landing.selectExpr(*MODELS[model][1])


def view_sql(model: str, view: str, table: str) -> str:
    """The model as a view over a stored landing table."""
    return f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(MODELS[model][1])} FROM {table}"
