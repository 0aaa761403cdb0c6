"""Silver: conformed dimensions and the line-level sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_mdm_customer(stg: DataFrame) -> DataFrame:
    return stg.select(
        "customer_id", "customer_name", "customer_email", "customer_segment", "currency",
        "first_order_timestamp", "last_order_timestamp", "projected_order_count",
        "projected_total_spent", "projection_updated_at", "updated_at",
    )


def dim_mdm_product(stg: DataFrame) -> DataFrame:
    return stg.select(
        "product_id", "product_name", "currency", "first_seen_at", "last_seen_at",
        "orders_count", "units_sold", "avg_unit_price", "updated_at",
    )


def dim_mdm_date(stg: DataFrame) -> DataFrame:
    return stg.select(
        "date_key", "date_day", "year", "quarter", "month", "month_name", "week_of_year",
        "day_of_month", "day_of_week_iso", "day_name", "is_weekend", "created_at", "updated_at",
    )


def fact_sales_order(
    lines: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame, to_store: bool = False
) -> DataFrame:
    """Every order line with its header, customer, product and calendar attributes.

    All joins keep the line. Names fall back from the dimension to the header to
    the line; email and segment have no fallback. No join carries a hint: the
    planner broadcasts a side only below its size limit, and hot customers or
    products in a shuffled join are split by the adaptive planner. The header comes
    first, where lines may lie by order already, and a fallback is settled as soon as both of its
    columns are there, so that the next shuffle carries one of them.

    `to_store` gives the same rows by another order of joins, for a fact that is written: lines move by product, then by
    order, and lie by order in the end, which files and later counts per order gain by. It works on the lines of a
    shuffle in two branches, so it pays where a query runs as a whole and its shuffles are reused.
    """
    joined = _joined_by_order if to_store else _joined
    day = dates.select("date_day", "date_key", "year", "quarter", "month", "month_name", "day_name", "is_weekend")
    return (
        joined(lines, orders, customers, products)
        .withColumn("order_date", F.to_date("order_timestamp"))
        .join(day, F.col("order_date") == F.col("date_day"), "left")
        .select(
            "order_id",
            "line_item_id",
            "order_timestamp",
            "order_date",
            "customer_id",
            "customer_name",
            "customer_email",
            "customer_segment",
            F.col("sku").alias("product_id"),
            "product_name",
            "date_key",
            "year",
            "quarter",
            "month",
            "month_name",
            "day_name",
            "is_weekend",
            "quantity",
            "unit_price",
            "line_total",
            "order_total",
            "line_item_count",
            "currency",
        )
    )


def _joined(lines: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with header, then product, then customer."""
    header = orders.select(
        F.col("order_id").alias("h_order"),
        "order_total",
        "line_item_count",
        F.col("currency").alias("h_currency"),
        F.col("customer_name").alias("h_customer_name"),
    )
    customer = customers.select(
        F.col("customer_id").alias("c_customer"),
        F.col("customer_name").alias("c_customer_name"),
        "customer_email",
        "customer_segment",
    )
    with_header = lines.join(header, F.col("order_id") == F.col("h_order"), "left").withColumns(
        {"customer_name": F.coalesce("h_customer_name", "customer_name"), "currency": F.coalesce("currency", "h_currency")}
    )
    with_product = _with_product(with_header.drop("h_order", "h_customer_name", "h_currency"), products)
    return with_product.join(customer, F.col("customer_id") == F.col("c_customer"), "left").withColumn(
        "customer_name", F.coalesce("c_customer_name", "customer_name")
    )


def _with_product(lines: DataFrame, products: DataFrame) -> DataFrame:
    product = products.select(F.col("product_id").alias("p_product"), F.col("product_name").alias("p_product_name"))
    named = lines.join(product, F.col("sku") == F.col("p_product"), "left")
    return named.withColumn("product_name", F.coalesce("p_product_name", "product_name")).drop("p_product", "p_product_name")


def _joined_by_order(lines: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with product, then header. The header brings its customer's attributes along, so that only a line whose
    customer is not its header's moves once more, to the customers."""
    customer = customers.where("customer_id is not null").select(
        F.col("customer_id").alias("c_customer"),
        F.struct(
            F.col("customer_name").alias("name"), F.col("customer_email").alias("email"), F.col("customer_segment").alias("segment")
        ).alias("master"),
    )
    found = _with_headers(_with_product(lines, products), orders, customer)
    # Both branches name their columns anew: a union keeps the names of its first branch, down to the scans, and unequal
    # plans would not share their shuffles.
    kept = [F.col(name).alias(name) for name in found.columns if name not in {"customer_name", "_found"}]
    settled = lambda rows, master: rows.select(
        *kept,
        F.coalesce(f"{master}.name", "customer_name").alias("customer_name"),
        F.col(f"{master}.email").alias("customer_email"),
        F.col(f"{master}.segment").alias("customer_segment"),
    )
    rest = found.where("not _found.known").join(customer, F.col("customer_id") == F.col("c_customer"), "left")
    rest = rest.withColumn("master", F.coalesce("master", "_found.master"))
    return settled(found.where("_found.known"), "_found.master").unionByName(settled(rest, "master"))


def _with_headers(lines: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Lines with their header, and `_found` (`known`, `master`): a row per master row of the header's customer.

    `known` says that the line's customer is the header's, so that `master` is settled. It comes out of an explode:
    filters on it are not moved below the join, and all who read these rows share the same shuffles.
    """
    masters = customer.groupBy("c_customer").agg(F.collect_list("master").alias("masters"))
    header = orders.select(
        F.col("order_id").alias("h_order"),
        F.col("customer_id").alias("h_customer"),
        "order_total",
        "line_item_count",
        F.col("currency").alias("h_currency"),
        F.col("customer_name").alias("h_customer_name"),
    ).join(masters, F.col("h_customer") == F.col("c_customer"), "left")
    none = F.lit(None).cast(customer.schema["master"].dataType)
    entry = lambda known, master: F.struct(F.lit(known).alias("known"), master.alias("master"))
    known = F.col("h_order").isNotNull() & F.col("customer_id").eqNullSafe(F.col("h_customer"))
    found = F.when(
        known, F.transform(F.coalesce("masters", F.array(none)), lambda master: entry(True, master))
    ).otherwise(F.array(entry(False, none)))
    return lines.join(header, F.col("order_id") == F.col("h_order"), "left").select(
        *[name for name in lines.columns if name not in {"customer_name", "currency"}],
        F.coalesce("h_customer_name", "customer_name").alias("customer_name"),
        F.coalesce("currency", "h_currency").alias("currency"),
        "order_total",
        "line_item_count",
        F.explode(found).alias("_found"),
    )
