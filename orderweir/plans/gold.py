"""Gold: customer sales summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.functions.columns import MONEY
from orderweir.operators.latest import latest_per_key


def fact_rollup(fact: DataFrame) -> DataFrame:
    """Fact figures per customer.

    For the two distinct counts Spark first groups by (customer, order) and
    (customer, product), so a customer with very many lines is spread over all
    tasks until the last, already combined step. The largest month name comes from a bit per
    month: a text maximum would turn the whole aggregate into a sorting one.
    """
    month_names = [F.date_format(F.make_date(F.lit(2000), F.lit(m), F.lit(1)), "MMMM") for m in range(1, 13)]
    largest = F.greatest(
        *[F.when(F.col("months").bitwiseAND(1 << m) != 0, name) for m, name in enumerate(month_names, 1)]
    )
    figures = fact.groupBy("customer_id").agg(
        F.sum("line_total").cast(MONEY).alias("recomputed_total_from_line_items"),
        F.count("*").alias("total_line_items"),
        F.count_distinct("product_id").alias("distinct_products_purchased"),
        F.count_distinct("order_id").alias("observed_orders"),
        F.max("order_timestamp").alias("last_order_timestamp"),
        F.max("date_key").alias("last_order_date_key"),
        F.max("year").alias("last_order_year"),
        F.max("quarter").alias("last_order_quarter"),
        F.max("month").alias("last_order_month"),
        F.bool_or(F.coalesce("is_weekend", F.lit(False))).alias("has_weekend_orders"),
        F.max("order_timestamp").alias("last_line_item_timestamp"),
        F.bit_or(F.expr("shiftleft(1, month)")).alias("months"),
    )
    return figures.withColumn("last_order_month_name", largest).drop("months")


def customer_sales_summary(snapshots: DataFrame, customers: DataFrame, rollup: DataFrame) -> DataFrame:
    """Every customer snapshot with master data and fact figures beside it.

    One row per snapshot: feed the changelog for the full history, or one
    snapshot per customer (`latest_snapshots`) for a current summary.
    """
    master = customers.select(
        F.col("customer_id").alias("m_customer"),
        *[
            F.col(name).alias(f"m_{name}")
            for name in (
                "customer_name", "customer_email", "customer_segment", "currency",
                "projected_order_count", "projected_total_spent", "projection_updated_at", "updated_at",
            )
        ],
    )
    figures = rollup.withColumnRenamed("customer_id", "f_customer")
    zero = F.lit(0)
    return (
        snapshots.join(master, F.col("customer_id") == F.col("m_customer"), "left")
        .join(figures, F.col("customer_id") == F.col("f_customer"), "left")
        .select(
            "customer_id",
            F.coalesce("m_customer_name", "customer_name").alias("customer_name"),
            F.coalesce("m_customer_email", "customer_email").alias("customer_email"),
            F.coalesce("m_customer_segment", "customer_segment").alias("customer_segment"),
            F.coalesce("m_currency", "currency").alias("currency"),
            F.coalesce("m_projected_order_count", "order_count").alias("latest_order_count"),
            F.coalesce("m_projected_total_spent", "total_spent").cast(MONEY).alias("latest_total_spent"),
            F.coalesce("recomputed_total_from_line_items", zero).cast(MONEY).alias("recomputed_total_from_line_items"),
            F.coalesce("total_line_items", zero).alias("total_line_items"),
            F.coalesce("distinct_products_purchased", zero).alias("distinct_products_purchased"),
            F.coalesce("observed_orders", zero).alias("observed_orders"),
            "last_order_timestamp",
            "last_order_date_key",
            "last_order_year",
            "last_order_quarter",
            "last_order_month",
            "last_order_month_name",
            F.coalesce("has_weekend_orders", F.lit(False)).alias("has_weekend_orders"),
            F.coalesce("m_projection_updated_at", "updated_at").alias("projection_updated_at"),
            "last_line_item_timestamp",
            F.col("m_updated_at").alias("mdm_customer_updated_at"),
        )
    )


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The newest snapshot of each customer; the one with most orders counted on equal times."""
    return latest_per_key(snapshots, ["customer_id"], ["updated_at", "order_count"])


def line_item_rollup(lines: DataFrame) -> DataFrame:
    return lines.groupBy("customer_id").agg(
        F.sum("line_total").cast(MONEY).alias("line_item_total"),
        F.count("*").alias("total_line_items"),
        F.max("order_timestamp").alias("last_line_item_at"),
    )


def customer_sales_summary_by_max(snapshots: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per customer with the largest value of every snapshot column.

    Snapshots and orders are aggregated apart and then joined: joining them first
    would multiply the two per customer without changing any of these results.
    """
    largest = snapshots.groupBy("customer_id").agg(
        F.max("customer_name").alias("customer_name"),
        F.max("customer_email").alias("customer_email"),
        F.max("customer_segment").alias("customer_segment"),
        F.max("currency").alias("currency"),
        F.max("order_count").alias("latest_order_count"),
        F.max("total_spent").alias("latest_total_spent"),
        F.max("updated_at").alias("projection_updated_at"),
    )
    observed = orders.groupBy(F.col("customer_id").alias("o_customer")).agg(
        F.count_distinct("order_id").alias("observed_orders"), F.max("order_timestamp").alias("last_order_timestamp")
    )
    rollup = line_item_rollup(lines).withColumnRenamed("customer_id", "l_customer")
    return (
        largest.join(observed, F.col("customer_id") == F.col("o_customer"), "left")
        .join(rollup, F.col("customer_id") == F.col("l_customer"), "left")
        .select(
            "customer_id",
            "customer_name",
            "customer_email",
            "customer_segment",
            "currency",
            "latest_order_count",
            "latest_total_spent",
            F.coalesce("line_item_total", F.lit(0)).cast(MONEY).alias("recomputed_total_from_line_items"),
            F.coalesce("total_line_items", F.lit(0)).alias("total_line_items"),
            F.coalesce("observed_orders", F.lit(0)).alias("observed_orders"),
            "last_order_timestamp",
            "projection_updated_at",
            F.col("last_line_item_at").alias("last_line_item_timestamp"),
        )
    )
