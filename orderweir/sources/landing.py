"""Landing tables derived from the star-schema parquet files.

A deployment reads its landing tables with `spark.table`; here the same columns
are derived from orders, line items, customers and parts. Every frame covers its
whole source tables. Three things make the data realistic without any sampling:

* order keys give the arrival order and order dates the event time, so many
  events arrive late;
* customers with a negative balance and promotional parts are not in the master
  tables, so dimension lookups miss;
* the calendar spans first to last shipment, so the earliest orders have no day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderweir.functions import columns as c
from orderweir.functions.calendar import calendar_between
from orderweir.operators.running import latest_totals, running_totals

_TOTALS = {
    "key": "customerid",
    "arrival": "arrival",
    "event_time": "updatedat",
    "sums": ["ordercount", "totalspent"],
    "latest": ["customername", "customeremail", "customersegment", "lastorderid", "currency"],
}


class Landing:
    """The landing layer as lazy frames over one folder of source tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- orders ---------------------------------------------------------
    def orders_with_customer(self) -> DataFrame:
        orders = self.source("orders")
        customer = self.source("customer")
        return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
            c.prefixed("SO-", F.col("o_orderkey")).alias("orderid"),
            F.col("o_orderdate").alias("ordertimestamp"),
            c.prefixed("CUST-", F.col("o_custkey")).alias("customerid"),
            F.col("c_name").alias("customername"),
            c.email_of(F.col("c_name")).alias("customeremail"),
            F.col("c_mktsegment").alias("customersegment"),
            F.lit("USD").alias("currency"),
            c.money(F.col("o_totalprice")).alias("ordertotal"),
            F.col("o_orderkey").alias("arrival"),
            F.col("o_orderstatus").alias("status"),
        )

    def sales_order_arrivals(self) -> DataFrame:
        """`sales_order` plus its arrival position and order status."""
        counts = (
            self.source("lineitem").groupBy(F.col("l_orderkey").alias("arrival")).agg(F.count("*").alias("lines"))
        )
        return (
            self.orders_with_customer()
            .join(counts, "arrival", "left")
            .withColumn("lineitemcount", F.coalesce(F.col("lines"), F.lit(0)).cast("int"))
            .drop("lines")
        )

    def sales_order(self) -> DataFrame:
        return self.sales_order_arrivals().select(
            "orderid", "ordertimestamp", "customerid", "customername", "customeremail",
            "customersegment", "currency", "ordertotal", "lineitemcount",
        )

    # ---- lines ----------------------------------------------------------
    def line_arrivals(self, by_product: bool = False) -> DataFrame:
        """`sales_order_line_item` plus ship date, part key and status.

        The line id repeats in the source, `(ship date, part key)` orders the
        versions of one id. Parts are joined while a line is a few numbers, and orders
        bring their customer along, so a line moves twice. The last join is by the order's own
        id: a join by it that follows finds the lines in place. With `by_product` orders are joined first
        and the last join is by the product's own id.
        """
        line = self.source("lineitem")
        orders = self.source("orders")
        customer = self.source("customer")
        part = self.source("part")
        of_customer = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
            c.prefixed("SO-", F.col("o_orderkey")).alias("orderid"), "o_orderkey", "o_orderdate", "o_custkey", "c_name"
        )
        sku = c.prefixed("SKU-", F.col("l_partkey"))
        if by_product:
            of_order = line.join(of_customer, line.l_orderkey == of_customer.o_orderkey).drop("orderid").withColumn("sku", sku)
            product = part.select(c.prefixed("SKU-", F.col("p_partkey")).alias("sku"), "p_name", "p_retailprice")
            joined = of_order.join(product, "sku").withColumn("orderid", c.prefixed("SO-", F.col("l_orderkey")))
        else:
            of_part = line.join(part, line.l_partkey == part.p_partkey).select(
                c.prefixed("SO-", F.col("l_orderkey")).alias("orderid"),
                "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_linestatus", "p_name", "p_retailprice",
            )
            joined = of_part.join(of_customer, "orderid").withColumn("sku", sku)
        return joined.select(
            "orderid",
            F.col("o_orderdate").alias("ordertimestamp"),
            c.prefixed("CUST-", F.col("o_custkey")).alias("customerid"),
            F.col("c_name").alias("customername"),
            F.concat("orderid", F.lit("-L"), F.col("l_linenumber").cast("string")).alias("lineitemid"),
            "sku",
            F.col("p_name").alias("productname"),
            F.col("l_quantity").cast("int").alias("quantity"),
            c.money(F.col("p_retailprice")).alias("unitprice"),
            c.money(F.col("l_extendedprice")).alias("linetotal"),
            F.lit("USD").alias("currency"),
            F.col("l_shipdate").alias("shipped_at"),
            F.col("l_partkey").alias("position"),
            F.col("l_linestatus").alias("status"),
        )

    def sales_order_line_item(self, by_product: bool = False) -> DataFrame:
        return self.line_arrivals(by_product).drop("shipped_at", "position", "status")

    # ---- customer changelog ---------------------------------------------
    def contributions(self) -> DataFrame:
        """What each order adds to its customer."""
        return self.orders_with_customer().select(
            "customerid", "customername", "customeremail", "customersegment", "currency",
            F.col("orderid").alias("lastorderid"),
            F.col("ordertimestamp").alias("updatedat"),
            F.lit(1).cast("bigint").alias("ordercount"),
            F.col("ordertotal").alias("totalspent"),
            "arrival",
            "status",
        )

    def customer_sales_latest(self) -> DataFrame:
        """The last snapshot of each customer, without building the others."""
        last = latest_totals(self.contributions(), **_TOTALS)
        return last.withColumn("totalspent", F.col("totalspent").cast(c.MONEY)).select(
            "customerid", "customername", "customeremail", "customersegment", "ordercount", "totalspent",
            "lastorderid", "updatedat", "currency",
        )

    def customer_sales_arrivals(self) -> DataFrame:
        """One running snapshot per order event, in arrival order, plus arrival and status."""
        running = running_totals(self.contributions(), **_TOTALS)
        return running.select(
            "customerid", "customername", "customeremail", "customersegment",
            F.col("ordercount").cast("bigint").alias("ordercount"),
            F.col("totalspent").cast(c.MONEY).alias("totalspent"),
            "lastorderid", "updatedat", "currency", "arrival", "status",
        )

    def customer_sales(self) -> DataFrame:
        return self.customer_sales_arrivals().drop("arrival", "status")

    # ---- master data ----------------------------------------------------
    def customer_profiles(self, orders: DataFrame | None = None) -> DataFrame:
        """Every customer with the figures of the given orders (all orders by default)."""
        orders = self.source("orders") if orders is None else orders
        stats = orders.groupBy("o_custkey").agg(
            F.min("o_orderdate").alias("first_order_timestamp"),
            F.max("o_orderdate").alias("last_order_timestamp"),
            F.count("*").alias("n"),
            F.sum(c.money(F.col("o_totalprice"))).alias("spent"),
        )
        customer = self.source("customer")
        return customer.join(stats, customer.c_custkey == stats.o_custkey, "left").select(
            c.prefixed("CUST-", F.col("c_custkey")).alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            c.email_of(F.col("c_name")).alias("customer_email"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.lit("USD").alias("currency"),
            "first_order_timestamp",
            "last_order_timestamp",
            F.coalesce(F.col("n"), F.lit(0)).cast("int").alias("projected_order_count"),
            c.money_or_zero(F.col("spent")).alias("projected_total_spent"),
            F.col("last_order_timestamp").alias("projection_updated_at"),
            F.col("last_order_timestamp").alias("updated_at"),
            F.col("c_acctbal").alias("balance"),
        )

    def mdm_customer360(self) -> DataFrame:
        return self.customer_profiles().filter("balance >= 0").drop("balance")

    def product_profiles(self, lines: DataFrame | None = None) -> DataFrame:
        """Every part with the figures of the given lines (all lines by default)."""
        lines = self.source("lineitem") if lines is None else lines
        stats = lines.groupBy("l_partkey").agg(
            F.min("l_shipdate").alias("first_seen_at"),
            F.max("l_shipdate").alias("last_seen_at"),
            F.count_distinct("l_orderkey").alias("n"),
            F.sum(F.col("l_quantity").cast("int")).alias("units"),
        )
        part = self.source("part")
        return part.join(stats, part.p_partkey == stats.l_partkey, "left").select(
            c.prefixed("SKU-", F.col("p_partkey")).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.lit("USD").alias("currency"),
            "first_seen_at",
            "last_seen_at",
            F.coalesce(F.col("n"), F.lit(0)).cast("int").alias("orders_count"),
            F.coalesce(F.col("units"), F.lit(0)).cast("int").alias("units_sold"),
            c.money(F.col("p_retailprice")).alias("avg_unit_price"),
            F.col("last_seen_at").alias("updated_at"),
            F.col("p_type").alias("kind"),
        )

    def mdm_product_master(self) -> DataFrame:
        return self.product_profiles().filter("kind <> 'PROMO'").drop("kind")

    def mdm_date(self) -> DataFrame:
        shipped = self.source("lineitem").agg(
            F.to_date(F.min("l_shipdate")).alias("first_day"), F.to_date(F.max("l_shipdate")).alias("last_day")
        )
        return calendar_between(shipped, "first_day", "last_day")

    def tables(self) -> dict[str, DataFrame]:
        return {
            "sales_order": self.sales_order(),
            "sales_order_line_item": self.sales_order_line_item(),
            "customer_sales": self.customer_sales(),
            "mdm_customer360": self.mdm_customer360(),
            "mdm_product_master": self.mdm_product_master(),
            "mdm_date": self.mdm_date(),
        }


def line_item_id():
    """`SO-<order>-L<line>`, as text."""
    return F.concat(
        F.lit("SO-"), F.col("l_orderkey").cast("string"), F.lit("-L"), F.col("l_linenumber").cast("string")
    )
