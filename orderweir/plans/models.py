"""All models over one landing layer, as lazy frames by name."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.plans import bronze, gold, silver

# Lines of the fact that are joined and written in one go: beyond that its shuffles take no more of the disk.
LINES_PER_PART = 80_000_000
# What the fact takes of each dimension.
OF_FACT = {
    "dim_mdm_customer": ["customer_id", "customer_name", "customer_email", "customer_segment"],
    "dim_mdm_product": ["product_id", "product_name"],
    "dim_mdm_date": ["date_day", "date_key", "year", "quarter", "month", "month_name", "day_name", "is_weekend"],
}


def part_of(rows: DataFrame, number: int, parts: int) -> DataFrame:
    """Rows of a part of the orders, by hash of their id."""
    return rows if parts == 1 else rows.where(F.pmod(F.xxhash64("order_id"), F.lit(parts)) == number)


class Models:
    """Bronze, silver and gold as lazy frames.

    `landing` is a `Landing` or maps table names to frames; only the tables a
    model needs are touched. Hand in stored silver tables as `stored` (model name
    to frame) to build on them instead of from scratch. `to_store`: the fact is to be written,
    see `silver.fact_sales_order`. `part` (number, of how many): orders and lines of a part of the orders, by hash of their id.
    """

    def __init__(
        self, landing, stored: dict[str, DataFrame] | None = None, to_store: bool = False, part: tuple[int, int] = (0, 1)
    ):
        self._landing = landing
        self._stored = stored or {}
        self._to_store = to_store
        self._part = part

    def stage(self, model: str) -> DataFrame:
        table = bronze.MODELS[model][0]
        if isinstance(self._landing, dict):
            landing = self._landing[table]
        elif self._to_store and table == "sales_order_line_item":
            landing = self._landing.sales_order_line_item(by_product=True)
        else:
            landing = getattr(self._landing, table)()
        staged, (number, parts) = bronze.stage(model, landing), self._part
        return part_of(staged, number, parts) if "order_id" in staged.columns else staged

    def _or_stored(self, name: str, build) -> DataFrame:
        return self._stored[name] if name in self._stored else build()

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._or_stored("dim_mdm_customer", lambda: silver.dim_mdm_customer(self.stage("stg_mdm_customer360")))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._or_stored("dim_mdm_product", lambda: silver.dim_mdm_product(self.stage("stg_mdm_product_master")))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._or_stored("dim_mdm_date", lambda: silver.dim_mdm_date(self.stage("stg_mdm_date")))

    @cached_property
    def fact_sales_order(self) -> DataFrame:
        return self._or_stored(
            "fact_sales_order",
            lambda: silver.fact_sales_order(
                self.stage("stg_sales_order_line_item"),
                self.stage("stg_sales_order"),
                self.dim_customer,
                self.dim_product,
                self.dim_date,
                self._to_store,
            ),
        )

    @cached_property
    def fact_rollup(self) -> DataFrame:
        return gold.fact_rollup(self.fact_sales_order)

    def fact_parts(self, lines: int) -> list[DataFrame]:
        """The fact to be written, in parts of about `LINES_PER_PART` lines each; every row is in one of them."""
        parts = lines // LINES_PER_PART + 1
        return [Models(self._landing, self._stored, True, (number, parts)).fact_sales_order for number in range(parts)]

    def summary_changelog(self) -> DataFrame:
        return gold.customer_sales_summary(self.stage("stg_customer_sales"), self.dim_customer, self.fact_rollup)

    def summary(self) -> DataFrame:
        if isinstance(self._landing, dict):
            latest = gold.latest_snapshots(self.stage("stg_customer_sales"))
        else:  # the last totals come from one aggregate, without the snapshots before them
            latest = bronze.stage("stg_customer_sales", self._landing.customer_sales_latest())
        return gold.customer_sales_summary(latest, self.dim_customer, self.fact_rollup)

    def summary_by_max(self) -> DataFrame:
        return gold.customer_sales_summary_by_max(
            self.stage("stg_customer_sales"), self.stage("stg_sales_order"), self.stage("stg_sales_order_line_item")
        )
