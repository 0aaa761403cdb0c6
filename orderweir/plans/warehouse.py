"""The layers as catalog objects: landing tables, bronze views, silver and gold tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderweir import schemas
from orderweir.plans import bronze
from orderweir.plans.models import Models
from orderweir.session import shuffles_dropped


# Landing tables that meet in the largest join, and its key.
JOINED_BY = {"sales_order": "orderid", "sales_order_line_item": "orderid"}


class Warehouse:
    """One database per layer, named `<prefix><layer>`, stored below `location`."""

    def __init__(self, spark: SparkSession, location: str, prefix: str = ""):
        self.spark, self.location, self.prefix = spark, location.rstrip("/"), prefix
        self.databases = {layer: f"{prefix}{layer}" for layer in schemas.LAYERS}

    def name(self, layer: str, table: str) -> str:
        return f"{self.databases[layer]}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def create(self) -> Warehouse:
        for layer, database in self.databases.items():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.location}/{layer}'")
        return self

    def declare_landing(self) -> Warehouse:
        """Landing tables by their declared columns, if they are not there yet."""
        for table, columns in schemas.LANDING.items():
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name('landing', table)} ({columns}) USING parquet")
        return self

    def land(self, tables: dict[str, DataFrame], buckets: int = 0) -> Warehouse:
        """Store landing tables.

        With `buckets` orders and lines are bucketed by order, and the fact joins
        them without a shuffle. Leave it off where one order may be huge: a bucket
        cannot be split, a shuffled partition can.
        """
        for table, df in tables.items():
            writer = df.write.mode("overwrite").format("parquet").option("compression", "zstd")
            if buckets and table in JOINED_BY:
                writer = writer.bucketBy(buckets, JOINED_BY[table]).sortBy(JOINED_BY[table])
            with shuffles_dropped(self.spark):
                writer.saveAsTable(self.name("landing", table))
        return self

    def build(self) -> Warehouse:
        """Bronze views, then silver tables, then gold from the stored silver tables."""
        for model, (table, _) in bronze.MODELS.items():
            self.spark.sql(bronze.view_sql(model, self.name("bronze", model), self.name("landing", table)))
        landing = {table: self.table("landing", table) for table in schemas.LANDING}
        models = Models(landing)
        dims = {
            "dim_mdm_customer": self._store("silver", "dim_mdm_customer", models.dim_customer),
            "dim_mdm_product": self._store("silver", "dim_mdm_product", models.dim_product),
            "dim_mdm_date": self._store("silver", "dim_mdm_date", models.dim_date),
        }
        parts = Models(landing, dims).fact_parts(landing["sales_order_line_item"].count())
        fact = self._store("silver", "fact_sales_order", parts, ["year", "month"])
        self._store("gold", "gold_customer_sales_summary", Models(landing, {**dims, "fact_sales_order": fact}).summary())
        return self

    def _store(
        self, layer: str, table: str, df: DataFrame | list[DataFrame], partitions: list[str] | None = None
    ) -> DataFrame:
        """Write a table, in one or several parts; rebalancing keeps a partition's files few and splits partitions too big for one."""
        parts = [df] if isinstance(df, DataFrame) else df
        for number, part in enumerate(parts):
            if partitions:
                writer = part.hint("rebalance", *partitions).write.partitionBy(*partitions)
            else:
                writer = part.write
            writer = writer.mode("append" if number else "overwrite").format("parquet").option("compression", "zstd")
            with shuffles_dropped(self.spark):
                writer.saveAsTable(self.name(layer, table))
        return self.table(layer, table).select(parts[0].columns)

    def drop(self) -> None:
        for database in self.databases.values():
            self.spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")

    # ---- catalog queries ----------------------------------------------------
    def relations(self) -> DataFrame:
        """`(layer, relation, kind, row_count)` of every relation, counted in one job."""
        found = []
        for layer, database in self.databases.items():
            for entry in self.spark.catalog.listTables(database):
                if not entry.isTemporary:
                    found.append((layer, entry.name, "view" if entry.tableType == "VIEW" else "table"))
        counts = [
            self.table(layer, relation)
            .agg(F.count("*").alias("row_count"))
            .select(F.lit(layer).alias("layer"), F.lit(relation).alias("relation"), F.lit(kind).alias("kind"), "row_count")
            for layer, relation, kind in found
        ]
        return reduce(DataFrame.unionByName, counts).orderBy("layer", "relation")

    def columns(self) -> DataFrame:
        return reduce(
            DataFrame.unionByName,
            [
                column_inventory(layer, entry.name, self.table(layer, entry.name))
                for layer, database in self.databases.items()
                for entry in self.spark.catalog.listTables(database)
                if not entry.isTemporary
            ],
        )


def column_inventory(layer: str, relation: str, df: DataFrame) -> DataFrame:
    """One row per column: position, type and number of values, counted in one pass."""
    counts = df.agg(*[F.count(F.col(field.name)).alias(f"n{i}") for i, field in enumerate(df.schema.fields)])
    entries = F.array(
        *[
            F.struct(
                F.lit(layer).alias("layer"),
                F.lit(relation).alias("relation"),
                F.lit(i + 1).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col(f"n{i}").alias("value_count"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    return counts.select(F.explode(entries).alias("row")).select("row.*")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """`(table_name, row_count)` over several tables."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
