"""One row per key: the latest, the first, and duplicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the row with the highest `order` per key; nulls count as lowest.

    Spark turns the rank filter into a group limit that runs before the shuffle,
    so each task sends at most one row per key.
    """
    return _ranked(df, keys, [F.col(name).desc_nulls_last() for name in order])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _ranked(df, keys, [F.col(name).asc_nulls_last() for name in order])


def _ranked(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def count_duplicate_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """`(table_name, dup_keys)` over several tables."""
    counts = [
        duplicate_keys(df, keys)
        .agg(F.count("*").alias("dup_keys"))
        .select(F.lit(name).alias("table_name"), "dup_keys")
        for name, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
