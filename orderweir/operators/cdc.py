"""Change events to curated records, current state and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderweir import schemas
from orderweir.operators.hotkeys import SLICE, in_several, slice_by_rows
from orderweir.operators.latest import latest_per_key

EVERY_OPERATION = ("c", "r", "u", "d")


def row_image() -> Column:
    """A delete is described by `before`, every other change by `after`."""
    return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))


def curated(changes: DataFrame) -> DataFrame:
    """Records for the curated topics, key kept; changes without a row image or target are dropped."""
    targets = F.create_map(*[F.lit(text) for pair in schemas.CDC_TOPICS.items() for text in pair])
    return (
        changes.filter(F.col("topic").isin(*schemas.CDC_TOPICS))
        .withColumn("data", row_image())
        .filter(F.col("data").isNotNull())
        .select(
            targets[F.col("topic")].alias("topic"),
            "key",
            F.when(F.col("topic").endswith("customer360"), "customer").otherwise("product").alias("entity"),
            F.col("op").alias("operation"),
            F.col("ts_ms").alias("sourceTsMs"),
            "data",
        )
    )


def curated_messages(changes: DataFrame) -> DataFrame:
    """Curated records as `(topic, key, value)` for a topic sink."""
    return curated(changes).select(
        "topic",
        "key",
        F.to_json(F.struct("entity", "operation", "sourceTsMs", "data"), {"ignoreNullFields": "false"}).alias("value"),
    )


def dedupe(changes: DataFrame, keys: list[str]) -> DataFrame:
    """One copy of every change: same key, same log position, same time.

    Copies are whole duplicates, so any of them may stay; they combine before
    the shuffle however often one change was delivered.
    """
    return changes.dropDuplicates([*keys, "position", "ts_ms"])


def current_state(
    changes: DataFrame, keys: list[str], operations: tuple[str, ...] = EVERY_OPERATION
) -> DataFrame:
    """The live row of every key: its last change by (time, position), unless that was a delete."""
    last = latest_per_key(changes.filter(F.col("op").isin(*operations)), keys, ["ts_ms", "position"])
    return last.filter("op <> 'd'").select(*keys, "op", "ts_ms", "after")


def history(changes: DataFrame, key: str, max_rows: int | None = None) -> DataFrame:
    """Versions of each key with the time range they were valid in.

    A version ends where the next change of its key begins, a delete ends the
    last version without starting one. Order is (time, log position), as for the current state.
    The log is cut into slices of rows; a slice takes the first change of the next
    slice of its key as the end of its last version.
    """
    rows = slice_by_rows(
        changes.select(key, "position", "ts_ms", "op", "after"), key, ["ts_ms", "position"], max_rows
    )
    in_slice = W.partitionBy(key, SLICE).orderBy("ts_ms", "position")
    local = rows.withColumn("_next", F.lead("ts_ms").over(in_slice))
    first = rows.groupBy(F.col(key).alias("_key"), F.col(SLICE).alias("_from")).agg(F.min("ts_ms").alias("_starts"))
    follows = in_several(first, "_key").select(
        "_key", "_from", F.lead("_starts").over(W.partitionBy("_key").orderBy("_from")).alias("_after_slice")
    )
    joined = local.join(
        follows, local[key].eqNullSafe(follows["_key"]) & (local[SLICE] == follows["_from"]), "left"
    )
    return (
        joined.filter("op <> 'd'")
        .select(
            F.col(key),
            "position",
            "after",
            F.col("ts_ms").alias("valid_from_ms"),
            F.coalesce(F.col("_next"), F.col("_after_slice")).alias("valid_to_ms"),
        )
        .withColumn("is_current", F.col("valid_to_ms").isNull())
    )


def replay_from(changes: DataFrame, start_ms: int) -> DataFrame:
    """Changes to process again: everything at or after a point in time."""
    return changes.filter(F.col("ts_ms") >= start_ms)


def recent_changes(df: DataFrame, time: str, since: Column, limit: int, *ties: str) -> DataFrame:
    """The newest rows since a bound, newest first: a bounded look at a live table."""
    return df.filter(F.col(time) >= since).orderBy(F.col(time).desc(), *ties).limit(limit)
