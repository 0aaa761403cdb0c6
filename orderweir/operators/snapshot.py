"""A first snapshot taken in chunks while changes go on, put right by the change log.

Each chunk of keys is read some time between two marks of the log. Whatever the log says about a
key between the marks of its chunk is newer than, or the same as, what the chunk read; so such rows are
left to the log, and all others are as they were at the high mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.operators.cdc import EVERY_OPERATION
from orderweir.operators.latest import latest_per_key


def settled_reads(chunk_rows: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Snapshot rows that stand at the high mark of their chunk, as reads: (key, position, op, after).

    chunk_rows: (key, after, low, high), low and high being log positions before and after the chunk was
    read. changes: (key, position, op, after). Changes are cut to the marks' span and reduced to one
    position each before the join; a hot key costs one row per position range, not one per pair.
    """
    marks = chunk_rows.select(F.col(key).alias("_key"), "low", "high").distinct()
    during = (
        changes.select(F.col(key).alias("_changed"), "position")
        .join(marks, F.col("_changed") == F.col("_key"))
        .where((F.col("position") > F.col("low")) & (F.col("position") <= F.col("high")))
        .select("_changed", F.col("low").alias("_low"))
        .distinct()
    )
    untouched = chunk_rows.join(during, (chunk_rows[key] == during["_changed"]) & (chunk_rows["low"] == during["_low"]), "left_anti")
    return untouched.select(key, F.col("high").alias("position"), F.lit("r").alias("op"), "after")


def state_at(chunk_rows: DataFrame, changes: DataFrame, key: str, mark: int | None = None) -> DataFrame:
    """Live rows at a mark (default: the end of the log) from a chunked snapshot and the log since its first chunk.

    Reads and changes go by log position; a change at the high mark itself comes after the read.
    """
    known = changes.where(F.col("op").isin(*EVERY_OPERATION))
    if mark is not None:
        known = known.where(F.col("position") <= mark)
    reads = settled_reads(chunk_rows, known, key).withColumn("_log", F.lit(0))
    both = reads.unionByName(known.select(key, "position", "op", "after").withColumn("_log", F.lit(1)))
    return latest_per_key(both, [key], ["position", "_log"]).where("op <> 'd'").select(key, "position", "after")
