"""Validity ranges maintained batch by batch: changes may come in any order of batches.

The log holds one row per change: where it starts, where it ends, and what it set. A batch appends
the rows it adds and the rows whose end it moves; the last row of a change counts. Nothing that was
written is rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderweir.operators.hotkeys import SLICE, in_several, slice_by_rows
from orderweir.operators.latest import latest_per_key
from orderweir.session import stored

START = ["ts_ms", "position"]


def _point(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{name}") for name in START])


def log_schema(changes: DataFrame, key: str) -> StructType:
    rows = changes.select(key, *START, "op", "after", F.struct(*START).alias("ends"))
    return StructType(rows.schema.fields)


def split_versions(known: DataFrame, changes: DataFrame, key: str, max_rows: int | None = None) -> DataFrame:
    """The rows to append to a history: new versions, and old ones that a change of the batch cuts.

    known: (key, ts_ms, position, op, after, ends), one row per change, deletes included; `ends` is the next
    change of the key, null while there is none. A change in the middle of a version ends it there and goes
    on to the old end; a delete is such a change, so it shortens a version. A change that is known already changes nothing.

    Per key only versions between the batch's first and last change are looked at, and the first start beyond. A key of very many
    rows is ordered in slices.
    """
    new = changes.where(F.col(key).isNotNull() & F.col("ts_ms").isNotNull()).dropDuplicates([key, *START])
    new = new.select(key, *START, "op", "after")
    span = new.groupBy(key).agg(F.min(_point()).alias("_lo"), F.max(_point()).alias("_hi"))
    near = known.join(span, key).where(F.col("ends").isNull() | (F.col("ends") > F.col("_lo")))
    cut = near.where(_point() <= F.col("_hi")).select(*known.columns, F.lit(True).alias("_old"))
    cut = stored(cut, "history-cut")
    beyond = near.where(_point() > F.col("_hi")).groupBy(F.col(key).alias("_beyond_key")).agg(F.min(_point()).alias("_beyond"))
    fresh = new.join(cut.select(key, *START), [key, *START], "left_anti")
    points = cut.unionByName(fresh.withColumn("_old", F.lit(False)), allowMissingColumns=True)

    rows = slice_by_rows(points, key, START, max_rows)
    local = rows.withColumn("_next", F.lead(_point()).over(W.partitionBy(key, SLICE).orderBy(*START)))
    first = rows.groupBy(F.col(key).alias("_key"), F.col(SLICE).alias("_from")).agg(F.min(_point()).alias("_starts"))
    follows = in_several(first, "_key").select(
        "_key", "_from", F.lead("_starts").over(W.partitionBy("_key").orderBy("_from")).alias("_after_slice")
    )
    now = (
        local.join(follows, (local[key] == follows["_key"]) & (local[SLICE] == follows["_from"]), "left")
        .join(beyond, F.col(key) == F.col("_beyond_key"), "left")
        .withColumn("_ends", F.coalesce("_next", "_after_slice", "_beyond"))
    )
    return now.where(~F.col("_old") | ~F.col("_ends").eqNullSafe(F.col("ends"))).select(
        key, *START, "op", "after", F.col("_ends").alias("ends")
    )


class HistoryLog:
    """An append-only log of versions. Batch ids rise, the last batch may be repeated, and batches may hold any changes."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType):
        """schema: as `log_schema` gives it."""
        self.spark, self.path, self.key, self.schema = spark, path, key, schema

    def create(self) -> HistoryLog:
        empty = self.spark.createDataFrame([], self.schema).withColumn("_batch_id", F.lit(0).cast("bigint"))
        empty.write.partitionBy("_batch_id").parquet(self.path)
        return self

    def _state(self, but: int | None = None) -> DataFrame:
        """One row per change, deletes included; `but`: a batch to leave out."""
        fields = StructType([*self.schema.fields]).add("_batch_id", "long")
        rows = self.spark.read.schema(fields).parquet(self.path)
        if but is not None:
            rows = rows.where(F.col("_batch_id") != but)
        return latest_per_key(rows, [self.key, *START], ["_batch_id"]).select([f.name for f in self.schema.fields])

    def take(self, changes: DataFrame, batch_id: int, max_rows: int | None = None) -> None:
        """Take one batch of changes."""
        from orderweir.streaming.sinks import append_batch

        append_batch(split_versions(self._state(batch_id), changes, self.key, max_rows), batch_id, self.path)

    def versions(self) -> DataFrame:
        """Versions with their validity, as `cdc.history` gives them for the whole log."""
        return self._state().where("op <> 'd'").select(
            self.key,
            "position",
            "after",
            F.col("ts_ms").alias("valid_from_ms"),
            F.col("ends.ts_ms").alias("valid_to_ms"),
            F.col("ends").isNull().alias("is_current"),
        )
