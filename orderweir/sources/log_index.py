"""A message log with an index of event times per file, so that a replay reads only files it needs.

The time of a message lies inside its body, where no file statistics see it. Each batch therefore
writes a small index beside its files; a replay asks the index first and parses nothing else. The time is
read out of a body once, when its batch is appended, and kept beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderweir.streaming.sinks import append_batch


def envelope_time(value: str = "value") -> Column:
    """Event time in milliseconds of a change message, wrapped or bare, read without decoding the rest."""
    return F.coalesce(F.get_json_object(value, "$.payload.ts_ms"), F.get_json_object(value, "$.ts_ms")).cast("bigint")


class IndexedLog:
    """Messages below `path`/log and one index row per file below `path`/index, both by batch."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, time: Column | None = None):
        self.spark, self.path = spark, path
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.time = envelope_time() if time is None else time

    def _log(self, *paths: str) -> DataFrame:
        fields = StructType([*self.schema.fields]).add("_ms", "long").add("_batch_id", "long")
        return self.spark.read.schema(fields).option("basePath", f"{self.path}/log").parquet(*paths)

    def append(self, messages: DataFrame, batch_id: int) -> None:
        """Append a batch, ranged by event time so that a file covers little of it; usable as a `foreachBatch` body.

        A repeated batch replaces its files and its index. Messages without a time are in every replay.
        """
        timed = messages.select(*[f.name for f in self.schema.fields], self.time.alias("_ms"))
        append_batch(timed.repartitionByRange("_ms"), batch_id, f"{self.path}/log")
        written = self._log(f"{self.path}/log").where(F.col("_batch_id") == batch_id)
        entries = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.min("_ms").alias("first_ms"),
            F.max("_ms").alias("last_ms"),
            F.count_if(F.col("_ms").isNull()).alias("undated"),
            F.count("*").alias("messages"),
        )
        append_batch(entries, batch_id, f"{self.path}/index")

    def index(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/index").drop("_ingest_ts")

    def files_since(self, start_ms: int, end_ms: int | None = None) -> list[str]:
        """Files that may hold messages of the time range; the list is what a scan needs on the driver anyway."""
        wanted = F.col("last_ms") >= start_ms
        if end_ms is not None:
            wanted = wanted & (F.col("first_ms") < end_ms)
        found = self.index().where(F.coalesce(wanted, F.lit(False)) | (F.col("undated") > 0)).select("file")
        return [row["file"] for row in found.toLocalIterator()]

    def replay(self, start_ms: int, end_ms: int | None = None) -> DataFrame:
        """Messages from a point in time on, late ones included, and those without a time."""
        files = self.files_since(start_ms, end_ms)
        log = self._log(*files) if files else self._log(f"{self.path}/log").where("false")
        wanted = F.col("_ms") >= start_ms
        if end_ms is not None:
            wanted = wanted & (F.col("_ms") < end_ms)
        return log.where(F.coalesce(wanted, F.lit(True))).select(*[f.name for f in self.schema.fields])
