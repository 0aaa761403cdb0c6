"""Small JSON files of finished batches put together, while readers go on.

Raw batches are written as they come. Compaction copies whole batches into files of a target size beside
them; readers take compacted batches from there and later ones from the raw log. Raw files stay
as they are, so nobody who is reading them is disturbed; the storage's own expiry may remove them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderweir.session import stored
from orderweir.streaming.sinks import append_json

BATCH = "_batch_id"


class JsonLog:
    """Raw batches below `path`/raw, compacted ones below `path`/packed, both partitioned by batch."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.schema = spark, schema
        self.raw, self.packed = f"{path}/raw", f"{path}/packed"

    def append(self, records: DataFrame, batch_id: int) -> None:
        append_json(records, batch_id, self.raw)

    def _files(self, path: str) -> DataFrame:
        """(path, length, batch) of each file; contents are not read."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        batch = F.regexp_extract("path", rf"{BATCH}=(-?\d+)/", 1).try_cast("bigint")
        return files.select("path", "length", batch.alias("batch")).where("batch is not null")

    def last_packed(self) -> int | None:
        """The last compacted batch; a batch's folder appears as a whole when its compaction is done."""
        try:
            return self._files(self.packed).agg(F.max("batch")).first()[0]
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def plan(self, upto: int, target_bytes: int) -> DataFrame:
        """(path, bin): files of each batch in order of their names, a new bin whenever the target is passed.

        A bin's number follows from a running sum of sizes; a file is in one bin, also a large one. Numbers are
        dense over all batches. Sums run per batch, so no task sees the files of more than one.
        """
        done = self.last_packed()
        files = self._files(self.raw).where(F.col("batch") <= upto)
        if done is not None:
            files = files.where(F.col("batch") > done)
        before = Window.partitionBy("batch").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        own = files.withColumn("own", F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / target_bytes))
        bins = own.select("batch", "own").distinct()
        dense = bins.withColumn("bin", F.row_number().over(Window.orderBy("batch", "own")) - 1)  # one row per new file
        return own.join(dense, ["batch", "own"]).select("path", "batch", "bin")

    def compact(self, upto: int, target_bytes: int = 128 << 20) -> int:
        """Compact all batches up to `upto` that are not yet; returns the number of files written.

        Lines are copied as text, so no record changes. It may be repeated, and run beside writers of later
        batches: a compaction that failed has left either a whole batch or nothing of it.
        """
        plan = stored(self.plan(upto, target_bytes), "json-bins")
        bins = plan.agg(F.max("bin")).first()[0]
        if bins is None:
            return 0
        lines = self.spark.read.option("recursiveFileLookup", "true").text(self.raw)
        lines = lines.select("value", F.col("_metadata.file_path").alias("path"))
        name = lambda path: F.regexp_replace(path, "^file:/+", "/")
        packed = lines.withColumn("path", name("path")).join(plan.withColumn("path", name("path")), "path")
        (
            packed.repartitionById(bins + 1, F.col("bin").cast("int"))
            .select("value", F.col("batch").alias(BATCH))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .text(self.packed)
        )
        return bins + 1

    def read(self) -> DataFrame:
        """All records with their batch: compacted batches from the large files, later ones as they were written."""
        fields = f"{self.schema}, {BATCH} bigint"
        raw = self.spark.read.schema(fields).json(self.raw)
        done = self.last_packed()
        if done is None:
            return raw
        return self.spark.read.schema(fields).json(self.packed).unionByName(raw.where(F.col(BATCH) > done))
