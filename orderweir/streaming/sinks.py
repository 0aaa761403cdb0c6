"""Writers for micro-batches and batches. All of them may be repeated safely."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderweir.operators import quality
from orderweir.operators.latest import latest_per_key
from orderweir.operators.projections import to_lakehouse
from orderweir.schemas import lakehouse_key
from orderweir.functions.columns import has_key


def append_batch(df: DataFrame, batch_id: int, path: str, ingested_at: datetime.datetime | None = None) -> None:
    """Append to an immutable log: one partition per batch, so a repeated batch replaces itself."""
    stamp = F.lit(ingested_at) if ingested_at else F.current_timestamp()
    (
        df.withColumn("_ingest_ts", stamp)
        .withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_batch_id")
        .parquet(path)
    )


def append_json(df: DataFrame, batch_id: int, path: str, rows_per_file: int = 1_000_000) -> None:
    """Raw records as JSON objects, `rows_per_file` to a file and not one; small pieces are put together first."""
    (
        df.hint("rebalance")
        .withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("_batch_id")
        .json(path)
    )


def full_refresh(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Replace whole tables; returns rows written, observed during the write.

    The only partition of a table is overwritten dynamically: new files are
    staged and swapped in when the write is done. Readers may meet the moment of the swap.
    """
    counts = {}
    for name, df in tables.items():
        seen = Observation(f"refresh-{name}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("_part", F.lit(0))
        writer = counted.write.mode("overwrite").partitionBy("_part")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{name}")
        counts[name] = seen.get["rows"]
        if counts[name] == 0:  # no rows, no partition to overwrite: empty the table
            counted.limit(0).write.mode("overwrite").partitionBy("_part").parquet(f"{path}/{name}")
    return counts


def jdbc_refresh(df: DataFrame, options: dict[str, str]) -> None:
    """Replace the rows of a JDBC table and keep the table itself with its grants and indexes."""
    df.write.format("jdbc").mode("overwrite").option("truncate", "true").options(**options).save()


def jdbc_append(df: DataFrame, options: dict[str, str], rows_per_statement: int = 3000) -> None:
    df.write.format("jdbc").mode("append").option("batchsize", str(rows_per_statement)).options(**options).save()


def kafka_batch(messages: DataFrame, servers: str) -> None:
    """Send `(topic, key, value)` messages; each row names its topic."""
    messages.select("topic", "key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def kafka_stream_writer(messages: DataFrame, servers: str):
    """A writer that sends a stream of `(topic, key, value)` messages."""
    return (
        messages.select("topic", "key", "value").writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    )


#: The order of messages in a topic's log.
ARRIVAL = ["timestamp", "partition", "offset"]


def merge_topic(path: str, topic: str, order: list[str] | None = None, guard: str | None = None):
    """A `foreachBatch` function that appends the last record per key of one topic's messages to a log.

    A batch writes its own rows only, and a repeated batch replaces itself. `topic_state` reads the merged table.
    """
    order = order or ARRIVAL

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = to_lakehouse(batch.filter((F.col("topic") == topic) & F.col("value").isNotNull()), topic, *order)
        keyed = rows.filter(has_key(F.col(lakehouse_key(topic))))
        last = latest_per_key(keyed, [lakehouse_key(topic)], [*([guard] if guard else []), *order])
        append_batch(last, batch_id, path)

    return write


def topic_state(spark: SparkSession, path: str, topic: str, order: list[str] | None = None, guard: str | None = None) -> DataFrame:
    """One row per key of a log that `merge_topic` writes: the last by `order`.

    With `guard` an older record never replaces a newer one, whatever batch it came in; on equal times the later arrival wins.
    """
    order = order or ARRIVAL
    rows = latest_per_key(spark.read.parquet(path), [lakehouse_key(topic)], [*([guard] if guard else []), "_batch_id", *order])
    return rows.drop("_ingest_ts", "_batch_id", *order)


def split_good_and_bad(amount: str, target: str, good_path: str, bad_path: str):
    """A `foreachBatch` function: readable records to one log, the others with a reason to another."""

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = quality.quarantine(batch, amount, target).persist()
        try:
            append_batch(checked.filter("reason is null").drop("reason"), batch_id, good_path)
            append_batch(checked.filter("reason is not null"), batch_id, bad_path)
        finally:
            checked.unpersist()

    return write
