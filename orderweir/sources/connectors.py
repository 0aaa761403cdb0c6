"""Readers for outside systems. Each returns a frame the operators take as is.

Kafka, Avro and JDBC drivers are not part of Spark's core distribution; add them
with `--packages`. A file source with the same columns replaces Kafka in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of a topic record, whatever delivers it.
MESSAGE = "topic string, `partition` int, `offset` bigint, key string, value string, `timestamp` timestamp"


def kafka_options(servers: str, topics: list[str], start: str, per_batch: int | None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
    }
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def _as_messages(raw: DataFrame) -> DataFrame:
    return raw.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )


def kafka_stream(
    spark: SparkSession, servers: str, topics: list[str], start: str = "latest", per_batch: int | None = None
) -> DataFrame:
    """Topics as an unbounded stream; `per_batch` bounds the records of one micro-batch."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topics, start, per_batch))
    return _as_messages(reader.load())


def kafka_between(
    spark: SparkSession, servers: str, topics: list[str], start_ms: int, end_ms: int | None = None
) -> DataFrame:
    """A bounded read of live topics by time: replay, back-fill, or a look at recent records."""
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingTimestamp", str(start_ms))
    )
    if end_ms is not None:
        reader = reader.option("endingTimestamp", str(end_ms))
    return _as_messages(reader.load())


def file_stream(spark: SparkSession, path: str, schema: str = MESSAGE, per_batch: int | None = None, fmt: str = "json") -> DataFrame:
    """Files that keep arriving in a folder, `per_batch` files at a time."""
    reader = spark.readStream.format(fmt).schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(path)


def table_stream(spark: SparkSession, table: str, per_batch: int | None = None) -> DataFrame:
    """A catalog table as a stream of the files added to it."""
    reader = spark.readStream
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.table(table)


def avro_value(column: str, avro_schema: str):
    """Decode an Avro message body. Needs the spark-avro package."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(F.col(column), avro_schema)


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str,
    split_on: str | None = None,
    low: object = None,
    high: object = None,
    parts: int = 16,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """JDBC options; with `split_on` the table is read in `parts` ranges in parallel."""
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": str(fetch_size),
    }
    if split_on:
        if low is None or high is None:
            raise ValueError("a split read needs the low and high bound of its column")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return options


def jdbc_table(spark: SparkSession, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**settings)).load()
