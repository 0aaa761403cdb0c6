"""Signals of a running stream as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "query_id string, batch_id bigint, started_at string, input_rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, state_rows bigint, batch_ms bigint"
)


class ProgressLog(StreamingQueryListener):
    """Appends a row for every micro-batch of the session's queries to a Parquet log, from the first to the last.

    Register it with `spark.streams.addListener`. A query itself only remembers its last batches,
    see `progress_table`.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        done = event.progress
        row = (
            str(done.id), done.batchId, done.timestamp, done.numInputRows, float(done.inputRowsPerSecond or 0),
            float(done.processedRowsPerSecond or 0), sum(operator.numRowsTotal for operator in done.stateOperators),
            int(done.batchDuration),
        )
        self.spark.createDataFrame([row], PROGRESS).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The recent micro-batches of a query: input, speed, state size and duration."""
    rows = [
        (
            str(progress["id"]),
            progress["batchId"],
            str(progress["timestamp"]),
            progress["numInputRows"],
            float(progress["inputRowsPerSecond"] or 0),
            float(progress["processedRowsPerSecond"] or 0),
            sum(operator["numRowsTotal"] for operator in progress["stateOperators"]),
            progress["durationMs"].get("triggerExecution", 0),
        )
        for progress in query.recentProgress
    ]
    return spark.createDataFrame(rows, PROGRESS)
