"""Cut the rows of a table into slices that fit a task, along a key and its order.

A window needs all rows of its key in one task. Where one key may own a large
part of the table, the window runs per `(key, slice)` instead, and a small frame
of the keys that lie in several slices carries the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.session import stored

# Rows of a slice; None: a slice per shuffle partition, whose number is set for the size of the data.
MAX_ROWS: int | None = None
SLICE = "_slice"


def slice_by_rows(df: DataFrame, key: str, sequence: list[str], max_rows: int | None = None) -> DataFrame:
    """Add `_slice`, a number that rises with `sequence` within a key; no slice has many more rows than others.

    All rows are ranged by (key, sequence) into pieces of like size and written once, so pieces
    follow the rows and not the values: an outlier changes nothing, and there is no limit on the
    number of hot keys. With `max_rows` a slice has about so many at most. Rows of equal key and sequence share a slice; nulls come first, as in the windows.
    """
    max_rows = max_rows or MAX_ROWS
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if max_rows:  # ranges come from a sample; half the size leaves room for its error
        pieces = max(pieces, 2 * df.count() // max_rows + 1)
    ranged = df.repartitionByRange(pieces, key, *sequence).withColumn(SLICE, F.spark_partition_id())
    return stored(ranged, "slices")


def in_several(slices: DataFrame, key: str) -> DataFrame:
    """Of a frame with one row per key and slice: those of keys with more than one slice."""
    several = slices.groupBy(F.col(key).alias("_several")).agg(F.count("*").alias("_n")).filter("_n > 1")
    return slices.join(several, slices[key].eqNullSafe(several["_several"]), "left_semi")
