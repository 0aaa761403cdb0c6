"""Schema drift and additive schema evolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class IncompatibleSchema(ValueError):
    """A column changed its type."""


def differences(expected: StructType, actual: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """`(column, change, expected type, actual type)` for every difference."""
    want = {field.name: field.dataType.simpleString() for field in expected.fields}
    have = {field.name: field.dataType.simpleString() for field in actual.fields}
    found = [(name, "removed", want[name], None) for name in want if name not in have]
    found += [(name, "added", None, have[name]) for name in have if name not in want]
    found += [
        (name, "type_changed", want[name], have[name]) for name in want if name in have and want[name] != have[name]
    ]
    return found


def drift_report(name: str, df: DataFrame, expected: StructType) -> DataFrame:
    """One row per drifted column, with the number of rows that carry a value in it."""
    found = differences(expected, df.schema)
    counted = [F.count(F.col(col)).alias(f"n{i}") for i, (col, *_) in enumerate(found) if col in df.columns]
    totals = df.agg(F.count("*").alias("n"), *counted)
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(col).alias("column_name"),
                F.lit(change).alias("change"),
                F.lit(want).cast("string").alias("expected_type"),
                F.lit(have).cast("string").alias("actual_type"),
                (F.col(f"n{i}") if col in df.columns else F.lit(0)).cast("bigint").alias("rows_affected"),
            )
            for i, (col, change, want, have) in enumerate(found)
        ]
    )
    if not found:
        schema = (
            "table_name string, column_name string, change string, "
            "expected_type string, actual_type string, rows_affected bigint"
        )
        return df.sparkSession.createDataFrame([], schema)
    return totals.select(F.explode(entries).alias("row")).select("row.*")


def additive_union(*frames: DataFrame) -> DataFrame:
    """Append frames whose columns only ever get added; missing columns read as null.

    A changed type is refused: it needs a new table version.
    """
    for later in frames[1:]:
        changed = [d for d in differences(frames[0].schema, later.schema) if d[1] == "type_changed"]
        if changed:
            raise IncompatibleSchema(", ".join(f"{col}: {want} became {have}" for col, _, want, have in changed))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def empty_clone(df: DataFrame) -> DataFrame:
    """A frame with the same columns and no rows."""
    return df.limit(0)
