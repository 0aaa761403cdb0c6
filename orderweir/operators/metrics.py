"""Declared metrics: a small description that becomes a filter and an aggregate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.functions import columns as c

CALCULATIONS = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "count_distinct": F.count_distinct}
OPERATORS = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


@dataclass(frozen=True)
class Metric:
    name: str
    calculation: str
    expression: str
    timestamp: str
    filters: list[tuple[str, str, object]] = field(default_factory=list)
    result_type: str | None = None

    def compute(self, model: DataFrame, grain: str = "month", by: tuple[str, ...] = ()) -> DataFrame:
        """The metric per period of its time column, optionally by dimensions."""
        rows = model
        for column, operator, value in self.filters:
            rows = rows.filter(OPERATORS[operator](F.col(column), F.lit(value)))
        period = F.date_trunc(grain, F.col(self.timestamp)).cast("timestamp_ntz").alias("period")
        result = CALCULATIONS[self.calculation](F.expr(self.expression))
        if self.result_type:
            result = result.cast(self.result_type)
        return rows.groupBy(period, *by).agg(result.alias(self.name))


GROSS_REVENUE = Metric(
    name="gross_revenue",
    calculation="sum",
    expression="order_total",
    timestamp="order_completed_ts",
    filters=[("order_status", "=", "COMPLETED")],
    result_type=c.MONEY,
)
