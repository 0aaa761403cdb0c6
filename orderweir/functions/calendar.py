"""Calendar attributes of a day, in the numbering of the date master table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_columns(day: Column, loaded_at: Column) -> list[Column]:
    """`day_of_week` counts from Sunday = 1; `week_of_year` is the ISO week."""
    weekday = F.dayofweek(day)
    return [
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day.alias("full_date"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_of_year"),
        F.year(day).alias("year_number"),
        weekday.isin(1, 7).alias("is_weekend"),
        loaded_at.alias("created_at"),
        loaded_at.alias("updated_at"),
    ]


def calendar_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from a one-row frame holding the first and the last day."""
    days = bounds.select(
        F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))).alias("day")
    )
    return days.select(*calendar_columns(F.col("day"), F.col("day").cast("timestamp_ntz")))
