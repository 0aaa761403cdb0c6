"""Running totals: rules, slicing of hot keys, agreement of both forms."""

import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderweir.operators import cdc, hotkeys
from orderweir.operators.running import latest_totals, running_totals
from orderweir.sources.changes import changes

T = [datetime.datetime(2026, 1, day) for day in range(1, 10)]
SCHEMA = "k string, a bigint, t timestamp_ntz, n bigint, s decimal(18,2), name string"
ARGS = dict(key="k", arrival="a", event_time="t", sums=["n", "s"], latest=["name"])


def frame(spark, *data):
    return spark.createDataFrame([(k, a, t, 1, Decimal(s), name) for k, a, t, s, name in data], SCHEMA)


def test_late_event_adds_but_does_not_replace(spark):
    df = frame(spark, ("c", 1, T[2], 10, "new"), ("c", 2, T[1], 5, "old"))
    got = running_totals(df, **ARGS).orderBy("a").collect()
    assert [(r.n, r.s, r.t, r.name) for r in got] == [
        (1, Decimal("10.00"), T[2], "new"),
        (2, Decimal("15.00"), T[2], "new"),
    ]


def test_equal_times_go_to_the_later_arrival(spark):
    df = frame(spark, ("c", 1, T[1], 1, "first"), ("c", 2, T[1], 1, "second"))
    assert latest_totals(df, **ARGS).first().name == "second"


def test_missing_time_never_wins_over_a_time(spark):
    df = frame(spark, ("c", 1, None, 1, "undated"), ("c", 2, T[1], 1, "dated"), ("c", 3, None, 1, "undated again"))
    got = running_totals(df, **ARGS).orderBy("a").collect()
    assert [r.name for r in got] == ["undated", "dated", "dated"]


@pytest.mark.parametrize("max_rows", [1, 3, 50])
def test_slices_change_nothing(spark, max_rows):
    """One key owns two thirds of the rows, one key is missing, many are small."""
    df = spark.range(600).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).when(F.col("id") % 9 == 2, None).otherwise(F.concat(F.lit("k"), F.col("id") % 17)).alias("k"),
        F.col("id").alias("a"),
        (F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(1000)))).cast("timestamp_ntz").alias("t"),
        F.lit(1).cast("bigint").alias("n"),
        (F.col("id") % 7).cast("decimal(18,2)").alias("s"),
        F.col("id").cast("string").alias("name"),
    )
    order = ["k", "a", "n", "s", "t", "name"]
    plain = running_totals(df, **ARGS).select(order)
    sliced = running_totals(df, **ARGS, max_rows=max_rows).select(order)
    assert rows(sliced) == rows(plain)
    slices = hotkeys.slice_by_rows(df, "k", ["a"], max_rows).filter("k = 'hot'").select(hotkeys.SLICE).distinct().count()
    assert slices > 1


def test_slices_bound_the_rows_of_a_task(spark):
    """Also with an outlier far from all others."""
    df = spark.range(10_001).select(F.lit("hot").alias("k"), F.expr("if(id = 10000, 1000000000000000, id)").alias("a"))
    biggest = hotkeys.slice_by_rows(df, "k", ["a"], 500).groupBy(hotkeys.SLICE).count().agg(F.max("count")).first()[0]
    assert biggest <= 1000


@pytest.mark.parametrize("max_rows", [2, 3, 1000])
def test_events_without_a_sequence_come_first_for_any_slices(spark, max_rows):
    data = [("hot", a, 1, None, "x") for a in [None, *range(10)]]
    df = spark.createDataFrame(data, "k string, a bigint, n bigint, t timestamp_ntz, name string")
    df = df.withColumn("s", F.lit(1).cast("decimal(18,2)"))
    got = running_totals(df, **ARGS, max_rows=max_rows).select("a", "n")
    assert sorted((r.a if r.a is not None else -1, r.n) for r in got.collect()) == [(i - 1, i + 1) for i in range(11)]


def test_history_with_slices(landing):
    source = changes(landing).persist()
    order = ["entity_id", "position", "valid_from_ms", "valid_to_ms", "is_current"]
    assert rows(cdc.history(source, "entity_id", max_rows=3).select(order)) == rows(
        cdc.history(source, "entity_id").select(order)
    )


def test_last_running_row_is_the_latest_total(landing):
    running = landing.customer_sales_arrivals()
    last = running.groupBy("customerid").agg(F.max("ordercount").alias("n"), F.max("totalspent").alias("s"))
    from orderweir.plans.registry import QUERIES

    final = QUERIES["customer_sales_latest"](landing.spark, landing.folder)
    assert rows(last) == rows(final.select("customerid", F.col("ordercount").alias("n"), F.col("totalspent").alias("s")))
