"""Merges: rules on small rows, table behaviour, properties."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderweir.operators.latest import latest_per_key
from orderweir.operators.upsert import DuplicateMergeKeys, KeyedTable, merged
from orderweir.session import shared_dir

SCHEMA = "k string, t int, v string, money int"


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def table(spark, *data, buckets=3):
    return KeyedTable(spark, shared_dir(spark, "test-table"), ["k"], buckets=buckets).create(frame(spark, *data))


def test_update_and_insert(spark):
    t = table(spark, ("a", 1, "old", 10), ("b", 1, "old", 20))
    t.upsert(frame(spark, ("b", 2, "new", 21), ("c", 2, "new", 30)))
    assert rows(t.read()) == [("a", 1, "old", 10), ("b", 2, "new", 21), ("c", 2, "new", 30)]


def test_unlisted_columns_stay_or_start_null(spark):
    t = table(spark, ("a", 1, "old", 10))
    t.upsert(frame(spark, ("a", 2, "new", 99), ("b", 2, "new", 99)), update=["t", "v"], insert=["k", "t", "v"])
    assert rows(t.read()) == [("a", 2, "new", 10), ("b", 2, "new", None)]


def test_last_arrival_wins_in_a_batch_and_across_batches(spark):
    t = table(spark, ("a", 1, "old", 0))
    t.upsert(frame(spark, ("a", 5, "five", 0), ("a", 4, "four", 0)), order=["t"])
    assert rows(t.read()) == [("a", 5, "five", 0)]
    t.upsert(frame(spark, ("a", 3, "three", 0)), order=["t"])
    assert rows(t.read()) == [("a", 3, "three", 0)]


def test_time_guard_keeps_the_newer_row(spark):
    t = table(spark, ("a", 5, "five", 0))
    t.upsert(frame(spark, ("a", 3, "three", 0)), newer_by="t")
    assert rows(t.read()) == [("a", 5, "five", 0)]
    t.upsert(frame(spark, ("a", 5, "equal", 0)), newer_by="t")
    assert rows(t.read()) == [("a", 5, "equal", 0)]


def test_replayed_batch_changes_nothing(spark):
    t = table(spark, ("a", 1, "old", 0))
    batch = frame(spark, ("a", 2, "new", 1), ("b", 2, "new", 2))
    t.upsert(batch)
    once = rows(t.read())
    t.upsert(batch)
    assert rows(t.read()) == once


def test_strict_merge_names_repeated_keys(spark):
    t = table(spark, ("a", 1, "old", 0))
    with pytest.raises(DuplicateMergeKeys, match="'b'"):
        t.upsert(frame(spark, ("b", 1, "x", 0), ("b", 2, "y", 0)), strict=True)


def test_delete_and_return_of_a_key(spark):
    t = table(spark, ("a", 1, "old", 0), ("b", 1, "old", 0))
    gone = frame(spark, ("a", 2, None, None))
    t.upsert(gone, delete_when=F.col("t") == 2)
    assert rows(t.read()) == [("b", 1, "old", 0)]
    t.upsert(frame(spark, ("a", 3, "back", 7)))
    assert rows(t.read()) == [("a", 3, "back", 7), ("b", 1, "old", 0)]


def test_late_update_does_not_revive_a_deleted_key(spark):
    t = table(spark, ("a", 1, "old", 0))
    t.upsert(frame(spark, ("a", 5, None, None)), newer_by="t", delete_when=F.col("v").isNull())
    t.upsert(frame(spark, ("a", 3, "late", 0)), newer_by="t")
    assert rows(t.read()) == []


def test_delete_rule_of_the_merge_frame(spark):
    old = frame(spark, ("a", 1, "old", 0), ("b", 1, "old", 0))
    new = frame(spark, ("a", 2, None, None), ("c", 2, None, None))
    got = merged(old, new, ["k"], delete_when=F.col("v").isNull())
    assert rows(got) == [("b", 1, "old", 0)]


def test_touch_moves_only_on_change(spark):
    old = frame(spark, ("a", 1, "same", 0), ("b", 1, "old", 0))
    new = frame(spark, ("a", "same"), ("b", "new"), ("c", "new"), schema="k string, v string")
    got = merged(old, new, ["k"], touch={"t": F.lit(9)})
    assert rows(got.select("k", "t", "v")) == [("a", 1, "same"), ("b", 9, "new"), ("c", 9, "new")]


def test_insert_if_absent_keeps_the_first(spark):
    t = table(spark, ("a", 1, "old", 0))
    offered = frame(spark, ("a", 2, "ignored", 1), ("b", 2, "second", 2), ("b", 1, "first", None))
    t.append_absent(offered, ["t"], defaults={"money": F.lit(5)})
    assert rows(t.read()) == [("a", 1, "old", 0), ("b", 1, "first", 5)]


def test_absent_rows_are_appended_and_no_file_is_rewritten(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=3).create(frame(spark, *[(f"k{i}", 1, "old", i) for i in range(20)]))
    before = {(f, f.stat().st_mtime_ns) for f in (tmp_path / "t").rglob("*.parquet")}
    for _ in range(2):
        t.append_absent(frame(spark, ("k1", 9, "x", 0), ("n", 9, "x", 0), (None, 9, "x", 0)), ["t"])
    assert before < {(f, f.stat().st_mtime_ns) for f in (tmp_path / "t").rglob("*.parquet")}
    assert t.read().count() == 21 and t.read().where("v = 'x'").count() == 1


def test_removed_keys_of_an_otherwise_empty_bucket_go(spark):
    t = table(spark, ("a", 1, "old", 0), buckets=1)
    t.upsert(frame(spark, ("a", 2, None, None)), delete_when=F.col("v").isNull())
    assert t.read().count() == 0
    t.upsert(frame(spark))
    assert t.read().count() == 0
    t.upsert(frame(spark, ("a", 3, "back", 1)), update=["v"])
    assert rows(t.read()) == [("a", 3, "back", 1)]


def test_another_number_of_buckets_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    made = KeyedTable(spark, path, ["k"], buckets=4).create(
        spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("v"))
    )
    again = KeyedTable(spark, path, ["k"], made.schema, buckets=7)
    again.upsert(frame(spark, ("3", 1), schema="k string, v int"))
    assert made.read().count() == 100 and made.read().filter("v = 1").count() == 1


def test_rows_without_a_key_are_not_merged(spark):
    t = table(spark, ("a", 1, "old", 0))
    for _ in range(2):
        t.upsert(frame(spark, (None, 2, "new", 1), ("b", 2, "new", 1)))
    assert rows(t.read()) == [("a", 1, "old", 0), ("b", 2, "new", 1)]


def test_a_guard_of_two_columns_decides_ties(spark):
    t = table(spark, ("a", 5, "x", 10))
    t.upsert(frame(spark, ("a", 5, "stale", 9)), newer_by=["t", "money"])
    assert rows(t.read()) == [("a", 5, "x", 10)]
    t.upsert(frame(spark, ("a", 5, "later", 11)), newer_by=["t", "money"])
    assert rows(t.read()) == [("a", 5, "later", 11)]


def test_a_failed_merge_leaves_the_old_rows(spark):
    t = table(spark, ("a", 1, "old", 0))
    broken = frame(spark, ("a", 2, "new", 0)).withColumn("money", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        t.upsert(broken)
    assert rows(t.read()) == [("a", 1, "old", 0)]
    t.upsert(frame(spark, ("a", 2, "new", 0)))
    assert rows(t.read()) == [("a", 2, "new", 0)]


def test_empty_table_and_empty_batch(spark):
    t = KeyedTable(spark, shared_dir(spark, "test-empty"), ["k"], buckets=2).create(frame(spark))
    assert t.read().count() == 0
    t.upsert(frame(spark))
    t.upsert(frame(spark, ("a", 1, "x", 0)))
    assert rows(t.read()) == [("a", 1, "x", 0)]


@pytest.mark.parametrize("seed", range(3))
def test_batches_in_sequence_equal_one_merge_under_the_time_guard(spark, seed):
    """Times are unique, so the result must not depend on how the rows are cut into batches."""
    draw = random.Random(seed)
    data = [(draw.choice("abcdef"), time, f"v{time}", time) for time in draw.sample(range(100), 30)]
    step = table(spark)
    for start in range(0, 30, 10):
        step.upsert(frame(spark, *data[start : start + 10]), order=["t"], newer_by="t")
    whole = latest_per_key(frame(spark, *data), ["k"], ["t"])
    assert rows(step.read()) == rows(whole)
