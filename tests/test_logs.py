"""Histories kept batch by batch, logs with an index, chunked snapshots, compacted JSON."""

import pathlib
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderweir.operators import cdc, history, snapshot
from orderweir.sources.log_index import IndexedLog
from orderweir.streaming.compaction import JsonLog

CHANGE = "k string, ts_ms bigint, position bigint, op string, after struct<v:int>"


def random_changes(seed, n, keys=4):
    draw = random.Random(seed)
    out = []
    for position in range(n):
        op = draw.choice("cuuud")
        out.append((f"k{min(draw.randrange(keys * 3), keys - 1)}", draw.randrange(n), position, op, None if op == "d" else (position,)))
    return out


def new_log(spark, path, data):
    changes = spark.createDataFrame(data, CHANGE)
    return changes, history.HistoryLog(spark, str(path), "k", history.log_schema(changes, "k")).create()


@pytest.mark.parametrize("seed,batches,max_rows", [(1, 1, None), (2, 5, None), (3, 4, 5)])
def test_history_by_batches_equals_the_whole(spark, tmp_path, seed, batches, max_rows):
    """Changes dealt to batches at random, every batch taken twice, hot keys in slices of five rows."""
    data = random_changes(seed, 120)
    changes, log = new_log(spark, tmp_path / "h", data)
    draw = random.Random(seed)
    dealt = [draw.randrange(batches) for _ in data]
    for batch in range(batches):
        part = spark.createDataFrame([c for c, b in zip(data, dealt) if b == batch], CHANGE)
        log.take(part.unionByName(part), batch, max_rows)
        log.take(part, batch, max_rows)
    want = cdc.history(changes, "k")
    assert rows(log.versions().select(want.columns)) == rows(want)


def test_a_late_change_appends_two_rows_only(spark, tmp_path):
    """It cuts one closed version; the other rows of the key and of other keys are not written again."""
    data = [("a", 10 * i, i, "u", (i,)) for i in range(50)] + [("b", 5, 900, "c", (1,))]
    _, log = new_log(spark, tmp_path / "h", data)
    log.take(spark.createDataFrame(data, CHANGE), 0)
    log.take(spark.createDataFrame([("a", 205, 77, "d", None)], CHANGE), 1)
    written = spark.read.parquet(str(tmp_path / "h")).where("_batch_id = 1")
    assert rows(written.select("ts_ms", "op", "ends.ts_ms")) == [(200, "u", 205), (205, "d", 210)]
    cut = log.versions().where("valid_from_ms = 200").first()
    assert (cut["valid_to_ms"], cut["is_current"]) == (205, False)
    assert log.versions().where("k = 'a'").count() == 50


def test_history_of_odd_batches(spark, tmp_path):
    """Empty batches, changes without a key or a time, equal times in the order of the log."""
    data = [(None, 1, 1, "u", (1,)), ("a", None, 2, "u", (2,)), ("a", 5, 4, "u", (4,)), ("a", 5, 3, "u", (3,))]
    _, log = new_log(spark, tmp_path / "h", data)
    log.take(spark.createDataFrame([], CHANGE), 0)
    assert log.versions().count() == 0
    log.take(spark.createDataFrame(data, CHANGE), 1)
    log.take(spark.createDataFrame([], CHANGE), 2)
    assert rows(log.versions().select("position", "valid_to_ms", "is_current")) == [(3, 5, False), (4, None, True)]


MESSAGE = "topic string, key string, value string"


def messages(spark, times):
    return spark.createDataFrame([("t", str(i), None if t is None else f'{{"payload": {{"ts_ms": {t}}}}}') for i, t in enumerate(times)], MESSAGE)


def test_replay_reads_only_files_it_needs(spark, tmp_path):
    log = IndexedLog(spark, str(tmp_path), MESSAGE)
    for batch in range(8):
        log.append(messages(spark, range(1_000 * batch, 1_000 * batch + 1_000)), batch)
    log.append(messages(spark, [10, 20, 7_999]), 8)  # late ones beside a recent one
    everything = len(list(pathlib.Path(tmp_path, "log").rglob("*.parquet")))
    replay = log.replay(7_500)
    assert 0 < len(replay.inputFiles()) < everything / 2
    got = sorted(int(r[0]) for r in replay.select(log.time).collect())
    assert got == [*range(7_500, 8_000), 7_999]
    window = log.replay(0, 15)
    assert sorted(int(r[0]) for r in window.select(log.time).collect()) == sorted([*range(15), 10])
    assert log.replay(9_000).count() == 0 and log.files_since(9_000) == []


def test_a_repeated_batch_replaces_its_files_and_index(spark, tmp_path):
    log = IndexedLog(spark, str(tmp_path), MESSAGE)
    log.append(messages(spark, [1, 2, None]), 0)
    log.append(messages(spark, [5, 6, None]), 0)
    assert log.replay(0).count() == 3 and log.replay(6).count() == 2  # one without a time is in every replay
    assert log.index().agg(F.sum("messages")).first()[0] == 3


def test_a_body_is_looked_into_when_it_is_appended_only(spark, tmp_path):
    """Once for the ranges of the files and once for the files; the index and replays take the time kept beside it."""
    looked = spark.sparkContext.accumulator(0)

    def first_number(value):
        looked.add(1)
        return int("".join(filter(str.isdigit, value)))

    log = IndexedLog(spark, str(tmp_path), MESSAGE, F.udf(first_number, "long")("value"))
    log.append(messages(spark, range(100)), 0)
    assert sorted(int(r["key"]) for r in log.replay(90).collect()) == list(range(90, 100))
    assert looked.value <= 200


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshot_in_chunks_under_changes(spark, seed):
    """Three chunks, each read at any moment between its marks, changes all the time: equal to the log replayed."""
    draw = random.Random(seed)
    log = [(f"k{draw.randrange(9)}", p, draw.choice("cuud"), (p,)) for p in range(90)]
    log = [(k, p, op, None if op == "d" else after) for k, p, op, after in log]
    chunk_rows = []
    for chunk in range(3):
        low, high = 30 * chunk - 1, 30 * chunk + 29
        state = {}
        for k, p, op, after in log:
            if p <= draw.randint(low, high):  # rows of a chunk need not be read at one moment
                state[k] = after
        chunk_rows += [(k, after, low, high) for k, after in state.items() if int(k[1]) % 3 == chunk and after]
    # A row read at another moment than its neighbours still holds the key's state of some moment between the marks.
    replayed = {}
    for k, p, op, after in log:
        replayed[k] = (p, after) if op != "d" else None
    changes = spark.createDataFrame(log, "k string, position bigint, op string, after struct<v:int>")
    rows_in = spark.createDataFrame(chunk_rows, "k string, after struct<v:int>, low bigint, high bigint")
    # The log may begin with the first chunk's low mark and needs nothing from before it.
    got = {r["k"]: r["after"]["v"] for r in snapshot.state_at(rows_in, changes, "k").collect()}
    assert got == {k: x[1][0] for k, x in replayed.items() if x}


def test_reads_in_conflict_are_left_to_the_log(spark):
    changes = spark.createDataFrame([("a", 5, "u", (9,)), ("b", 5, "d", None), ("c", 99, "u", (7,))], "k string, position bigint, op string, after struct<v:int>")
    rows_in = spark.createDataFrame([("a", (1,), 0, 10), ("b", (2,), 0, 10), ("c", (3,), 0, 10), ("d", (4,), 0, 10)], "k string, after struct<v:int>, low bigint, high bigint")
    assert rows(snapshot.settled_reads(rows_in, changes, "k").select("k", "position")) == [("c", 10), ("d", 10)]
    assert rows(snapshot.state_at(rows_in, changes, "k").select("k", "after.v")) == [("a", 9), ("c", 7), ("d", 4)]
    assert rows(snapshot.state_at(rows_in, changes, "k", mark=10).select("k", "after.v")) == [("a", 9), ("c", 3), ("d", 4)]


def test_json_batches_are_put_together(spark, tmp_path):
    """Fewer files, the same records; a reader that began before goes on; repeated and later calls add nothing."""
    log = JsonLog(spark, str(tmp_path), "id bigint, note string")
    part = lambda b: spark.range(b * 100, b * 100 + 100).selectExpr("id", "if(id % 9 = 0, null, concat('n ', id, '\u00e9')) as note")
    for batch in range(3):
        part(batch).repartition(10).withColumn("_batch_id", F.lit(batch)).write.mode("append").partitionBy("_batch_id").json(log.raw)
    want = rows(log.read())
    reader = log.read()
    files = lambda path: len(list(pathlib.Path(path).rglob("part-*")))
    assert files(log.raw) == 30
    assert log.compact(upto=1) == 2 and files(log.packed) == 2
    assert rows(log.read()) == want and rows(reader) == want
    assert log.read().where("_batch_id < 2").select(F.input_file_name()).distinct().count() == 2
    assert log.compact(upto=1) == 0
    log.append(part(3), 3)
    size = sum(f.stat().st_size for f in pathlib.Path(log.raw, "_batch_id=2").glob("part-*"))
    assert log.compact(upto=3, target_bytes=size // 3) in (4, 5)
    assert rows(log.read().where("_batch_id < 3")) == want and log.read().count() == 400
