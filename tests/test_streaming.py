"""Streams over files, run batch by batch, against the batch result."""

import datetime
import json
import os
import pathlib
import time
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderweir.functions.envelope import to_messages
from orderweir.operators import cdc, projections
from orderweir.operators.running import running_totals
from orderweir.sources import connectors
from orderweir.sources.changes import ROW, change_messages, changes, parse_changes
from orderweir.sources.order_events import order_event_json, parse_order_events
from orderweir.streaming import changelog, jobs, progress, sinks

EVENT = "arrival bigint, value string"


@pytest.fixture(scope="module")
def event_files(spark, folder, tmp_path_factory):
    """All order events in four files, cut by arrival."""
    from orderweir.sources.landing import Landing

    path = str(tmp_path_factory.mktemp("events"))
    order_event_json(Landing(spark, folder)).repartitionByRange(4, "arrival").write.mode("overwrite").parquet(path)
    # A file stream takes files by age: make their age follow the arrival order.
    for number, file in enumerate(sorted(pathlib.Path(path).glob("part-*.parquet"))):
        os.utime(file, (1_700_000_000 + number,) * 2)
    return path


def stream(spark, path, schema=EVENT, fmt="parquet"):
    return connectors.file_stream(spark, path, schema, per_batch=1, fmt=fmt)


def log(spark, path):
    return spark.read.parquet(path).drop("_batch_id", "_ingest_ts")


def test_stream_projection(spark, event_files, tmp_path):
    """Headers and lines are plain selects, so they need no state and append as they come."""
    whole = parse_order_events(spark.read.parquet(event_files))
    events = parse_order_events(stream(spark, event_files))
    for name, project in (("headers", projections.sales_orders), ("lines", projections.line_items)):
        out = str(tmp_path / name)
        writer = project(events).writeStream.format("parquet").option("path", out)
        jobs.run_available(writer, str(tmp_path / f"{name}-cp"))
        assert rows(spark.read.parquet(out)) == rows(project(whole))


def test_fanout(spark, event_files, tmp_path):
    jobs.run_available(jobs.fan_out(stream(spark, event_files), str(tmp_path / "out")), str(tmp_path / "cp"))
    events = parse_order_events(spark.read.parquet(event_files))
    assert rows(log(spark, str(tmp_path / "out/sales_order"))) == rows(projections.sales_orders(events))
    assert rows(log(spark, str(tmp_path / "out/sales_order_line_item"))) == rows(projections.line_items(events))
    assert log(spark, str(tmp_path / "out/customer_contribution")).count() == events.count()


def test_progress_table(spark, event_files, tmp_path):
    writer = stream(spark, event_files).writeStream.foreachBatch(lambda df, i: df.count())
    query = jobs.run_available(writer, str(tmp_path / "cp"))
    signals = progress.progress_table(spark, query)
    assert signals.filter("input_rows > 0").count() == 4
    assert signals.agg(F.min("batch_ms")).first()[0] >= 0


def test_stream_late_event(spark, tmp_path):
    """An older event in a later batch adds to the totals and changes nothing else."""
    source = tmp_path / "orders"
    source.mkdir()
    for number, (order, day, total) in enumerate([("SO-2", 2, "10.00"), ("SO-1", 1, "5.00")]):
        event = {
            "orderId": order,
            "orderTimestamp": f"2026-01-0{day}T00:00:00+00:00",
            "orderTotal": total,
            "customer": {"customerId": "CUST-1", "firstName": "Ava", "lastName": order},
        }
        file = source / f"{number}.json"
        file.write_text(json.dumps({"arrival": number, "value": json.dumps(event)}))
        os.utime(file, (1_700_000_000 + number,) * 2)
    events = parse_order_events(stream(spark, str(source), fmt="json"))
    totals = jobs.totals_stream(events, "arrival")
    jobs.run_available(jobs.log_totals(totals, str(tmp_path / "t")), str(tmp_path / "cp"))
    got = jobs.last_logged(spark, str(tmp_path / "t"), ["customerId"], []).first()
    assert (got.orderCount, str(got.totalSpent), got.lastOrderId, got.customerName) == (2, "15.00", "SO-2", "Ava SO-2")


def test_microbatch_bounds(spark, event_files, tmp_path):
    seen = []
    writer = stream(spark, event_files).writeStream.foreachBatch(lambda df, i: seen.append(df.count()))
    jobs.run_available(writer, str(tmp_path / "cp"))
    assert len(seen) == 4 and max(seen) < sum(seen)


def test_stream_restart(spark, event_files, tmp_path):
    """The stream stops after some files, goes on from its checkpoint, and ends where a batch would."""
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    files = sorted(pathlib.Path(event_files).glob("part-*.parquet"))
    events = parse_order_events(stream(spark, str(incoming)))
    totals = jobs.totals_stream(events, "arrival")
    whole = jobs.totals_stream(parse_order_events(spark.read.parquet(event_files)), "arrival")
    log = tmp_path / "t"
    earlier = set()
    for part in (files[:2], files[2:]):
        for file in part:
            (incoming / file.name).write_bytes(file.read_bytes())
        jobs.run_available(jobs.log_totals(totals, str(log)), str(tmp_path / "cp"))
        written = {(f, f.stat().st_mtime_ns) for f in log.rglob("*.parquet")}
        assert earlier < written  # a batch adds its own files and touches no other
        earlier = written
    state = jobs.last_logged(spark, str(log), ["customerId"], []).select(whole.columns)
    assert rows(state) == rows(whole)
    base = str(tmp_path / "compact")
    jobs.compact_log(spark, str(log), base, ["customerId"], [])
    assert rows(spark.read.parquet(base).select(whole.columns)) == rows(whole)
    # A batch after the compaction is read beside its base, and goes into the next compaction.
    newer = whole.limit(1).withColumn("orderCount", F.lit(1_000).cast("bigint"))
    sinks.append_batch(newer, 1_000, str(log))
    want = rows(jobs.last_logged(spark, str(log), ["customerId"], []).select(whole.columns))
    assert rows(jobs.last_logged(spark, str(log), ["customerId"], [], base=base).select(whole.columns)) == want
    jobs.compact_log(spark, str(log), base, ["customerId"], [], base=base)
    assert rows(spark.read.parquet(base).where("_upto = 1000").select(whole.columns)) == want


def test_stream_running_total(spark, event_files, tmp_path):
    """Files one by one with a restart after each, then every batch delivered twice: still the batch result.

    A batch adds its own rows to the log and touches no earlier file.
    """
    files = sorted(pathlib.Path(event_files).glob("*.parquet"))
    assert len(files) >= 4
    incoming, log = tmp_path / "in", tmp_path / "log"
    incoming.mkdir()
    contributions = projections.customer_contributions(parse_order_events(stream(spark, str(incoming))), "arrival")
    made = changelog.snapshots(contributions, "arrival")

    def twice(batch, batch_id):
        sinks.append_batch(batch, batch_id, str(log))
        sinks.append_batch(batch, batch_id, str(log))

    earlier = set()
    for file in files:
        (incoming / file.name).write_bytes(file.read_bytes())
        jobs.run_available(made.writeStream.outputMode("append").foreachBatch(twice), str(tmp_path / "cp"))
        written = {(f, f.stat().st_mtime_ns) for f in log.rglob("*.parquet")}
        assert earlier < written
        earlier = written
    batch = running_totals(
        projections.customer_contributions(parse_order_events(spark.read.parquet(event_files)), "arrival"),
        key="customerId",
        arrival="arrival",
        event_time="updatedAt",
        sums=projections.CUSTOMER_SUMS,
        latest=projections.CUSTOMER_LATEST,
    )
    want = batch.withColumn("totalSpent", F.col("totalSpent").cast("decimal(18,2)")).select(changelog.FIELDS)
    assert rows(spark.read.parquet(str(log)).select(changelog.FIELDS)) == rows(want)


CONTRIBUTION = (
    "customerId string, customerName string, customerEmail string, customerSegment string, orderCount bigint, "
    "totalSpent decimal(18,2), lastOrderId string, updatedAt timestamp_ntz, currency string, arrival bigint"
)


def contribution(arrival, order, day, total="1.00", customer="c"):
    at = None if day is None else datetime.datetime(2026, 1, day)
    return customer, f"name-{order}", None, None, 1, None if total is None else Decimal(total), order, at, "USD", arrival


def test_changelog_keeps_newer_attributes(spark, tmp_path):
    """Late, undated and equally dated events, missing amounts and events without a customer."""
    batches = [
        [contribution(3, "b", 5), contribution(1, "a", 3, "2.00"), contribution(2, "n", None, None)],
        [contribution(4, "late", 1), contribution(5, "equal", 5), contribution(6, "undated", None), contribution(7, "x", 9, customer=None)],
    ]
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, CONTRIBUTION).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(CONTRIBUTION).parquet(str(tmp_path / "in"))
        made = changelog.snapshots(source, "arrival")
        jobs.run_available(changelog.log_snapshots(made, str(tmp_path / "log")), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "log")).orderBy("orderCount").collect()
    assert [(r["orderCount"], r["totalSpent"], r["lastOrderId"], r["updatedAt"] and r["updatedAt"].day) for r in got] == [
        (1, Decimal("2.00"), "a", 3), (2, Decimal("2.00"), "a", 3), (3, Decimal("3.00"), "b", 5),
        (4, Decimal("4.00"), "b", 5), (5, Decimal("5.00"), "equal", 5), (6, Decimal("6.00"), "equal", 5),
    ]


def test_changelog_expiry_restarts_totals(spark, tmp_path):
    """A customer without events for longer than the given time starts anew."""
    log = tmp_path / "log"
    for number in range(2):
        spark.createDataFrame([contribution(number, f"o{number}", 2)], CONTRIBUTION).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(CONTRIBUTION).parquet(str(tmp_path / "in"))
        made = changelog.snapshots(source, "arrival", keep_for=datetime.timedelta(milliseconds=1))
        query = jobs.run_every(changelog.log_snapshots(made, str(log)), str(tmp_path / "cp"), "1 second")
        deadline = time.time() + 60
        while time.time() < deadline and len(list(log.glob("_batch_id=*/*.parquet"))) <= number:
            time.sleep(0.2)
        query.stop()
    assert [r["orderCount"] for r in spark.read.parquet(str(log)).collect()] == [1, 1]


def topic_rows(spark, path, *values):
    """Write topic records as JSON lines, one file per list of values."""
    for number, batch in enumerate(values):
        lines = [
            json.dumps(
                {
                    "topic": "sales_order",
                    "partition": 0,
                    "offset": offset,
                    "key": None,
                    "value": value,
                    "timestamp": f"2026-01-01T00:00:{offset:02d}.000Z",
                }
            )
            for offset, value in batch
        ]
        file = path / f"{number:03d}.json"
        file.write_text("\n".join(lines))
        os.utime(file, (1_700_000_000 + number,) * 2)


def order_message(order, total, ms):
    return json.dumps({"schema": {}, "payload": {"orderId": order, "orderTotal": total, "orderTimestamp": ms}})


@pytest.mark.parametrize("guard,total", [(None, "3.00"), ("order_timestamp", "5.00")])
def test_merge_across_batches(spark, tmp_path, guard, total):
    """Arrival order wins without a guard; with it the older record of a later batch is ignored."""
    source = tmp_path / "topic"
    source.mkdir()
    topic_rows(
        spark,
        source,
        [(1, order_message("SO-1", "4.00", 4000)), (2, order_message("SO-1", "5.00", 5000)), (3, None)],
        [(4, order_message("SO-1", "3.00", 3000)), (5, order_message("", "9.00", 1)), (6, order_message(None, "9.00", 1))],
    )
    log = str(tmp_path / "t")
    writer = connectors.file_stream(spark, str(source), per_batch=1).writeStream.foreachBatch(
        sinks.merge_topic(log, "sales_order", guard=guard)
    )
    jobs.run_available(writer, str(tmp_path / "cp"))
    got = sinks.topic_state(spark, log, "sales_order", guard=guard).collect()
    assert [(r.order_id, str(r.order_total)) for r in got] == [("SO-1", total)]


def test_merge_last_wins(spark, tmp_path):
    """In one batch the record with the highest position wins, whatever its own time says."""
    log = str(tmp_path / "t")
    stamp = datetime.datetime(2026, 1, 1)
    batch = spark.createDataFrame(
        [
            ("sales_order", 0, 2, None, order_message("SO-1", "2.00", 1), stamp),
            ("sales_order", 0, 1, None, order_message("SO-1", "1.00", 9), stamp),
            ("customer_sales", 0, 3, None, '{"customerId": "SO-1"}', stamp),
        ],
        connectors.MESSAGE,
    )
    sinks.merge_topic(log, "sales_order")(batch, 0)
    assert [str(r.order_total) for r in sinks.topic_state(spark, log, "sales_order").collect()] == ["2.00"]


def test_merge_replay(spark, tmp_path):
    log = str(tmp_path / "t")
    write = sinks.merge_topic(log, "sales_order")
    batch = spark.createDataFrame(
        [("sales_order", 0, 1, None, order_message("SO-1", "4.00", 1), datetime.datetime(2026, 1, 1))], connectors.MESSAGE
    )
    write(batch, 7)
    once = rows(sinks.topic_state(spark, log, "sales_order"))
    write(batch, 7)
    assert rows(sinks.topic_state(spark, log, "sales_order")) == once and len(once) == 1


def test_stream_quarantine(spark, tmp_path):
    source = tmp_path / "raw"
    source.mkdir()
    (source / "a.json").write_text('{"id": 1, "amount": "1.50"}\n{"id": 2, "amount": "abc"}\n')
    raw = connectors.file_stream(spark, str(source), "id int, amount string")
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    writer = raw.writeStream.foreachBatch(sinks.split_good_and_bad("amount", "money", good, bad))
    jobs.run_available(writer, str(tmp_path / "cp"))
    assert [r.id for r in spark.read.parquet(good).collect()] == [1]
    assert [(r.id, r.reason) for r in spark.read.parquet(bad).collect()] == [(2, "bad amount in amount")]


def test_cdc_chain(spark, landing, tmp_path):
    """Messages to an immutable log, the log to current state: the same rows as one batch."""
    source, bronze = str(tmp_path / "topic"), str(tmp_path / "bronze")
    change_messages(landing).repartition(3).write.parquet(source)
    schema = "topic string, key string, value string"
    decoded = parse_changes(stream(spark, source, schema)).withColumn("position", F.col("source.lsn")).withColumn(
        "entity_id", F.coalesce("after.user_id", "before.user_id")
    )
    jobs.run_available(jobs.changes_to_bronze(decoded, bronze), str(tmp_path / "cp1"))
    log_schema = spark.read.parquet(bronze).schema
    log_stream = spark.readStream.schema(log_schema).option("maxFilesPerTrigger", 1).parquet(bronze)
    last = str(tmp_path / "last")
    jobs.run_available(jobs.bronze_to_current(log_stream, ["entity_id"], last), str(tmp_path / "cp2"))
    want = cdc.current_state(changes(landing), ["entity_id"]).select("entity_id", "ts_ms", "after.value")
    assert rows(jobs.current_of(spark, ["entity_id"], last).select("entity_id", "ts_ms", "value")) == rows(want)


def test_state_does_not_depend_on_the_batches_of_tied_changes(spark, tmp_path):
    kind = "entity_id bigint, ts_ms bigint, position bigint, op string, after struct<value: string>"
    source = tmp_path / "log"
    for number, (position, value) in enumerate([(10, "b"), (9, "a")]):
        one = spark.createDataFrame([(1, 5, position, "u", (value,))], kind)
        one.coalesce(1).write.parquet(str(source / f"n={number}"))
    last = str(tmp_path / "last")
    log = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(source))
    jobs.run_available(jobs.bronze_to_current(log, ["entity_id"], last), str(tmp_path / "cp"))
    assert [r.value for r in jobs.current_of(spark, ["entity_id"], last).collect()] == ["b"]


def test_no_distinct_change_is_lost_however_late(spark, tmp_path):
    kind = "key string, position bigint, ts_ms bigint"
    hour = 3_600_000
    batches = [[("a", 4, 100 * hour), ("a", 3, 99 * hour)], [("a", 1, hour), ("a", 4, 100 * hour)], [("a", 2, 2 * hour), ("a", 1, hour)]]
    source = tmp_path / "in"
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, kind).coalesce(1).write.parquet(str(source / f"n={number}"))
    stream_in = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(source))
    out = str(tmp_path / "out")
    writer = jobs.dedupe_stream(stream_in, ["key"]).writeStream.foreachBatch(lambda df, i: sinks.append_batch(df, i, out))
    jobs.run_available(writer, str(tmp_path / "cp"))
    assert sorted(r.position for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]


def test_cdc_dedupe(spark, landing, tmp_path):
    source = str(tmp_path / "topic")
    once = change_messages(landing)
    once.coalesce(1).write.mode("append").parquet(source)
    once.coalesce(1).write.mode("append").parquet(source)
    decoded = parse_changes(stream(spark, source, "topic string, key string, value string"), ROW).withColumn(
        "position", F.col("source.lsn")
    )
    out = str(tmp_path / "out")
    kept = jobs.dedupe_stream(decoded, ["key"])
    writer = kept.writeStream.foreachBatch(lambda df, i: sinks.append_batch(df, i, out))
    jobs.run_available(writer, str(tmp_path / "cp"))
    assert spark.read.parquet(out).count() == once.count()


def test_envelope_messages_as_a_stream(spark, event_files):
    headers = projections.to_wire(
        projections.sales_orders(parse_order_events(stream(spark, event_files))), "sales_order"
    )
    assert to_messages(headers, "sales_order").isStreaming


def test_table_as_stream_source(spark, tmp_path):
    from orderweir.plans.warehouse import Warehouse

    warehouse = Warehouse(spark, str(tmp_path / "w"), "streamed_").create()
    try:
        spark.range(10).write.saveAsTable(warehouse.name("landing", "numbers"))
        out = str(tmp_path / "out")
        numbers = connectors.table_stream(spark, warehouse.name("landing", "numbers"), per_batch=4)
        writer = numbers.writeStream.foreachBatch(lambda df, i: sinks.append_batch(df, i, out))
        jobs.run_available(writer, str(tmp_path / "cp"))
        assert spark.read.parquet(out).count() == 10
    finally:
        warehouse.drop()


def test_interval_trigger(spark, event_files, tmp_path):
    out = str(tmp_path / "out")
    writer = stream(spark, event_files).writeStream.foreachBatch(lambda df, i: sinks.append_batch(df, i, out))
    query = jobs.run_every(writer, str(tmp_path / "cp"), "100 milliseconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == spark.read.parquet(event_files).count()


def test_full_refresh_replaces_and_empties(spark, tmp_path):
    path = str(tmp_path / "mdm")
    assert sinks.full_refresh(spark, {"t": spark.range(5)}, path) == {"t": 5}
    assert sinks.full_refresh(spark, {"t": spark.range(3)}, path) == {"t": 3}
    assert spark.read.parquet(f"{path}/t").count() == 3
    assert sinks.full_refresh(spark, {"t": spark.range(0)}, path) == {"t": 0}
    assert spark.read.schema("id bigint").parquet(f"{path}/t").count() == 0


def test_every_batch_is_logged(spark, event_files, tmp_path):
    log = progress.ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        writer = stream(spark, event_files).writeStream.foreachBatch(lambda df, i: df.count())
        jobs.run_available(writer, str(tmp_path / "cp"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(log)
    done = {r.batch_id: r.input_rows for r in log.read().collect()}
    assert set(range(4)) <= set(done) and sum(done.values()) == spark.read.parquet(event_files).count()
