"""Golden rows for change capture, quality, evolution, monitoring, metrics and connectors."""

import datetime
import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderweir import schemas
from orderweir.functions.calendar import calendar_between
from orderweir.operators import cdc, evolve, hotkeys, metrics, monitor, quality
from orderweir.session import shared_dir
from orderweir.sources import connectors
from orderweir.sources.changes import parse_changes
from orderweir.sources.landing import Landing
from orderweir.plans.warehouse import Warehouse
from orderweir.streaming.sinks import append_json

ROW = "struct<id:bigint, name:string>"
C360 = "mdm_mysql.mdm.customer360"


def change(op, before=None, after=None, ts=1, lsn=1, wrap=False):
    body = {"before": before, "after": after, "op": op, "ts_ms": ts, "source": {"lsn": lsn}}
    return json.dumps({"schema": {}, "payload": body} if wrap else body)


def decoded(spark, *messages, topic=C360):
    df = spark.createDataFrame([(topic, "1", m) for m in messages], "topic string, key string, value string")
    return parse_changes(df, ROW).withColumn("position", F.col("source.lsn")).withColumn(
        "id", F.coalesce("after.id", "before.id")
    )


def test_delete_takes_before_and_others_after(spark):
    df = decoded(
        spark,
        change("d", before={"id": 1, "name": "gone"}, wrap=True),
        change("u", before={"id": 1, "name": "old"}, after={"id": 1, "name": "new"}),
        change("r", after={"id": 2, "name": "read"}),
    )
    got = cdc.curated(df).select("topic", "entity", "operation", "data.name")
    assert rows(got) == [
        ("mdm_customer", "customer", "d", "gone"),
        ("mdm_customer", "customer", "r", "read"),
        ("mdm_customer", "customer", "u", "new"),
    ]


def test_no_row_image_tombstone_and_foreign_topic_are_dropped(spark):
    assert cdc.curated(decoded(spark, change("u"), None)).count() == 0
    assert cdc.curated(decoded(spark, change("c", after={"id": 1}), topic="mdm_mysql.mdm.mdm_date")).count() == 0


def test_curated_message_keeps_key_and_nulls(spark):
    got = cdc.curated_messages(decoded(spark, change("c", after={"id": 1, "name": None}))).first()
    assert got.key == "1"
    assert json.loads(got.value) == {
        "entity": "customer",
        "operation": "c",
        "sourceTsMs": 1,
        "data": {"id": 1, "name": None},
    }


def test_current_state_follows_the_last_change(spark):
    df = decoded(
        spark,
        change("c", after={"id": 1, "name": "a"}, ts=1, lsn=1),
        change("u", after={"id": 1, "name": "b"}, ts=2, lsn=2),
        change("c", after={"id": 2, "name": "x"}, ts=1, lsn=3),
        change("d", before={"id": 2, "name": "x"}, ts=5, lsn=4),
        change("c", after={"id": 3, "name": "p"}, ts=7, lsn=5),
        change("u", after={"id": 3, "name": "q"}, ts=7, lsn=6),
    )
    assert rows(cdc.current_state(df, ["id"]).select("id", "after.name")) == [(1, "b"), (3, "q")]


def test_history_ends_at_delete_and_restarts(spark):
    df = decoded(
        spark,
        change("c", after={"id": 1, "name": "a"}, ts=10, lsn=1),
        change("d", before={"id": 1, "name": "a"}, ts=20, lsn=2),
        change("c", after={"id": 1, "name": "b"}, ts=30, lsn=3),
    )
    got = cdc.history(df, "id").select("after.name", "valid_from_ms", "valid_to_ms", "is_current")
    assert rows(got) == [("a", 10, 20, False), ("b", 30, None, True)]


def test_accepted_values_ignore_null(spark):
    df = spark.createDataFrame([("USD", True), ("EUR", None), (None, False)], "currency string, is_weekend boolean")
    got = quality.accepted_values(df, {"currency": ["USD"], "is_weekend": [True, False]})
    assert rows(got.select("check_name", "failures")) == [
        ("accepted_values_currency", 1),
        ("accepted_values_is_weekend", 0),
    ]


def test_relationship_counts_rows_and_honours_scope(spark):
    child = spark.createDataFrame([("CUST-1",), ("CUST-2",), ("CUST-2",), ("X-3",), (None,)], "c string")
    parent = spark.createDataFrame([("CUST-1",)], "id string")
    scoped = quality.relationship("rel", child, "c", parent, "id", "warn", F.col("c").like("CUST-%"))
    assert rows(scoped) == [("rel", "warn", 2)]
    assert rows(quality.relationship("rel", child, "c", parent, "id")) == [("rel", "error", 3)]


def test_all_declared_checks_run(landing):
    from orderweir.plans.models import Models

    models = Models(landing)
    got = quality.fact_checks(models.fact_sales_order, models.dim_customer, models.dim_product, models.dim_date)
    assert got.count() == 10


def test_quarantine_reasons(spark):
    df = spark.createDataFrame([("1.005",), ("abc",), (None,)], "amount string")
    got = quality.quarantine(df, "amount", "money").select("amount", F.col("money").cast("string"), "reason")
    assert rows(got) == [("1.005", "1.01", None), ("abc", None, "bad amount in amount"), (None, None, None)]


def test_parity_and_differences(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a",), ("c",)], "k string")
    assert rows(quality.parity("t", left, right, "k")) == [("t", 3, 2, 2, 1)]
    assert rows(quality.key_differences(left, right, "k")) == [("a", 1), ("b", 1), ("c", -1)]


def test_added_columns_are_null_and_changed_types_are_refused(spark):
    old = spark.createDataFrame([(1,)], "id int")
    new = spark.createDataFrame([(2, "x")], "id int, note string")
    assert rows(evolve.additive_union(old, new)) == [(1, None), (2, "x")]
    with pytest.raises(evolve.IncompatibleSchema, match="id: int became string"):
        evolve.additive_union(old, spark.createDataFrame([("3",)], "id string"))


def test_no_drift_gives_no_rows(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert evolve.drift_report("t", df, StructType.fromDDL("id int")).count() == 0
    assert evolve.empty_clone(df).schema == df.schema and evolve.empty_clone(df).count() == 0


def brute_force(samples, seconds):
    """Window results by looking at every pair, in plain Python."""
    out = {}
    for series, t, v in samples:
        inside = sorted((t2, v2) for s2, t2, v2 in samples if s2 == series and 0 <= (t - t2).total_seconds() <= seconds)
        grown = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
        out[series, t] = (max(v2 for _, v2 in inside), grown)
    return out


def test_range_windows_across_blocks(spark):
    start = datetime.datetime(2026, 1, 1)
    samples = [
        (f"s{i % 2}", start + datetime.timedelta(seconds=17 * i + (i * i) % 13), (i * 37) % 50) for i in range(120)
    ]
    df = spark.createDataFrame(samples, "series string, t timestamp_ntz, v bigint")
    want = brute_force(samples, 90)
    highest = monitor.max_over_time(df, ["series"], "t", "v", 90)
    grown = monitor.increase(df.withColumn("id", F.monotonically_increasing_id()), ["series"], "t", "v", 90, "id")
    assert {(r.series, r.t): r.max_value for r in highest.collect()} == {k: v[0] for k, v in want.items()}
    assert {(r.series, r.t): r["increase"] for r in grown.collect()} == {k: v[1] for k, v in want.items()}


@pytest.mark.parametrize("seconds", [1, 2, 60])
def test_one_busy_series_is_spread_over_tasks(spark, monkeypatch, seconds):
    """All rows in ten minutes of one series, many of them in one millisecond, counted in slices of 200 rows."""
    monkeypatch.setattr(hotkeys, "MAX_ROWS", 200)
    start = datetime.datetime(2026, 1, 1)
    draw = random.Random(4)
    samples = [("s", start + datetime.timedelta(milliseconds=draw.choice([5_000, draw.randrange(600_000)])), i, draw.randrange(1_000))
               for i in range(1_500)]
    df = spark.createDataFrame(samples, "series string, t timestamp_ntz, id bigint, v bigint").repartition(3)
    in_order = sorted(samples, key=lambda x: (x[1], x[2]))
    want = {}
    for _, t, i, _ in samples:
        inside = [v for _, t2, _, v in in_order if 0 <= (t - t2).total_seconds() <= seconds]
        want[i] = (max(inside), sum(b if b < a else b - a for a, b in zip(inside, inside[1:])))
    highest = monitor.max_over_time(df, ["series"], "t", "v", seconds)
    grown = monitor.increase(df, ["series"], "t", "v", seconds, "id")
    assert {r.id: r.max_value for r in highest.collect()} == {i: w[0] for i, w in want.items()}
    assert {r.id: r["increase"] for r in grown.collect()} == {i: w[1] for i, w in want.items()}
    plan = highest._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert windows and all("_part" in line.split("windowspecdefinition")[1] for line in windows)


def test_ranges_of_missing_times_and_series(spark):
    at = datetime.datetime(1969, 12, 31, 23, 59, 59, 500_000)  # before the epoch
    data = [(None, at, 1, 4), (None, at + datetime.timedelta(seconds=1), 2, 1), ("s", None, 3, 9), ("s", at, 4, None)]
    df = spark.createDataFrame(data, "series string, t timestamp_ntz, id bigint, v bigint")
    highest = {r.id: r.max_value for r in monitor.max_over_time(df, ["series"], "t", "v", 60).collect()}
    assert highest == {1: 4, 2: 4, 3: 9, 4: None}
    assert monitor.increase(df, ["series"], "t", "v", 60, "id").count() == 4


def test_sketches_of_hours_merge_to_any_period(spark):
    rows_in = spark.range(20_000).select(
        F.lit("g").alias("g"), (F.col("id") * 7919 % 20_011).alias("d"), F.timestamp_seconds(F.col("id") * 60).alias("t")
    )
    hourly = monitor.delay_sketches(rows_in, ["g"], "t", "d")
    assert hourly.count() == 334
    for part, share in ((hourly, 0.95), (hourly.where("period < timestamp'1970-01-08'"), 0.5)):
        found = monitor.sketched_quantile(part, ["g"], share)
        seen = rows_in if share == 0.95 else rows_in.where("t < timestamp'1970-01-08'")
        exact = monitor.rank_error(seen, ["g"], "d", found, share).first()
        assert exact["rank_error"] <= 0.01 and exact["events"] == found.first()["events"] == seen.count()


def test_row_parity_sees_changes_losses_and_doubles(spark):
    left = spark.range(1_000).select("id", (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("n"))
    row = lambda *x: spark.createDataFrame([x], left.schema)
    right = left.where("id not in (3, 4, 5)").unionByName(row(3, 99, None)).unionByName(row(5, 5, None)).unionByName(row(5, 5, None))
    assert rows(quality.row_parity("t", left, right, "id", buckets=16)) == [("t", 1_000, 1_000, 1, 1, 1)]
    assert rows(quality.row_differences(left, right, "id", buckets=16)) == [(3, 3, None, 1), (3, 99, None, -1), (4, 4, None, 1), (5, 5, None, -1)]
    assert rows(quality.row_parity("t", left, left.repartition(5), "id")) == [("t", 1_000, 1_000, 0, 0, 0)]
    assert rows(quality.row_parity("t", left.limit(0), left, "id")) == [("t", 0, 1_000, 0, 0, 1_000)]
    # Keys alone see two of the three faults.
    assert rows(quality.parity("t", left, right, "id")) == [("t", 1_000, 1_000, 1, 1)]


@pytest.mark.parametrize("cell", [1, 7, 4096])
def test_quantile_is_exact(spark, cell):
    df = spark.range(1, 101).select(F.lit("g").alias("g"), F.col("id").alias("d"))
    got = monitor.delay_quantile(df.unionByName(df), ["g"], "d", 0.95, cell).first()
    assert (got.delay_quantile, got.events) == (95, 200)


def test_tied_samples_do_not_depend_on_the_order_of_rows(spark):
    at = datetime.datetime(2026, 1, 1)
    data = [("s", at, i, v) for i, v in enumerate([1, 5, 2])]
    for rows_in in (data, data[::-1]):
        df = spark.createDataFrame(rows_in, "series string, t timestamp_ntz, id bigint, v bigint").coalesce(1)
        grown = monitor.increase(df, ["series"], "t", "v", 60, "id")
        assert {r["increase"] for r in grown.collect()} == {6}
        up = df.withColumn("up", (F.col("v") > 2).cast("int"))
        assert tuple(monitor.probe_health(up, ["series"], "t", "up", "id").first()) == (0, 1)


def test_metric_definition(spark):
    orders = spark.sql(
        "select * from values (10, 'COMPLETED', timestamp_ntz'2026-01-05 00:00:00'), (5, 'OPEN', "
        "timestamp_ntz'2026-01-06 00:00:00') as t(order_total, order_status, order_completed_ts)"
    )
    got = metrics.GROSS_REVENUE.compute(orders).collect()
    assert [(r.period.month, int(r.gross_revenue)) for r in got] == [(1, 10)]


def test_calendar_matches_the_seeded_week(spark):
    bounds = spark.sql("select date'2026-04-14' as a, date'2026-04-20' as b")
    got = calendar_between(bounds, "a", "b").orderBy("date_key").select(
        "date_key", "day_of_week", "day_name", "week_of_year", "month_name", "quarter_of_year", "is_weekend"
    )
    assert [tuple(r) for r in got.collect()] == [
        (20260414, 3, "Tuesday", 16, "April", 2, False),
        (20260415, 4, "Wednesday", 16, "April", 2, False),
        (20260416, 5, "Thursday", 16, "April", 2, False),
        (20260417, 6, "Friday", 16, "April", 2, False),
        (20260418, 7, "Saturday", 16, "April", 2, True),
        (20260419, 1, "Sunday", 16, "April", 2, True),
        (20260420, 2, "Monday", 17, "April", 2, False),
    ]


def test_demo_seed_as_values(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('ORD-DEMO-001', 120.50D, TIMESTAMP '2026-04-18 09:00:00'), "
        "('ORD-DEMO-002', 310.25D, TIMESTAMP '2026-04-18 10:30:00'), "
        "('ORD-DEMO-003', 89.99D, TIMESTAMP '2026-04-18 11:15:00') AS s(order_id, order_total, order_ts)"
    )
    assert [r.order_id for r in df.orderBy("order_ts").collect()] == ["ORD-DEMO-001", "ORD-DEMO-002", "ORD-DEMO-003"]


def test_landing_tables_are_declared_once(spark):
    warehouse = Warehouse(spark, shared_dir(spark, "declared"), "declared_").create()
    try:
        warehouse.declare_landing().declare_landing()
        for table, columns in schemas.LANDING.items():
            found = warehouse.table("landing", table)
            assert found.columns == StructType.fromDDL(columns).names and found.count() == 0
    finally:
        warehouse.drop()


def test_catalog_statements(spark, folder):
    warehouse = Warehouse(spark, shared_dir(spark, "shown"), "shown_").create()
    try:
        warehouse.land({"mdm_date": Landing(spark, folder).mdm_date()})
        assert "shown_landing" in [r[0] for r in spark.sql("SHOW DATABASES").collect()]
        assert "mdm_date" in [r.tableName for r in spark.sql("SHOW TABLES IN shown_landing").collect()]
        assert "full_date" in [r.col_name for r in spark.sql("DESCRIBE shown_landing.mdm_date").collect()]
    finally:
        warehouse.drop()


def test_json_objects_are_few_files(spark, tmp_path):
    path = str(tmp_path / "raw")
    append_json(spark.range(1000).repartition(8), 0, path, 600)
    append_json(spark.range(1000).repartition(8), 0, path, 600)
    assert spark.read.json(path).count() == 1000
    assert len(list((tmp_path / "raw").rglob("part-*.json"))) == 2


def test_connector_options():
    options = connectors.kafka_options("b:9092", ["a", "b"], "earliest", 500)
    assert options["subscribe"] == "a,b" and options["maxOffsetsPerTrigger"] == "500"
    settings = dict(url="jdbc:x", table="t", user="u", password="p", driver="d")
    assert "numPartitions" not in connectors.jdbc_options(**settings)
    split = connectors.jdbc_options(**settings, split_on="id", low=0, high=9, parts=4)
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "4")
    with pytest.raises(ValueError):
        connectors.jdbc_options(**settings, split_on="id")
