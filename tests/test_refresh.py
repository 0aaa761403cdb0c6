"""Fact and summary refreshed by batches against the full build over the last rows."""

import datetime
import pathlib
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderweir import session
from orderweir.functions.calendar import calendar_between
from orderweir.operators.latest import latest_per_key
from orderweir.plans import bronze, gold, models, silver
from orderweir.plans.refresh import MONTH, Refresh

LINE = (
    "order_id string, order_timestamp timestamp_ntz, customer_id string, customer_name string, line_item_id string, "
    "sku string, product_name string, quantity int, unit_price decimal(18,2), line_total decimal(18,2), currency string"
)
HEAD = (
    "order_id string, order_timestamp timestamp_ntz, customer_id string, customer_name string, customer_email string, "
    "customer_segment string, currency string, order_total decimal(18,2), line_item_count int"
)
SNAP = (
    "customer_id string, customer_name string, customer_email string, customer_segment string, order_count bigint, "
    "total_spent decimal(18,2), last_order_id string, updated_at timestamp_ntz, currency string"
)


def day(n):
    return None if n is None else datetime.datetime(2026, 1, 1) + datetime.timedelta(days=n)


def line(order, number, at, customer, sku, total):
    return f"O{order}", day(at), customer, f"n {customer}", f"O{order}-{number}", sku, f"p {sku}", 1, Decimal(1), Decimal(total), None


def head(order, at, customer):
    return f"O{order}", day(at), customer, f"h {customer}", None, None, "USD", Decimal(order), 2


def snap(customer, count, at):
    return customer, f"s {customer}", None, "seg", count, Decimal(count), "x", day(at), "USD"


@pytest.fixture(scope="module")
def dims(spark):
    customers = spark.createDataFrame(
        [(f"c{i}", f"master {i}", "e", "s", "USD", None, None, 3, Decimal(i), day(i), day(i)) for i in range(3)],
        "customer_id string, customer_name string, customer_email string, customer_segment string, currency string, "
        "first_order_timestamp timestamp_ntz, last_order_timestamp timestamp_ntz, projected_order_count bigint, "
        "projected_total_spent decimal(18,2), projection_updated_at timestamp_ntz, updated_at timestamp_ntz",
    )
    products = spark.createDataFrame([("s1", "one")], "product_id string, product_name string")
    span = spark.createDataFrame([(day(20).date(), day(200).date())], "a date, b date")
    dates = silver.dim_mdm_date(bronze.stage("stg_mdm_date", calendar_between(span, "a", "b")))
    return customers, products, dates


def frames(spark, lines, heads, snaps):
    return [spark.createDataFrame(x, kind) for x, kind in ((lines, LINE), (heads, HEAD), (snaps, SNAP))]


def new_job(spark, path):
    return Refresh(spark, str(path), *[df.schema for df in frames(spark, [], [], [])], buckets=3).create()


def full(batches, dims):
    """Fact and summary over the last version of every row."""
    last = []
    for i, keys in ((0, ["line_item_id"]), (1, ["order_id"])):
        parts = [b[i].withColumn("b", F.lit(n)) for n, b in enumerate(batches)]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        last.append(latest_per_key(whole, keys, ["b"]).drop("b"))
    snaps = batches[0][2]
    for b in batches[1:]:
        snaps = snaps.unionByName(b[2])
    fact = silver.fact_sales_order(*last, *dims)
    return fact, gold.customer_sales_summary(gold.latest_snapshots(snaps), dims[0], gold.fact_rollup(fact))


def same(job, batches, dims):
    fact, summary = full(batches, dims)
    assert rows(job.fact().select(fact.columns)) == rows(fact)
    assert rows(job.summary().select(summary.columns)) == rows(summary)


def test_random_batches_equal_the_full_build(spark, tmp_path, dims):
    """Late lines, lines and headers corrected to other months, customers, products and amounts, missing times."""
    draw = random.Random(8)
    job, batches, count = new_job(spark, tmp_path / "r"), [], 0
    for _ in range(3):
        lines, heads, snaps = {}, {}, []
        for _ in range(14):
            order, at, who = draw.randrange(12), draw.choice([None, 3, 40, 70, 130, 131]), f"c{draw.randrange(5)}"
            heads[order] = head(order, at, who)
            for number in range(draw.randint(0, 2)):
                row = line(order, number, draw.choice([at, at, 95]), who, draw.choice(["s1", "s2", None]), draw.randrange(50))
                lines[row[4]] = row
            count += 1
            snaps.append(snap(who, count, draw.randrange(90)))
        batches.append(frames(spark, list(lines.values()), list(heads.values()), snaps))
    for number, batch in enumerate(batches):
        job.take(number, *batch, *dims)
    same(job, batches, dims)
    job.take(2, *batches[2], *dims)  # the last batch once more
    same(job, batches, dims)


def test_a_batch_touches_its_months_and_customers_only(spark, tmp_path, dims):
    """An order leaves its month: that month and the new one are written, and two customers' rows."""
    job = new_job(spark, tmp_path / "r")
    first = frames(
        spark, [line(i, 0, 30 * i, f"c{i}", "s1", 5) for i in range(5)], [head(i, 30 * i, f"c{i}") for i in range(5)],
        [snap(f"c{i}", 1, i) for i in range(5)],
    )
    job.take(0, *first, *dims)
    files = lambda: {f: f.stat().st_mtime_ns for f in pathlib.Path(tmp_path, "r/fact").rglob("*.parquet")}
    before = files()
    second = frames(spark, [line(2, 0, 125, "c4", "s2", 7)], [], [])
    job.take(1, *second, *dims)
    changed = {f.parent.name for f, at in files().items() if before.get(f) != at}
    assert changed == {f"{MONTH}=2026-03", f"{MONTH}=2026-05"}
    same(job, [first, second], dims)
    assert job.fact().where(F.col(MONTH) == "2026-03").count() == 0
    written = spark.read.parquet(str(tmp_path / "r/summary")).where("_batch_id = 1")
    assert {r["customer_id"] for r in written.collect()} == {"c2", "c4"}
    left = job.summary().where("customer_id = 'c2'").first()
    assert (left["total_line_items"], left["distinct_products_purchased"], left["last_order_timestamp"]) == (0, 0, None)


def test_new_orders_leave_the_files_of_their_months_as_they_are(spark, tmp_path, dims):
    """New orders come beside those of earlier batches; the same batch once more adds nothing."""
    job = new_job(spark, tmp_path / "r")
    parts = [
        frames(spark, [line(i, n, 40, "c1", "s1", 5) for n in range(2)], [head(i, 40, "c1")], [snap("c1", i + 1, i)])
        for i in range(3)
    ]
    files = lambda: {f: f.stat().st_mtime_ns for f in pathlib.Path(tmp_path, "r/fact").rglob("*.parquet")}
    for number, batch in enumerate(parts):
        before = files()
        job.take(number, *batch, *dims)
        assert before.items() <= files().items()
        same(job, parts[: number + 1], dims)
    job.take(2, *parts[2], *dims)
    same(job, parts, dims)


def test_a_changed_customer_is_refreshed_on_request(spark, tmp_path, dims):
    job = new_job(spark, tmp_path / "r")
    first = frames(spark, [line(1, 0, 30, "c1", "s1", 5)], [head(1, 30, "c1")], [snap("c1", 1, 1)])
    job.take(0, *first, *dims)
    renamed = dims[0].withColumn("customer_name", F.concat(F.lit("new "), "customer_name"))
    empty = frames(spark, [], [], [])
    job.take(1, *empty, renamed, *dims[1:], again=spark.createDataFrame([("O1",)], "order_id string"))
    assert job.fact().first()["customer_name"] == job.summary().first()["customer_name"] == "new master 1"
    job.take(2, *empty, *dims)  # nothing to do
    assert job.fact().count() == 1


def test_reading_a_log_by_month_skips_other_folders(spark, tmp_path, dims):
    job = new_job(spark, tmp_path / "r")
    job.take(0, *frames(spark, [line(i, 0, 31 * i, "c1", "s1", 5) for i in range(6)], [], []), *dims)
    plan = job.fact().where(F.col(MONTH) == "2026-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan or "PartitionFilters: [" in plan and "2026-02" in plan


def test_a_batch_in_parts_leaves_nothing_but_its_tables(spark, tmp_path, dims, monkeypatch):
    """Orders new, known and repeated are written part by part; the lines held for a batch are deleted after it."""
    job, parts = new_job(spark, tmp_path / "r"), []
    for start in (0, 6):  # the second batch corrects half of the first one's orders
        parts.append(
            frames(
                spark, [line(i, n, 30 + 10 * i + start, f"c{i % 4}", "s1", 5 + start) for i in range(start, start + 12) for n in range(2)],
                [head(i, 30 + 10 * i + start, f"c{i % 3}") for i in range(start, start + 12)], [snap(f"c{i}", 1 + start, i) for i in range(4)],
            )
        )
    monkeypatch.setattr(models, "LINES_PER_PART", 9)
    folders, paths = [], session.shared_dir
    monkeypatch.setattr(session, "shared_dir", lambda *named: folders.append(paths(*named)) or folders[-1])
    for number, batch in enumerate(parts):
        job.take(number, *batch, *dims)
        same(job, parts[: number + 1], dims)
    job.take(1, *parts[1], *dims)
    same(job, parts, dims)
    held = [pathlib.Path(f.removeprefix("file:")) for f in folders if "/refresh-lines-" in f]
    assert len(held) == 3 and not any(f.exists() for f in held)
