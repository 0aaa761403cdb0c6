"""Every operator as a runnable query over one folder of source tables.

Each function takes `(spark, folder)`, works on whole tables and returns a frame.
Operators that write do so below the shared folder and return what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderweir.functions import columns as c
from orderweir.functions.envelope import to_messages, unwrap
from orderweir.operators import cdc, evolve, history, latest, metrics, monitor, projections, quality, snapshot
from orderweir.operators.running import latest_totals
from orderweir.operators.upsert import KeyedTable
from orderweir.plans import bronze, gold
from orderweir.plans.models import LINES_PER_PART, OF_FACT, Models
from orderweir.plans.refresh import MONTH, Refresh
from orderweir.plans.warehouse import Warehouse, column_inventory, row_counts
from orderweir.schemas import CDC_TOPICS, lakehouse_columns
from orderweir.session import configure, shared_dir, stored
from orderweir.sources import changes as change_source
from orderweir.sources.landing import Landing
from orderweir.sources.log_index import IndexedLog, envelope_time
from orderweir.sources.order_events import order_event_json, parse_order_events
from orderweir.streaming.compaction import JsonLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Landing], DataFrame]) -> Callable[[Landing], DataFrame]:
    """Register under the function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(Landing(configure(spark), str(folder).rstrip("/")))

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


# ---- sources ------------------------------------------------------------------
def order_events(landing: Landing) -> DataFrame:
    return parse_order_events(order_event_json(landing))


@query
def src_raw_orders(landing: Landing) -> DataFrame:
    """Nested JSON order events, decoded; line amounts are summed inside the array."""
    zero = F.lit(0).cast("decimal(28,2)")
    lines_total = F.aggregate(
        "lineItems", zero, lambda total, line: (total + c.money(line["lineTotal"])).cast("decimal(28,2)")
    )
    decoded = order_events(landing).select(
        F.col("orderId").alias("order_id"),
        F.col("customer.customerId").alias("customer_id"),
        F.col("customer.segment").alias("segment"),
        c.money(F.col("orderTotal")).alias("order_total"),
        F.col("lineCount").alias("line_count"),
        F.coalesce(lines_total, zero).alias("lines_total"),
    )
    # An order's lines may come in several events.
    return decoded.groupBy("order_id", "customer_id", "segment").agg(
        F.max("order_total").alias("order_total"),
        F.max("line_count").alias("line_count"),
        F.sum("lines_total").cast(c.MONEY).alias("lines_total"),
    )


@query
def src_cdc_envelope(landing: Landing) -> DataFrame:
    """Change envelopes from JSON, limited to the captured topics before anything is parsed."""
    return change_source.changes(landing).select(
        "entity_id",
        "op",
        "ts_ms",
        "position",
        F.col("before.value").alias("before_value"),
        F.col("after.value").alias("after_value"),
        cdc.row_image()["k"].alias("k"),
    )


@query
def lake_scan_sorted(landing: Landing) -> DataFrame:
    """Full sort by time; the id splits times that very many rows share."""
    return landing.orders_with_customer().select(
        "orderid", "customerid", "customername", "currency", "ordertotal", "ordertimestamp"
    ).orderBy("ordertimestamp", "orderid")


@query
def values_seed_orders(landing: Landing) -> DataFrame:
    """An inline VALUES relation with column aliases, joined to all orders."""
    labels = landing.spark.sql(
        "SELECT * FROM VALUES ('F', 'COMPLETED'), ('O', 'OPEN'), ('P', 'PROCESSING') AS s(code, order_status)"
    )
    orders = landing.source("orders")
    return (
        orders.join(labels, orders.o_orderstatus == labels.code, "left")
        .groupBy("order_status")
        .agg(F.count("*").alias("order_count"), F.sum(c.money(F.col("o_totalprice"))).cast(c.MONEY).alias("order_total"))
    )


@query
def lake_peek_sorted(landing: Landing) -> DataFrame:
    """The first ten orders by time and id: a look at a table, found without a sort of all rows."""
    return landing.orders_with_customer().select("orderid", "customerid", "ordertotal", "ordertimestamp").orderBy(
        "ordertimestamp", "orderid"
    ).limit(10)


@query
def recent_changes_topk(landing: Landing) -> DataFrame:
    """The 100 newest changes since a bound ten days before the last one."""
    events = landing.source("events").select("event_id", "user_id", "event_type", "ts")
    since = events.agg(F.max("ts") - F.expr("interval 10 days")).scalar()
    return cdc.recent_changes(events, "ts", since, 100, "event_id")


@query
def replay_from_ts(landing: Landing) -> DataFrame:
    """Everything from a point in time on, to be processed again."""
    start_ms = 1_705_276_800_000  # 2024-01-15T00:00:00Z
    return cdc.replay_from(change_source.changes(landing), start_ms).select("entity_id", "op", "ts_ms", "position")


@query
def replay_indexed(landing: Landing) -> DataFrame:
    """The same from a stored log of messages, of which only files that reach into the time range are read.

    The log came in three batches, the last one of changes that arrived late.
    """
    sent = change_source.change_messages(landing).filter(F.col("topic").isin(*CDC_TOPICS))
    # Messages are made and looked into once, not by each batch's filter.
    marked = sent.withColumns({"early": envelope_time() < 1_705_276_800_000, "late": F.get_json_object("value", "$.op") == "c"})
    marked = stored(marked, "indexed-in")
    log = IndexedLog(landing.spark, shared_dir(landing.spark, "indexed"), "topic string, key string, value string")
    early, late = F.col("early"), F.col("late")
    for batch_id, part in enumerate([marked.filter(early & ~late), marked.filter(~early & ~late), marked.filter(late)]):
        log.append(part, batch_id)
    parsed = change_source.parse_changes(log.replay(1_705_276_800_000))
    return parsed.select(
        F.coalesce("after.user_id", "before.user_id").alias("entity_id"), "op", "ts_ms", F.col("source.lsn").alias("position")
    )


@query
def snapshot_reconciled(landing: Landing) -> DataFrame:
    """A table read in eight chunks while it changed, put right by its change log.

    Chunk i holds its rows as of the middle of the i-th eighth of the log, so that changes fall before and after every read.
    """
    log = stored(change_source.changes(landing).select("entity_id", "position", "op", "after"), "change-log")
    eighth = log.agg(F.ceil((F.max("position") + 1) / 8)).scalar()
    chunked = log.withColumn("chunk", F.pmod(F.xxhash64("entity_id"), F.lit(8)))
    read_at = F.col("chunk") * eighth + F.floor(eighth / 2)
    seen = latest.latest_per_key(chunked.filter(F.col("position") <= read_at), ["entity_id"], ["position"])
    rows = seen.filter("op <> 'd'").select(
        "entity_id", "after", (F.col("chunk") * eighth - 1).alias("low"), ((F.col("chunk") + 1) * eighth - 1).alias("high")
    )
    live = snapshot.state_at(rows, log, "entity_id")
    return live.select("entity_id", F.col("after.value").cast(c.MONEY).alias("value"), F.col("after.k").alias("k"))


@query
def dim_date_generated(landing: Landing) -> DataFrame:
    return landing.mdm_date()


@query
def federated_customer_compare(landing: Landing) -> DataFrame:
    """Customers known to the warehouse layer beside those in the master layer."""
    landed = landing.orders_with_customer().groupBy("customerid").agg(F.count("*").alias("landed_orders"))
    master = landing.mdm_customer360().select("customer_id", "projected_order_count")
    return landed.join(master, landed.customerid == master.customer_id, "full_outer").select(
        F.coalesce("customerid", "customer_id").alias("customer_id"),
        F.coalesce("landed_orders", F.lit(0)).alias("landed_orders"),
        "projected_order_count",
        F.col("customer_id").isNotNull().alias("in_master"),
    )


# ---- projections and envelopes ---------------------------------------------------
@query
def proj_sales_order(landing: Landing) -> DataFrame:
    return projections.sales_orders(order_events(landing))


@query
def proj_line_item(landing: Landing) -> DataFrame:
    return projections.line_items(order_events(landing))


def header_records(landing: Landing) -> DataFrame:
    return landing.sales_order_arrivals().select(
        F.col("orderid").alias("orderId"),
        F.col("ordertimestamp").alias("orderTimestamp"),
        F.col("customerid").alias("customerId"),
        F.col("customername").alias("customerName"),
        F.col("customeremail").alias("customerEmail"),
        F.col("customersegment").alias("customerSegment"),
        "currency",
        F.col("ordertotal").alias("orderTotal"),
        F.col("lineitemcount").alias("lineItemCount"),
        "arrival",
        "status",
    )


def line_records(landing: Landing) -> DataFrame:
    return landing.line_arrivals().select(
        F.col("orderid").alias("orderId"),
        F.col("ordertimestamp").alias("orderTimestamp"),
        F.col("customerid").alias("customerId"),
        F.col("customername").alias("customerName"),
        F.col("lineitemid").alias("lineItemId"),
        "sku",
        F.col("productname").alias("productName"),
        "quantity",
        F.col("unitprice").alias("unitPrice"),
        F.col("linetotal").alias("lineTotal"),
        "currency",
        "shipped_at",
        "position",
        "status",
    )


def snapshot_records(landing: Landing) -> DataFrame:
    return landing.customer_sales_arrivals().select(
        F.col("customerid").alias("customerId"),
        F.col("customername").alias("customerName"),
        F.col("customeremail").alias("customerEmail"),
        F.col("customersegment").alias("customerSegment"),
        F.col("ordercount").alias("orderCount"),
        F.col("totalspent").alias("totalSpent"),
        F.col("lastorderid").alias("lastOrderId"),
        F.col("updatedat").alias("updatedAt"),
        "currency",
        "arrival",
        "status",
    )


def messages(records: DataFrame, topic: str) -> DataFrame:
    return to_messages(projections.to_wire(records, topic), topic)


def digest(sent: DataFrame) -> DataFrame:
    """The exact message text, shown by length and hash to keep the result small."""
    return sent.select(
        "topic", "key", F.length("value").alias("value_length"), F.md5(F.col("value").cast("binary")).alias("value_md5")
    )


@query
def envelope_sales_order(landing: Landing) -> DataFrame:
    return digest(messages(header_records(landing), "sales_order"))


@query
def envelope_line_item(landing: Landing) -> DataFrame:
    return digest(messages(line_records(landing), "sales_order_line_item"))


@query
def envelope_customer_sales(landing: Landing) -> DataFrame:
    return digest(messages(snapshot_records(landing), "customer_sales"))


@query
def unwrap_payload(landing: Landing) -> DataFrame:
    """Records from messages that come wrapped (open orders) or bare (all others)."""
    wire = projections.to_wire(header_records(landing), "sales_order", "status")
    sent = to_messages(wire, "sales_order", "status")
    mixed = F.when(F.col("status") == "O", F.col("value")).otherwise(F.get_json_object("value", "$.payload"))
    return sent.select(unwrap(mixed, "sales_order").alias("record")).select(
        F.col("record.orderId").alias("order_id"),
        F.col("record.orderTimestamp").alias("order_ms"),
        F.col("record.orderTotal").alias("order_total"),
        F.col("record.lineItemCount").alias("line_item_count"),
    )


@query
def drop_keyless(landing: Landing) -> DataFrame:
    """Messages of two topics and an unknown one; open orders lost their key, pending ones have it empty."""
    orders = landing.source("orders")
    order_key = F.when(F.col("o_orderstatus") == "P", "").when(
        F.col("o_orderstatus") == "F", c.prefixed("SO-", F.col("o_orderkey"))
    )
    sent = (
        orders.select(F.lit("sales_order").alias("topic"), F.to_json(F.struct(order_key.alias("orderId"))).alias("value"))
        .unionByName(
            landing.source("customer").select(
                F.lit("customer_sales").alias("topic"),
                F.to_json(
                    F.struct(F.struct(c.prefixed("CUST-", F.col("c_custkey")).alias("customerId")).alias("payload"))
                ).alias("value"),
            )
        )
        .unionByName(
            landing.source("supplier").select(
                F.lit("supplier").alias("topic"), F.to_json(F.struct("s_suppkey")).alias("value")
            )
        )
    )
    return projections.drop_keyless(sent).select("topic", "merge_key")


@query
def money_round(landing: Landing) -> DataFrame:
    """Discounted price per line, rounded half-up to cents on exact decimals."""
    price = F.col("l_extendedprice").cast(c.MONEY)
    discount = F.col("l_discount").cast("decimal(4,2)")
    return landing.source("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        c.round_cents(price * (F.lit(1).cast("decimal(4,2)") - discount)).alias("net_price"),
    )


# ---- bronze and dimensions -----------------------------------------------------
def _stage(name: str, model: str) -> None:
    def staged(landing: Landing) -> DataFrame:
        return Models(landing).stage(model)

    staged.__name__ = name
    staged.__doc__ = f"Bronze model {model}."
    query(staged)


_stage("stg_sales_order", "stg_sales_order")
_stage("stg_line_item", "stg_sales_order_line_item")
_stage("stg_customer_sales", "stg_customer_sales")
_stage("stg_mdm_customer", "stg_mdm_customer360")
_stage("stg_mdm_product", "stg_mdm_product_master")
_stage("stg_mdm_date", "stg_mdm_date")


@query
def dim_customer(landing: Landing) -> DataFrame:
    return Models(landing).dim_customer


@query
def dim_product(landing: Landing) -> DataFrame:
    return Models(landing).dim_product


@query
def dim_date(landing: Landing) -> DataFrame:
    return Models(landing).dim_date


# ---- fact and gold ----------------------------------------------------------------
@query
def fact_sales_order(landing: Landing) -> DataFrame:
    return Models(landing).fact_sales_order


def _models_on_stored_fact(landing: Landing) -> Models:
    """Gold reads the fact as a stored table, not as a plan that is run once per use."""
    return Models(landing, {"fact_sales_order": _stored_fact(landing)})


def _stored_fact(landing: Landing) -> DataFrame:
    models, lines = Models(landing), landing.source("lineitem").count()
    if lines > LINES_PER_PART:  # each part reads the dimensions
        dims = {"dim_mdm_customer": models.dim_customer, "dim_mdm_product": models.dim_product, "dim_mdm_date": models.dim_date}
        models = Models(landing, {name: stored(dim.select(OF_FACT[name]), "fact-dim") for name, dim in dims.items()})
    return stored(models.fact_parts(lines), "fact")


def _refreshed(landing: Landing, snapshots: DataFrame) -> Refresh:
    """Fact and summary after three batches: closed orders with stale pending ones, some open ones, then the rest and the corrections.

    Stale orders come with other amounts and customers and forty days late, so the correction moves them between months.
    """
    spark = landing.spark
    heads = landing.sales_order_arrivals()
    of_order = heads.select("orderid", F.col("status").alias("order_status"), F.pmod("arrival", F.lit(2)).alias("parity"))
    head_rows = stored(
        heads.selectExpr(*bronze.MODELS["stg_sales_order"][1], "status as order_status", "arrival % 2 as parity"), "refresh-in"
    )
    line_rows = landing.line_arrivals().join(of_order, "orderid").selectExpr(
        *bronze.MODELS["stg_sales_order_line_item"][1], "shipped_at", "order_status", "parity"
    )
    snapshots = snapshots.selectExpr(*bronze.MODELS["stg_customer_sales"][1], "status as order_status", "arrival % 2 as parity")
    line_rows, snapshots = stored(line_rows, "refresh-in"), stored(snapshots, "refresh-in")
    models = Models(landing)
    dims = [stored(dim, "refresh-dim") for dim in (models.dim_customer, models.dim_product, models.dim_date)]
    closed, open_, pending = (F.col("order_status") == code for code in "FOP")
    stale = {
        "order_timestamp": F.when(pending, F.expr("order_timestamp + interval 40 days")).otherwise(F.col("order_timestamp")),
        "customer_id": F.when(pending, F.lit("CUST-0")).otherwise(F.col("customer_id")),
    }
    none = lambda df: df.drop("order_status", "parity")
    job = Refresh(
        spark, shared_dir(spark, "refresh"), none(line_rows).schema, none(head_rows).schema, none(snapshots).schema,
        line_key=["line_item_id", "sku", "shipped_at"], buckets=int(spark.conf.get("spark.sql.shuffle.partitions")),
    ).create()
    first = [
        line_rows.withColumns({**stale, "line_total": F.when(pending, F.lit(0).cast(c.MONEY)).otherwise(F.col("line_total"))}),
        head_rows.withColumns(stale),
    ]
    batches = [
        [*[df.filter(closed | pending) for df in first], snapshots.filter(closed)],
        [df.filter(open_ & (F.col("parity") == 1)) for df in (line_rows, head_rows, snapshots)],
        [df.filter(pending | (open_ & (F.col("parity") == 0))) for df in (line_rows, head_rows, snapshots)],
    ]
    for batch_id, parts in enumerate(batches):
        job.take(batch_id, *[none(df) for df in parts], *dims)
    return job


@query
def refresh_fact(landing: Landing) -> DataFrame:
    """The fact after three incremental batches with late and corrected orders, instead of a full build."""
    return _refreshed(landing, landing.customer_sales_arrivals().limit(0)).fact().drop(MONTH)


@query
def refresh_summary(landing: Landing) -> DataFrame:
    """The customer summary after the same batches."""
    return _refreshed(landing, landing.customer_sales_arrivals()).summary()


@query
def fact_rollup(landing: Landing) -> DataFrame:
    return _models_on_stored_fact(landing).fact_rollup


@query
def gold_summary(landing: Landing) -> DataFrame:
    return _models_on_stored_fact(landing).summary()


@query
def gold_summary_changelog(landing: Landing) -> DataFrame:
    return _models_on_stored_fact(landing).summary_changelog()


@query
def gold_summary_chart(landing: Landing) -> DataFrame:
    return Models(landing).summary_by_max()


@query
def line_item_rollup(landing: Landing) -> DataFrame:
    return gold.line_item_rollup(Models(landing).stage("stg_sales_order_line_item"))


# ---- totals and latest rows ----------------------------------------------------------
@query
def customer_sales_running(landing: Landing) -> DataFrame:
    """One snapshot per order event, in arrival order; late orders add but do not replace."""
    return landing.customer_sales_arrivals().drop("status")


@query
def customer_sales_latest(landing: Landing) -> DataFrame:
    events = landing.orders_with_customer().withColumn("ordercount", F.lit(1).cast("bigint"))
    totals = latest_totals(
        events,
        key="customerid",
        arrival="arrival",
        event_time="ordertimestamp",
        sums=["ordercount", "ordertotal"],
        latest=["customername", "customeremail", "customersegment", "orderid", "currency"],
    )
    return totals.select(
        "customerid", "customername", "customeremail", "customersegment", "ordercount",
        F.col("ordertotal").cast(c.MONEY).alias("totalspent"),
        F.col("orderid").alias("lastorderid"),
        F.col("ordertimestamp").alias("updatedat"),
        "currency",
    )


@query
def latest_per_key(landing: Landing) -> DataFrame:
    """Latest version of every repeated line id."""
    kept = latest.latest_per_key(landing.line_arrivals(), ["lineitemid"], ["shipped_at", "position"])
    return kept.select("lineitemid", "orderid", "sku", "quantity", "linetotal", "shipped_at")


@query
def dup_keys(landing: Landing) -> DataFrame:
    """Number of repeating merge keys per landing table."""
    lines = landing.source("lineitem").select("l_orderkey", "l_linenumber")
    snapshots = landing.source("orders").select("o_custkey")
    return latest.count_duplicate_keys(
        {
            "sales_order": (landing.source("orders").select("o_orderkey"), ["o_orderkey"]),
            "sales_order_line_item": (lines, ["l_orderkey", "l_linenumber"]),
            "customer_sales": (snapshots, ["o_custkey"]),
        }
    )


@query
def compact_latest(landing: Landing) -> DataFrame:
    """A state topic rewritten to the last record of each key."""
    records = landing.source("events").select("user_id", "event_id", "ts", "event_type", "value")
    return stored(latest.latest_per_key(records, ["user_id"], ["event_id"]), "compacted")


@query
def log_state_after_compaction(landing: Landing) -> DataFrame:
    """A state log of three batches, compacted after two: the state is the compacted base and the batch after it."""
    from orderweir.streaming.jobs import compact_log, last_logged
    from orderweir.streaming.sinks import append_batch

    spark, path = landing.spark, shared_dir(landing.spark, "state-log")
    records = landing.source("events").select("user_id", "event_id", "ts", "event_type", "value")
    dealt = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for batch_id in range(3):
        part = records.filter(dealt == batch_id)
        append_batch(latest.latest_per_key(part, ["user_id"], ["event_id"]), batch_id, f"{path}/log")
        if batch_id == 1:
            compact_log(spark, f"{path}/log", f"{path}/base", ["user_id"], ["event_id"])
    return last_logged(spark, f"{path}/log", ["user_id"], ["event_id"], base=f"{path}/base")


# ---- tables that are merged ------------------------------------------------------------
def _table(landing: Landing, purpose: str, keys: list[str]) -> KeyedTable:
    buckets = int(landing.spark.conf.get("spark.sql.shuffle.partitions"))
    return KeyedTable(landing.spark, shared_dir(landing.spark, purpose), keys, buckets=buckets)


@query
def merge_sales_order(landing: Landing) -> DataFrame:
    """Topic messages merged into the order table.

    The table holds closed and pending orders with no total yet; messages bring
    the pending ones again and the open ones for the first time.
    """
    orders = landing.sales_order_arrivals()
    stage = bronze.MODELS["stg_sales_order"][1]
    earlier = orders.filter("status in ('F', 'P')").selectExpr(*stage).withColumn("order_total", F.lit(0).cast(c.MONEY))
    table = _table(landing, "merge-sales-order", ["order_id"]).create(earlier)
    sent = messages(header_records(landing).filter("status in ('O', 'P')"), "sales_order")
    batch = projections.to_lakehouse(sent, "sales_order").filter(c.has_key(F.col("order_id")))
    return table.upsert(batch).read()


def _through_topic(records: DataFrame, topic: str, *keep: str) -> DataFrame:
    """Records written as messages of a topic and read back as lakehouse rows."""
    return projections.to_lakehouse(to_messages(projections.to_wire(records, topic, *keep), topic, *keep), topic, *keep)


@query
def merge_line_item(landing: Landing) -> DataFrame:
    """Two batches with repeated line ids: the later batch wins, and in a batch the later arrival."""
    stage = bronze.MODELS["stg_sales_order_line_item"][1]
    lines = landing.line_arrivals().selectExpr(*stage, "shipped_at", "position", "status")
    columns = lakehouse_columns("sales_order_line_item")
    table = _table(landing, "merge-line-item", ["line_item_id"])
    first = latest.latest_per_key(lines.filter("status = 'F'"), ["line_item_id"], ["shipped_at", "position"])
    table.create(first.select(columns))
    return table.upsert(_through_topic(line_records(landing).filter("status <> 'F'"), "sales_order_line_item",
                                       "shipped_at", "position"), order=["shipped_at", "position"]).read()


@query
def merge_customer_sales(landing: Landing) -> DataFrame:
    """Snapshots out of order across batches, guarded by event time."""
    snapshots = landing.customer_sales_arrivals().selectExpr(*bronze.MODELS["stg_customer_sales"][1], "arrival", "status")
    table = _table(landing, "merge-customer-sales", ["customer_id"])
    first = latest.latest_per_key(snapshots.filter("status <> 'F'"), ["customer_id"], ["updated_at", "arrival"])
    table.create(first.select(lakehouse_columns("customer_sales")))
    late = _through_topic(snapshot_records(landing).filter("status = 'F'"), "customer_sales", "arrival")
    return table.upsert(late, order=["updated_at", "arrival"], newer_by="updated_at").read()


# The columns that a sync copies.
SYNC_COLUMNS = {
    "sales_order": [
        "orderid", "ordertimestamp", "customerid", "customername", "customeremail", "customersegment",
        "currency", "lineitemcount",
    ],
    "sales_order_line_item": [
        "orderid", "ordertimestamp", "customerid", "customername", "lineitemid", "sku", "productname",
        "quantity", "currency",
    ],
    "customer_sales": [
        "customerid", "customername", "customeremail", "customersegment", "ordercount", "lastorderid",
        "updatedat", "currency",
    ],
}


@query
def sync_sales_order(landing: Landing) -> DataFrame:
    """Batch merge by explicit columns: totals are not listed, so they stay, or start as null."""
    source = landing.sales_order_arrivals()
    columns = landing.sales_order().columns
    table = _table(landing, "sync-sales-order", ["orderid"])
    table.create(source.filter("status <> 'O'").withColumn("lineitemcount", F.lit(-1)).select(columns))
    listed = SYNC_COLUMNS["sales_order"]
    return table.upsert(source.select(columns), strict=True, update=listed, insert=listed).read()


@query
def sync_line_item(landing: Landing) -> DataFrame:
    """The same for lines, whose repeated ids are first brought to the latest row."""
    source = landing.line_arrivals()
    order = ["shipped_at", "position"]
    columns = landing.sales_order_line_item().columns
    table = _table(landing, "sync-line-item", ["lineitemid"])
    stale = latest.latest_per_key(source.filter("status = 'F'"), ["lineitemid"], order)
    table.create(stale.withColumn("quantity", F.lit(-1)).select(columns))
    listed = SYNC_COLUMNS["sales_order_line_item"]
    return table.upsert(source, order=order, update=listed, insert=listed).read()


@query
def sync_customer_sales(landing: Landing) -> DataFrame:
    source = landing.customer_sales_arrivals()
    columns = landing.customer_sales().columns
    table = _table(landing, "sync-customer-sales", ["customerid"])
    table.create(latest.latest_per_key(source.filter("status = 'F'"), ["customerid"], ["arrival"]).select(columns))
    listed = SYNC_COLUMNS["customer_sales"]
    return table.upsert(source, order=["arrival"], update=listed, insert=listed).read()


def _ctas(landing: Landing, df: DataFrame, table: str) -> DataFrame:
    """Replace a table with a column subset of another."""
    return stored(df.select(SYNC_COLUMNS[table]), f"ctas-{table}")


@query
def ctas_sales_order(landing: Landing) -> DataFrame:
    return _ctas(landing, landing.sales_order(), "sales_order")


@query
def ctas_line_item(landing: Landing) -> DataFrame:
    return _ctas(landing, landing.sales_order_line_item(), "sales_order_line_item")


@query
def ctas_customer_sales(landing: Landing) -> DataFrame:
    return _ctas(landing, landing.customer_sales(), "customer_sales")


def _cloned(landing: Landing, table: str, keys: list[str], rows: DataFrame) -> DataFrame:
    """An empty copy of a table is created, then filled by a first merge of all its rows."""
    return _table(landing, f"empty-clone-{table}", keys).create(evolve.empty_clone(rows)).upsert(rows).read()


@query
def empty_clone(landing: Landing) -> DataFrame:
    return _cloned(landing, "sales_order", ["orderid"], landing.sales_order())


@query
def empty_clone_line_item(landing: Landing) -> DataFrame:
    """Lines, whose ids repeat: the later arrival of each is merged."""
    lines = latest.latest_per_key(landing.line_arrivals(), ["lineitemid"], ["shipped_at", "position"])
    return _cloned(landing, "line-item", ["lineitemid"], lines.drop("shipped_at", "position", "status"))


@query
def empty_clone_customer_sales(landing: Landing) -> DataFrame:
    return _cloned(landing, "customer-sales", ["customerid"], landing.customer_sales_latest())


@query
def mdm_full_refresh(landing: Landing) -> DataFrame:
    """Three master tables replaced as a whole; rows written are counted on the way, not by a second scan."""
    from orderweir.streaming.sinks import full_refresh

    written = full_refresh(
        landing.spark,
        {
            "customer360": landing.mdm_customer360(),
            "product_master": landing.mdm_product_master(),
            "mdm_date": landing.mdm_date(),
        },
        shared_dir(landing.spark, "mdm"),
    )
    return landing.spark.createDataFrame(list(written.items()), "table_name string, row_count bigint")


def _refreshed_table(landing: Landing, table: str, first: DataFrame, rows: DataFrame) -> DataFrame:
    """A master table as it stands after it was replaced twice, first by a part of it."""
    from orderweir.streaming.sinks import full_refresh

    path = shared_dir(landing.spark, "mdm")
    full_refresh(landing.spark, {table: first}, path)
    full_refresh(landing.spark, {table: rows}, path)
    return landing.spark.read.parquet(f"{path}/{table}").drop("_part")


@query
def mdm_full_refresh_rows(landing: Landing) -> DataFrame:
    rows = landing.mdm_customer360()
    return _refreshed_table(landing, "customer360", rows.filter("customer_segment = 'BUILDING'"), rows)


@query
def mdm_full_refresh_products(landing: Landing) -> DataFrame:
    rows = landing.mdm_product_master()
    return _refreshed_table(landing, "product_master", rows.filter("orders_count < 30"), rows)


@query
def mdm_full_refresh_dates(landing: Landing) -> DataFrame:
    rows = landing.mdm_date()
    return _refreshed_table(landing, "mdm_date", rows.filter("is_weekend"), rows)


@query
def insert_ignore_customer(landing: Landing) -> DataFrame:
    """All customers offered to the master table: known ones are ignored, new ones get defaults."""
    table = _table(landing, "insert-ignore", ["customer_id"])
    table.create(landing.mdm_customer360())
    offered = landing.customer_profiles().select(
        "customer_id", "customer_name", "customer_email", "customer_segment", "first_order_timestamp"
    )
    defaults = {
        "currency": F.lit("USD"),
        "projected_order_count": F.lit(0),
        "projected_total_spent": F.lit(0),
        "projection_updated_at": F.expr("timestamp_ntz'2026-01-01 00:00:00'"),
        "updated_at": F.expr("timestamp_ntz'2026-01-01 00:00:00'"),
    }
    return table.append_absent(offered, ["customer_id"], defaults).read()


BATCH_TIME = "timestamp_ntz'2026-01-01 00:00:00'"


@query
def upsert_customer360(landing: Landing) -> DataFrame:
    """All customers with the figures of closed orders; `updated_at` moves only where something changed."""
    table = _table(landing, "customer360", ["customer_id"])
    table.create(landing.mdm_customer360())
    closed = landing.customer_profiles(landing.source("orders").filter("o_orderstatus = 'F'")).drop(
        "balance", "updated_at"
    )
    return table.upsert(closed, touch={"updated_at": F.expr(BATCH_TIME)}).read()


@query
def upsert_product_master(landing: Landing) -> DataFrame:
    """All parts with the figures of lines that were not returned."""
    table = _table(landing, "product-master", ["product_id"])
    table.create(landing.mdm_product_master())
    kept = landing.product_profiles(landing.source("lineitem").filter("l_returnflag <> 'R'")).drop("kind", "updated_at")
    return table.upsert(kept, touch={"updated_at": F.expr(BATCH_TIME)}).read()


@query
def ods_upsert(landing: Landing) -> DataFrame:
    """Activity records upserted by user in two batches."""
    records = landing.source("events").select(
        F.col("user_id").alias("customer_id"),
        c.email_of(c.prefixed("user", F.col("user_id"))).alias("email"),
        F.col("event_type").alias("name"),
        F.col("ts").alias("updated_at"),
        "event_id",
    )
    batch = records.filter("updated_at >= timestamp_ntz'2024-01-15 00:00:00'")
    table = _table(landing, "ods", ["customer_id"])
    before = latest.latest_per_key(
        records.filter("updated_at < timestamp_ntz'2024-01-15 00:00:00'"), ["customer_id"], ["event_id"]
    )
    table.create(before.drop("event_id"))
    return table.upsert(batch, order=["event_id"]).read()


# ---- change data capture ---------------------------------------------------------------
@query
def cdc_curated(landing: Landing) -> DataFrame:
    """Curated change records of the captured topics; reads of an uncaptured topic are dropped."""
    sent = change_source.change_messages(
        landing,
        topic_of={
            "signup": "mdm_mysql.mdm.customer360",
            "click": "mdm_mysql.mdm.customer360",
            "error": "mdm_mysql.mdm.customer360",
            "purchase": "mdm_mysql.mdm.product_master",
            "view": "mdm_mysql.mdm.mdm_date",
        },
    )
    return cdc.curated(change_source.parse_changes(sent)).select(
        "topic", "key", "entity", "operation", "sourceTsMs",
        F.col("data.value").alias("data_value"),
        F.col("data.k").alias("data_k"),
    )


@query
def cdc_dedupe(landing: Landing) -> DataFrame:
    """The whole change log delivered twice, reduced to one copy of each change."""
    once = change_source.changes(landing)
    return cdc.dedupe(once.unionByName(once), ["entity_id"]).select("entity_id", "op", "ts_ms", "position")


def _state(landing: Landing, operations: tuple[str, ...]) -> DataFrame:
    live = cdc.current_state(change_source.changes(landing), ["entity_id"], operations)
    return live.select(
        "entity_id", "op", "ts_ms", F.col("after.value").cast(c.MONEY).alias("value"), F.col("after.k").alias("k")
    )


@query
def cdc_current_state(landing: Landing) -> DataFrame:
    """Live rows after creates, updates and deletes; snapshot reads are not applied."""
    return _state(landing, ("c", "u", "d"))


@query
def cdc_current_state_with_reads(landing: Landing) -> DataFrame:
    """Live rows when the initial snapshot counts as well."""
    return _state(landing, cdc.EVERY_OPERATION)


@query
def cdc_scd2(landing: Landing) -> DataFrame:
    """All versions of every row with their validity, from a stored log of decoded changes."""
    versions = cdc.history(stored(change_source.changes(landing), "change-log"), "entity_id")
    return versions.select(
        "entity_id", "position", F.col("after.value").cast(c.MONEY).alias("value"),
        "valid_from_ms", "valid_to_ms", "is_current",
    )


@query
def cdc_scd2_batches(landing: Landing) -> DataFrame:
    """The same, maintained over three batches that mix early and late changes of every row."""
    changes = stored(change_source.changes(landing), "change-log")
    log = history.HistoryLog(
        landing.spark, shared_dir(landing.spark, "history"), "entity_id", history.log_schema(changes, "entity_id")
    ).create()
    part = F.pmod(F.xxhash64("position"), F.lit(3))
    for batch_id, which in enumerate((2, 0, 1)):
        log.take(changes.filter(part == which), batch_id)
    return log.versions().withColumn("value", F.col("after.value").cast(c.MONEY)).drop("after")


@query
def bronze_append(landing: Landing) -> DataFrame:
    """Two batches appended to an immutable log, the second one delivered again."""
    from orderweir.streaming.sinks import append_batch

    path = shared_dir(landing.spark, "bronze")
    events = landing.source("events").select("event_id", "user_id", "event_type", "ts")
    append_batch(events.filter("ts < timestamp_ntz'2024-01-15 00:00:00'"), 0, path)
    later = events.filter("ts >= timestamp_ntz'2024-01-15 00:00:00'")
    append_batch(later, 1, path)
    append_batch(later, 1, path)
    return landing.spark.read.parquet(path).select("event_id", "user_id", "event_type", "ts", "_batch_id")


@query
def evolve_additive(landing: Landing) -> DataFrame:
    """Closed orders in the first table version, the rest with a column added later."""
    orders = landing.source("orders").select(
        "o_orderkey", c.money(F.col("o_totalprice")).alias("order_total"), "o_orderpriority", "o_orderstatus"
    )
    first = orders.filter("o_orderstatus = 'F'").drop("o_orderpriority")
    return evolve.additive_union(first, orders.filter("o_orderstatus <> 'F'"))


@query
def json_compaction(landing: Landing) -> DataFrame:
    """Orders as raw JSON in many small files of three batches, two of which are put together before all are read."""
    orders = landing.source("orders").select("o_orderkey", "o_orderstatus", c.plain_text(c.money(F.col("o_totalprice"))).alias("total"))
    log = JsonLog(landing.spark, shared_dir(landing.spark, "json"), "o_orderkey bigint, o_orderstatus string, total string")
    for batch_id, status in enumerate("FOP"):
        log.append(orders.filter(F.col("o_orderstatus") == status), batch_id)
    log.compact(upto=1)
    return log.read()


@query
def quarantine_bad_records(landing: Landing) -> DataFrame:
    """Order totals as text, unreadable for pending orders and missing for urgent ones."""
    raw = landing.source("orders").select(
        c.prefixed("SO-", F.col("o_orderkey")).alias("order_id"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("n/a "), F.col("o_orderpriority")))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit(None))
        .otherwise(c.plain_text(c.money(F.col("o_totalprice"))))
        .alias("order_total_text"),
    )
    return quality.quarantine(raw, "order_total_text", "order_total")


# ---- streams run to completion ---------------------------------------------------------
@query
def stream_static_enrich(landing: Landing) -> DataFrame:
    """The events file read as a stream and joined with the customer table."""
    from orderweir.streaming.jobs import enrich_events

    return enrich_events(landing, shared_dir(landing.spark, "enriched"))


@query
def stream_customer_totals(landing: Landing) -> DataFrame:
    """Customer totals kept by a stream over the orders file, merged into a keyed table."""
    from orderweir.streaming.jobs import customer_totals

    return customer_totals(landing, shared_dir(landing.spark, "totals"))


@query
def stream_customer_changelog(landing: Landing) -> DataFrame:
    """Running snapshots written by a stream, one per order."""
    from orderweir.streaming.jobs import customer_changelog

    return customer_changelog(landing, shared_dir(landing.spark, "changelog"))


@query
def stream_change_chain(landing: Landing) -> DataFrame:
    """Two chained streams: changes to an immutable log, the log to current state."""
    from orderweir.streaming.jobs import change_chain

    return change_chain(landing, shared_dir(landing.spark, "chain"))


@query
def contributions_from_events(landing: Landing) -> DataFrame:
    """Totals per customer from nested order events, each order counted once however many parts it has."""
    totals = latest_totals(
        projections.customer_contributions(order_events(landing), "arrival"),
        "customerId", "arrival", "updatedAt", projections.CUSTOMER_SUMS, projections.CUSTOMER_LATEST,
    )
    return _event_totals(totals)


def _event_totals(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.col("customerId").alias("customer_id"),
        F.col("orderCount").alias("order_count"),
        F.col("totalSpent").cast(c.MONEY).alias("total_spent"),
        F.col("lastOrderId").alias("last_order_id"),
        F.col("customerSegment").alias("customer_segment"),
    )


@query
def stream_order_fanout_totals(landing: Landing) -> DataFrame:
    """The same from a stream of the events."""
    from orderweir.streaming.jobs import event_totals

    return _event_totals(event_totals(landing, shared_dir(landing.spark, "event-totals")))


@query
def stream_fanout_logs(landing: Landing) -> DataFrame:
    """One stream of order events into header, line and contribution logs, and what the three say about each order."""
    from orderweir.streaming.jobs import fanned_out

    sent = fanned_out(landing, shared_dir(landing.spark, "fan-out"))
    return sent.select(
        F.col("orderId").alias("order_id"), F.col("customerId").alias("customer_id"),
        c.money(F.col("orderTotal")).alias("order_total"), F.col("lineItemCount").cast("int").alias("line_item_count"),
        "lines", "lines_total", "orders",
    )


@query
def stream_dedupe_redelivered(landing: Landing) -> DataFrame:
    """The whole change log delivered twice to a stream: every distinct change once, however late."""
    from orderweir.streaming.jobs import redelivered_changes

    return redelivered_changes(landing, shared_dir(landing.spark, "redelivered"))


# ---- data quality -------------------------------------------------------------------------
@query
def dq_not_null(landing: Landing) -> DataFrame:
    fact = Models(landing).fact_sales_order
    return quality.not_null(fact, ["order_id", "line_item_id", "customer_id", "product_id", "currency"])


@query
def dq_rel_customer(landing: Landing) -> DataFrame:
    models = Models(landing)
    return quality.relationship(
        "relationship_customer", models.fact_sales_order, "customer_id", models.dim_customer, "customer_id",
        severity="warn", where=F.col("customer_id").like("CUST-%"),
    )


@query
def dq_rel_product(landing: Landing) -> DataFrame:
    models = Models(landing)
    return quality.relationship(
        "relationship_product", models.fact_sales_order, "product_id", models.dim_product, "product_id"
    )


@query
def dq_rel_product_violations(landing: Landing) -> DataFrame:
    models = Models(landing)
    return quality.relationship_violations(
        models.fact_sales_order, "product_id", models.dim_product, "product_id"
    )


@query
def dq_rel_date(landing: Landing) -> DataFrame:
    """Days of order lines that the calendar does not have."""
    models = Models(landing)
    days = models.fact_sales_order.withColumn("day_key", F.date_format("order_date", "yyyyMMdd").cast("int"))
    return quality.relationship("relationship_date", days, "day_key", models.dim_date, "date_key")


@query
def dq_accepted_values(landing: Landing) -> DataFrame:
    fact = Models(landing).fact_sales_order
    segments = ["AUTOMOBILE", "BUILDING", "MACHINERY"]
    return quality.accepted_values(
        fact, {"currency": ["USD"], "is_weekend": [True, False], "customer_segment": segments}
    )


@query
def dq_accepted_values_violations(landing: Landing) -> DataFrame:
    fact = Models(landing).fact_sales_order
    segments = ["AUTOMOBILE", "BUILDING", "MACHINERY"]
    return quality.accepted_values_violations(fact, {"currency": ["USD"], "customer_segment": segments})


@query
def dq_not_null_violations(landing: Landing) -> DataFrame:
    """Lines of customers or days the dimensions do not know."""
    fact = Models(landing).fact_sales_order
    return quality.not_null_violations(fact, ["customer_email", "date_key"]).select(
        "line_item_id", "product_id", "line_total", "customer_email", "date_key"
    )


@query
def dq_non_empty(landing: Landing) -> DataFrame:
    return quality.non_empty(
        {
            "sales_order": landing.sales_order(),
            "sales_order_line_item": landing.sales_order_line_item(),
            # A snapshot comes from every contribution, so a look at one tells without building the changelog.
            "customer_sales": landing.contributions(),
        }
    )


@query
def dq_unique(landing: Landing) -> DataFrame:
    models = Models(landing)
    return quality.unique("unique_order_id", models.stage("stg_sales_order"), "order_id").unionByName(
        quality.unique("unique_line_item_id", models.stage("stg_sales_order_line_item"), "line_item_id")
    )


@query
def order_total_reconcile(landing: Landing) -> DataFrame:
    models = Models(landing)
    return quality.order_total_mismatches(models.stage("stg_sales_order"), models.stage("stg_sales_order_line_item"))


@query
def schema_drift(landing: Landing) -> DataFrame:
    """The orders file against an older description of it."""
    expected = StructType.fromDDL(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(18,2), "
        "o_orderdate timestamp_ntz, o_clerk string"
    )
    return evolve.drift_report("orders", landing.source("orders"), expected)


@query
def layer_parity(landing: Landing) -> DataFrame:
    """Orders and lines in landing against the fact: every line must be there, orders without lines are not."""
    models = Models(landing)
    fact = _stored_fact(landing)
    lines = quality.parity(
        "line_items", models.stage("stg_sales_order_line_item"), fact.select("line_item_id"), "line_item_id"
    )
    orders = quality.parity(
        "orders", models.stage("stg_sales_order"), fact.groupBy("order_id").agg(F.count("*").alias("n")), "order_id"
    )
    return lines.unionByName(orders)


@query
def layer_row_parity(landing: Landing) -> DataFrame:
    """Whole rows of landing lines and headers against the fact, and orders against a copy with planted faults."""
    models = Models(landing)
    fact = _stored_fact(landing)
    line_columns = ["line_item_id", "order_id", "order_timestamp", "customer_id", "product_id", "quantity", "unit_price", "line_total"]
    lines = models.stage("stg_sales_order_line_item").withColumnRenamed("sku", "product_id")
    head_columns = ["order_id", "order_total", "line_item_count"]
    orders = landing.source("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", c.money(F.col("o_totalprice")).alias("total"))
    # Urgent orders are lost, orders of low priority doubled, pending ones of others changed.
    kept = orders.filter("o_orderpriority <> '1-URGENT'")
    changed = (F.col("o_orderstatus") == "P") & ~F.col("o_orderpriority").isin("1-URGENT", "5-LOW")
    faulty = kept.withColumn("total", F.when(changed, (F.col("total") + 1).cast(c.MONEY)).otherwise(F.col("total")))
    faulty = faulty.unionByName(orders.filter("o_orderpriority = '5-LOW'"))
    checks = [
        quality.row_parity("line_items", lines, fact, "line_item_id", line_columns),
        quality.row_parity("headers", models.stage("stg_sales_order"), fact.select(head_columns).distinct(), "order_id", head_columns),
        quality.row_parity("faulty_copy", orders, faulty, "o_orderkey"),
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


# ---- catalog ------------------------------------------------------------------------------
def _built(landing: Landing) -> Warehouse:
    location = shared_dir(landing.spark, "warehouse")
    prefix = "ow_" + location.rsplit("-", 1)[-1][:12] + "_"
    return Warehouse(landing.spark, location, prefix).create().land(landing.tables()).build()


@query
def layer_row_counts(landing: Landing) -> DataFrame:
    """All layers built from landing to gold, then counted."""
    warehouse = _built(landing)
    counted = {
        f"{layer}.{name}": warehouse.table(layer, name)
        for layer, name in [
            ("landing", "sales_order"),
            ("landing", "sales_order_line_item"),
            ("landing", "customer_sales"),
            ("bronze", "stg_sales_order"),
            ("bronze", "stg_sales_order_line_item"),
            ("bronze", "stg_customer_sales"),
            ("silver", "fact_sales_order"),
            ("gold", "gold_customer_sales_summary"),
        ]
    }
    return row_counts(counted)


@query
def catalog_inventory(landing: Landing) -> DataFrame:
    """Relations of every layer with their kind and size."""
    return _built(landing).relations()


@query
def catalog_columns(landing: Landing) -> DataFrame:
    """Columns of the landing tables with type and number of values."""
    frames = [column_inventory("landing", name, df) for name, df in landing.tables().items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


# ---- metrics and monitoring ------------------------------------------------------------------
@query
def metric_gross_revenue(landing: Landing) -> DataFrame:
    """Revenue of completed orders per month of completion."""
    orders = landing.source("orders")
    model = orders.select(
        c.money(F.col("o_totalprice")).alias("order_total"),
        F.col("o_orderdate").alias("order_completed_ts"),
        F.when(F.col("o_orderstatus") == "F", "COMPLETED").otherwise("OPEN").alias("order_status"),
    )
    return metrics.GROSS_REVENUE.compute(model)


def _delays(landing: Landing, *keep: str) -> DataFrame:
    """Seconds from order to shipment of every line."""
    line, orders = landing.source("lineitem"), landing.source("orders")
    seconds = F.greatest((c.epoch_ms(F.col("l_shipdate")) - c.epoch_ms(F.col("o_orderdate"))) / 1000, F.lit(0))
    return line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        "l_linestatus", *keep, seconds.cast("bigint").alias("delay_seconds")
    )


@query
def freshness_p95(landing: Landing) -> DataFrame:
    """95th percentile of the delay from order to shipment, per line status; lines shipped early count as no delay."""
    delays = _delays(landing)
    return monitor.delay_quantile(delays, ["l_linestatus"], "delay_seconds", 0.95).select(
        "l_linestatus", F.col("delay_quantile").alias("p95_seconds"), "events"
    )


@query
def freshness_p95_sketched(landing: Landing) -> DataFrame:
    """The same quantile from stored hourly sketches merged over all hours, held against the exact ranks."""
    delays = _delays(landing, "o_orderdate")
    sketches = stored(monitor.delay_sketches(delays, ["l_linestatus"], "o_orderdate", "delay_seconds"), "delay-sketches")
    found = stored(monitor.sketched_quantile(sketches, ["l_linestatus"], 0.95), "delay-quantiles")
    exact = monitor.rank_error(delays, ["l_linestatus"], "delay_seconds", found, 0.95)
    return exact.select("l_linestatus", "events", (F.col("rank_error") <= 0.01).alias("within_one_percent"))


@query
def freshness_age(landing: Landing) -> DataFrame:
    """Age of the newest order, line and event at a fixed time."""
    return monitor.freshness(
        {
            "sales_order": (landing.source("orders"), "o_orderdate"),
            "sales_order_line_item": (landing.source("lineitem"), "l_shipdate"),
            "events": (landing.source("events"), "ts"),
        },
        F.expr(BATCH_TIME),
    )


@query
def alert_max_over_time(landing: Landing) -> DataFrame:
    """Samples at which the highest value of the last ten minutes is above the threshold."""
    samples = landing.source("events").select("event_id", "event_type", "ts", c.money(F.col("value")).alias("value"))
    return monitor.max_over_time(samples, ["event_type"], "ts", "value", 600).filter("max_value > 50")


@query
def alert_increase(landing: Landing) -> DataFrame:
    """Samples at which the counter read from `props` grew in the last five minutes."""
    samples = landing.source("events").select(
        "event_id", "event_type", "ts", F.get_json_object("props", "$.k").cast("bigint").alias("counter")
    )
    return monitor.increase(samples, ["event_type"], "ts", "counter", 300, "event_id").filter("increase > 0")


def _probes(landing: Landing) -> DataFrame:
    return landing.source("events").select(
        "event_id",
        c.prefixed("instance-", F.col("user_id")).alias("instance"),
        "ts",
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("success"),
        c.money(F.col("value")).alias("duration"),
    )


@query
def probe_health(landing: Landing) -> DataFrame:
    return monitor.probe_health(_probes(landing), ["instance"], "ts", "success", "event_id")


@query
def probe_duration(landing: Landing) -> DataFrame:
    return monitor.probe_duration(_probes(landing), ["instance"], "ts", "duration", every="day")
