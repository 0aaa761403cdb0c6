"""One order, customer, part and user hold a third of their tables: same results, split work."""

import duckdb
import pytest

import check
from orderweir.operators import hotkeys
from orderweir.plans.models import Models
from orderweir.plans.registry import QUERIES
from orderweir.sources import order_events
from orderweir.sources.landing import Landing

SKEWED = {
    "orders": "select * replace (case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey) from {orders}",
    "events": "select * replace (case when event_id % 3 = 0 then 3 else user_id end as user_id) from {events}",
    # Rows are moved, not copied; the few that then collide on the line identity are dropped.
    "lineitem": """
        with moved as (
          select * exclude (n) replace (case when n % 3 = 0 then 11 else l_orderkey end as l_orderkey,
                                        case when n % 3 = 1 then 5 else l_partkey end as l_partkey)
          from (select *, row_number() over () as n from {lineitem}))
        select * from moved
        qualify row_number() over (partition by l_orderkey, l_linenumber, l_shipdate, l_partkey
                                   order by l_extendedprice) = 1""",
}


@pytest.fixture(scope="module")
def skewed(folder, tmp_path_factory):
    target = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    sources = {name: f"read_parquet('{folder}/{name}.parquet')" for name in check.TABLES}
    for name, source in sources.items():
        sql = SKEWED.get(name, f"select * from {source}").format(**sources)
        con.execute(f"copy ({sql}) to '{target}/{name}.parquet'")
    return str(target)


@pytest.mark.parametrize(
    "name",
    [
        "src_raw_orders", "proj_sales_order", "proj_line_item", "fact_sales_order", "gold_summary",
        "gold_summary_changelog", "customer_sales_running", "cdc_scd2", "merge_line_item", "latest_per_key",
        "dq_rel_product_violations", "alert_increase", "layer_parity",
    ],
)
def test_same_results_with_slices_and_parts(spark, skewed, monkeypatch, name):
    monkeypatch.setattr(hotkeys, "MAX_ROWS", 50)
    monkeypatch.setattr(order_events, "LINES_PER_MESSAGE", 20)
    good, note = check.compare(spark, check.connect(skewed), name, skewed)
    assert good, note


def test_hot_order_is_split_in_a_shuffled_join(spark, skewed):
    """Without broadcasts the lines of the hot order are joined by several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.files.maxPartitionBytes": "64k",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        landing = Landing(spark, skewed)
        lines = landing.source("lineitem").repartition(8)
        orders = landing.source("orders")
        joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        execution = joined._jdf.queryExecution()
        execution.toRdd().count()
        assert "skew=true" in execution.executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_models_survive_without_broadcasts(spark, skewed):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = Models(Landing(spark, skewed)).fact_sales_order.count()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert QUERIES["fact_sales_order"](spark, skewed).count() == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
