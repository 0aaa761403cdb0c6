"""What the plans must and must not contain."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from orderweir.operators.upsert import KeyedTable, merged
from orderweir.plans.registry import QUERIES
from orderweir.plans.warehouse import Warehouse
from orderweir.session import shared_dir
from orderweir.sources.landing import Landing

LAZY = [
    "fact_sales_order", "line_item_rollup", "gold_summary_chart", "customer_sales_running", "customer_sales_latest",
    "latest_per_key", "proj_line_item", "cdc_current_state", "cdc_dedupe", "alert_max_over_time", "alert_increase",
    "freshness_p95", "layer_parity", "dq_rel_product", "recent_changes_topk",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def test_scan_reads_only_the_columns_it_needs(spark, folder):
    text = plan(QUERIES["freshness_p95"](spark, folder))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linestatus:string,l_shipdate:timestamp_ntz>" in text


def test_filters_reach_the_scan(spark, folder):
    assert "GreaterThanOrEqual(ts" in plan(QUERIES["recent_changes_topk"](spark, folder))
    assert "IsNotNull(o_orderkey)" in plan(QUERIES["freshness_p95"](spark, folder))


def test_latest_row_is_picked_before_the_shuffle(spark, folder):
    text = plan(QUERIES["latest_per_key"](spark, folder))
    assert "row_number(), 1, Partial" in text


def test_top_k_does_not_sort_everything(spark, folder):
    assert "TakeOrderedAndProject" in plan(QUERIES["recent_changes_topk"](spark, folder))


def test_merge_shuffles_each_side_once(spark):
    table = KeyedTable(spark, shared_dir(spark, "plan"), ["id"], buckets=4).create(spark.range(100))
    old = table._rows().drop("_of", "_bucket").repartition(4, "id")
    new = spark.range(50, 150).withColumn("_removed", F.lit(False)).repartition(4, "id")
    assert plan(merged(old, new, ["id"])).count("Exchange ") == 2


def test_bucketed_landing_joins_without_a_shuffle(spark, folder):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    landing = Landing(spark, folder)
    warehouse = Warehouse(spark, shared_dir(spark, "bucketed"), "bucketed_").create()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        tables = {"sales_order": landing.sales_order(), "sales_order_line_item": landing.sales_order_line_item()}
        warehouse.land(tables, buckets=4)
        orders, lines = warehouse.table("landing", "sales_order"), warehouse.table("landing", "sales_order_line_item")
        text = plan(lines.join(orders, "orderid", "left"))
        assert "Exchange" not in text and "SelectedBucketsCount: 4 out of 4" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        warehouse.drop()


def test_fact_moves_lines_four_times(spark, folder):
    """To parts, to orders with their headers, to products and to customers, without the broadcasts of small tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(QUERIES["fact_sales_order"](spark, folder))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # An exchange per line move and other side, one of the rows of days, those of headers: customers, counts, both.
    keys = [line.split("hashpartitioning(")[1].split("#")[0] for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    assert keys.count("order_id") == 0 and keys.count("h_order") == 1 and keys.count("orderid") == 2
    assert keys.count("l_partkey") == 1 and keys.count("sku") == 1 and keys.count("customer_id") == 1


@pytest.mark.parametrize(
    "master,checkpoint,warehouse,base",
    [
        ("spark://host:7077", "/shared/check", "file:/data/warehouse", "/shared/check/rows-"),
        ("spark://host:7077", None, "hdfs://host/warehouse", "hdfs://host/warehouse/_shared/rows-"),
        ("local[8]", None, "file:/data/warehouse", "file:/data/warehouse/_shared/rows-"),
        ("yarn", None, "file:/data/warehouse", None),
    ],
)
def test_a_cluster_needs_a_shared_folder(master, checkpoint, warehouse, base):
    settings = {"spark.master": master, "spark.checkpoint.dir": checkpoint, "spark.sql.warehouse.dir": warehouse}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name) or default))
    if base is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session, "rows")
    else:
        assert shared_dir(session, "rows").startswith(base)
