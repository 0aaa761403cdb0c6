"""A fact that is written: the same rows by other joins and in parts, and no shuffle files left behind."""

import random
import time
from functools import reduce

import pytest
from conftest import rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.operators import quality
from orderweir.plans import models, registry
from orderweir.plans.models import Models
from orderweir.plans.registry import QUERIES
from orderweir.session import DROP_SHUFFLES, stored


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def odd(landing):
    """Landing tables in which lines name other customers than their headers, and ids repeat or are missing."""
    draw = random.Random(5)
    swap = lambda name, share, value: F.when(F.rand(draw.randrange(99)) < share, value).otherwise(F.col(name))
    tables = {name: stored(df, "odd") for name, df in landing.tables().items()}
    lines, heads, people = (tables[name] for name in ("sales_order_line_item", "sales_order", "mdm_customer360"))
    some = F.concat(F.lit("CUST-"), (F.rand(3) * 200).cast("int").cast("string"))
    lines = lines.withColumns({"customerid": swap("customerid", 0.2, some), "currency": swap("currency", 0.3, F.lit(None))})
    lines = lines.withColumns({"customerid": swap("customerid", 0.1, F.lit(None)), "orderid": swap("orderid", 0.1, F.lit(None))})
    heads = heads.where("hash(orderid) % 7 <> 0").withColumn("customerid", swap("customerid", 0.1, F.lit(None)))
    tables["sales_order_line_item"] = stored(lines, "odd")
    tables["sales_order"] = stored(heads.unionByName(heads.where("hash(orderid) % 5 = 0").withColumn("customerid", some)), "odd")
    again = people.where("hash(customer_id) % 3 = 0").withColumn("customer_name", F.lit("again"))
    tables["mdm_customer360"] = stored(people.unionByName(again).unionByName(again.limit(4).withColumn("customer_id", F.lit(None))), "odd")
    return tables


@pytest.mark.parametrize("lines_per_part", [10**9, 2_000])
def test_a_fact_to_be_written_has_the_same_rows(spark, odd, monkeypatch, lines_per_part):
    monkeypatch.setattr(models, "LINES_PER_PART", lines_per_part)
    parts = Models(odd).fact_parts(odd["sales_order_line_item"].count())
    assert len(parts) == (1 if lines_per_part == 10**9 else 4)
    fact = Models(odd).fact_sales_order
    assert rows(reduce(DataFrame.unionByName, parts).select(fact.columns)) == rows(fact)
    assert sum(part.select("order_id").distinct().count() for part in parts) == fact.select("order_id").distinct().count()


def test_lines_come_from_landing_by_product_as_they_do_by_order(landing):
    by_order, by_product = landing.line_arrivals(), landing.line_arrivals(by_product=True)
    assert rows(by_product.select(by_order.columns)) == rows(by_order)


def test_branches_of_the_fact_share_their_shuffles(spark, odd):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        fact = Models(odd).fact_parts(1)[0]
        fact.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = plan(fact).split("Initial Plan")[0]
    shared = [line for line in final.splitlines() if "ReusedExchange" in line]
    assert any("hashpartitioning(order_id" in line for line in shared) and any("hashpartitioning(h_order" in line for line in shared)


def test_shuffle_files_go_with_the_write(spark):
    files = lambda: {
        f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
            spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        ) if f.getName().startswith("shuffle_")
    }
    setting, before = spark.conf.get(DROP_SHUFFLES, None), files()
    kept = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "count"), "shuffled")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert kept.count() == 7 and spark.conf.get(DROP_SHUFFLES, None) == setting


@pytest.mark.parametrize("name", ["gold_summary", "layer_row_counts"])
def test_a_fact_in_parts_changes_no_result(spark, folder, monkeypatch, name):
    whole = rows(QUERIES[name](spark, folder))
    for module in (models, registry):
        monkeypatch.setattr(module, "LINES_PER_PART", 2_500)
    written = []
    monkeypatch.setattr(Models, "fact_parts", lambda self, lines, of=Models.fact_parts: written.extend(of(self, lines)) or written)
    assert rows(QUERIES[name](spark, folder)) == whole
    assert len(written) == 3


def test_equal_copies_are_read_once(spark):
    left = spark.range(1_000).withColumn("v", F.col("id") % 5)
    found = quality.row_differences(left, left.repartition(5), "id", buckets=16)
    assert "Range" not in plan(found) and found.columns == ["id", "v", "surplus"] and found.count() == 0
