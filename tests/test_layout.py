"""Tables bucketed by a join key."""

import pytest
from pyspark.sql import functions as F

from mixlab.plans import catalog
from mixlab.sources.layout import bucketed, reopened
from mixlab.sources.retail import order_layout, retail_view


@pytest.fixture
def shuffled_joins(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_orders_without_an_exchange(spark, folder, shuffled_joins):
    tables = order_layout(spark, folder, 4)
    plan = _plan(retail_view(spark, folder, ["InvoiceDate", "Quantity"], tables=tables))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    panel = _plan(catalog.panel_base(spark, folder, tables))
    assert "hashpartitioning(l_orderkey" not in panel and "hashpartitioning(o_orderkey" not in panel
    assert "hashpartitioning(l_orderkey" in _plan(catalog.panel_base(spark, folder))


def test_rows_stay_the_same(spark, folder):
    columns = ["InvoiceNo", "Quantity", "CustomerID", "Country", "InvoiceDate"]
    laid = retail_view(spark, folder, columns, tables=order_layout(spark, folder, 3))
    plain = retail_view(spark, folder, columns)
    assert laid.exceptAll(plain).count() == 0 and plain.exceptAll(laid).count() == 0


def test_a_kept_layout_is_opened_again(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"), F.when(F.col("id") % 2 == 0, "x").alias("note"))
    df = df.unionByName(df.limit(3).withColumn("k", F.lit(None).cast("long")))
    path = str(tmp_path / "kept")
    first = bucketed(df, "k", 4, path=path)
    again = reopened(df, path, "k", 4)
    assert first.exceptAll(df).count() == 0 and again.exceptAll(df).count() == 0 and again.count() == 1003
    assert "Exchange" not in _plan(again.groupBy("k").agg(F.sum("v")))
