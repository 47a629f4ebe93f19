"""Hot keys: one part, customer and country that hold a third of all rows or more."""

import re

import pytest
from pyspark.sql import functions as F

from mixlab.operators import profile as pf
from mixlab.plans import catalog as ca

TABLES = ("lineitem", "orders", "part", "customer", "nation")


@pytest.fixture(scope="module")
def hot(spark, folder, tmp_path_factory):
    """The smallest tables with half of the lines on one part and half of the orders on one customer."""
    out = str(tmp_path_factory.mktemp("hot"))
    changed = {
        "lineitem": ("l_partkey", F.when(F.xxhash64("l_orderkey", "l_linenumber", "l_suppkey") % 2 == 0, 7)),
        "orders": ("o_custkey", F.when(F.xxhash64("o_orderkey") % 2 == 0, 5)),
    }
    for name in TABLES:
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        if name in changed:
            col, value = changed[name]
            df = df.withColumn(col, value.otherwise(F.col(col)).cast("long"))
        df.repartition(4).write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.fixture()
def shuffled_joins(spark):
    """No broadcast, and a skew threshold that fits the small tables."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_hot_part_is_split_over_tasks(spark, hot, shuffled_joins):
    df = ca.sales(spark, hot)
    rows = df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin\(skew=true\)", final)
    want = (
        spark.read.parquet(f"{hot}/lineitem.parquet").count()
    )
    assert sum(r["transactions"] for r in rows) == want


def test_distinct_counts_spread_a_hot_group(spark, hot):
    """The first shuffle of a distinct count carries the counted value in its key."""
    df = ca.QUERIES["customer_frequency"](spark, hot)
    plan = df._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert any("CustomerID" in k and "InvoiceNo" in k for k in keys)
    top = df.orderBy(F.desc("num_transactions")).first()
    orders = spark.read.parquet(f"{hot}/orders.parquet").filter("o_custkey = 5")
    lines = spark.read.parquet(f"{hot}/lineitem.parquet")
    expected = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey").distinct().count()
    assert (top["CustomerID"], top["num_transactions"]) == (5, expected)


def test_quantiles_of_a_hot_channel(spark, hot):
    lines = ca.lines(spark, hot, "channel", "TotalAmount")
    spread = {r["channel"]: list(r)[1:] for r in pf.quartiles(lines, "TotalAmount", ["channel"]).collect()}
    held = {r["channel"]: list(r)[1:] for r in pf.quartiles(lines, "TotalAmount", ["channel"], bounded=True).collect()}
    assert spread.keys() == held.keys()
    for c, values in held.items():
        assert spread[c] == pytest.approx(values)


def test_facts_are_joined_without_a_hint(spark, hot):
    """With broadcasts switched off the same quantiles come out of shuffled joins."""
    lines = ca.lines(spark, hot, "channel", "TotalAmount")
    held = {r["channel"]: list(r)[1:] for r in pf.quartiles(lines, "TotalAmount", ["channel"], bounded=True).collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pf.quartiles(lines, "TotalAmount", ["channel"])
        spread = {r["channel"]: list(r)[1:] for r in found.collect()}
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for c, values in held.items():
        assert spread[c] == pytest.approx(values)


def test_series_windows_hold_one_row_per_day(spark, hot):
    """However hot a country, its window partition is no longer than the calendar."""
    longest = ca.country_sales(spark, hot).groupBy("Country").count().agg(F.max("count")).first()[0]
    assert longest <= ca.calendar(spark, hot).count()
