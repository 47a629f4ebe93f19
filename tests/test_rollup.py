"""Distinct counts that roll up, counts at several grains, spend back from wide."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from mixlab.operators import panel as pa
from mixlab.operators import profile as pf
from mixlab.operators import rollup as ru
from mixlab.plans import catalog

MEASURES = {"revenue": "TotalAmount"}
COUNTED = {"transactions": "InvoiceNo", "unique_customers": "CustomerID"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bills(spark):
    """90,000 lines, a third of them on one day and in one country; invoices over several days, null ids and countries."""
    n = F.col("id")
    return spark.range(90_000).select(
        F.when(n % 3 == 0, F.lit(dt.date(2011, 1, 1))).otherwise(F.date_add(F.lit(dt.date(2011, 1, 1)), (n % 40).cast("int"))).alias("InvoiceDate"),
        F.when(n % 3 == 0, "UK").when(n % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), (n % 5).cast("string"))).alias("Country"),
        F.when(n % 11 != 0, F.concat(F.lit("i"), (F.pmod(F.xxhash64(n), F.lit(70_000))).cast("string"))).alias("InvoiceNo"),
        F.when(n % 4 != 0, F.pmod(F.hash(n), F.lit(500)).cast("long")).alias("CustomerID"),
        (n % 100).cast("decimal(10,2)").alias("TotalAmount"),
    )


def _plain(df, key):
    named = df.withColumn("key", F.expr(key)).filter("key is not null")
    return named.groupBy("key").agg(
        F.sum("TotalAmount").cast("double").alias("revenue"),
        F.count_distinct("InvoiceNo").alias("transactions"),
        F.count_distinct("CustomerID").alias("unique_customers"),
    )


KEYS = ["string(InvoiceDate)", "date_format(InvoiceDate, 'yyyy-MM')", "string(weekday(InvoiceDate))", "Country"]


def test_cube_equals_distinct_counts(bills):
    cube = ru.cube(bills, ["InvoiceDate", "Country"], MEASURES, COUNTED)
    for key in KEYS:
        got = {tuple(r) for r in cube.by(key=F.expr(key)).collect()}
        assert got == {tuple(r) for r in _plain(bills, key).collect()}, key
    both = cube.by(month=F.expr(KEYS[1]), country="Country").count()
    assert both == bills.filter("Country is not null").select(F.expr(KEYS[1]), "Country").distinct().count()
    whole = cube.by().first()
    want = bills.agg(F.sum("TotalAmount").cast("double"), F.count_distinct("InvoiceNo"), F.count_distinct("CustomerID")).first()
    assert tuple(whole) == tuple(want)


def test_numbers_have_more_than_one_bucket_and_no_gaps(bills):
    codes = ru.numbered(bills, "InvoiceNo", "InvoiceDate")
    n, least, most, different = codes.agg(F.count("*"), F.min("_code"), F.max("_code"), F.count_distinct("_code")).first()
    assert (least, most, different) == (0, n - 1, n) and n > 32_768


def test_sketches_are_close(bills):
    cube = ru.cube(bills, ["InvoiceDate", "Country"], MEASURES, COUNTED, exact=False)
    got = {r["key"]: r for r in cube.by(key=F.col("Country")).collect()}
    for r in _plain(bills, "Country").collect():
        assert got[r["key"]]["revenue"] == r["revenue"]
        assert got[r["key"]]["transactions"] == pytest.approx(r["transactions"], rel=0.06)
        assert got[r["key"]]["unique_customers"] == pytest.approx(r["unique_customers"], rel=0.06)


def test_cube_of_nothing_and_of_null_ids(spark, bills):
    for exact in (True, False):
        empty = ru.cube(bills.limit(0), ["InvoiceDate", "Country"], MEASURES, COUNTED, exact=exact)
        assert empty.by(key=F.col("Country")).count() == 0
        none = bills.filter("Country = 'UK'").withColumn("InvoiceNo", F.lit(None).cast("string"))
        row = ru.cube(none, ["InvoiceDate", "Country"], MEASURES, COUNTED, exact=exact).by(key=F.col("Country")).first()
        assert (row["key"], row["transactions"]) == ("UK", 0)
    with pytest.raises(ValueError, match="dimensions"):
        ru.cube(bills, ["Country"], MEASURES, COUNTED)


def test_one_scan_and_no_expand(spark, folder):
    rows = catalog.lines(spark, folder, "Country", *catalog.SALES_COLUMNS)
    reduced = _plan(ru.visits(rows, ["InvoiceDate", "Country"], ["InvoiceNo", "CustomerID"], MEASURES))
    assert "Expand" not in reduced and len(re.findall(r"FileScan parquet \[l_orderkey", reduced.split("Initial Plan")[0])) == 1
    reports = _plan(catalog.QUERIES["sales_rollup"](spark, folder))
    assert "Expand" not in reports and "l_orderkey" not in reports


def test_counts_at_grains(spark, folder):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (None, None)], "d INT, c STRING")
    assert tuple(pf.grain_counts(df, {"days": ["d"], "pairs": ["d", "c"]}).first()) == (5, 3, 4)
    assert tuple(pf.grain_counts(df.limit(0), {"days": ["d"], "pairs": ["d", "c"]}).first()) == (0, 0, 0)
    assert tuple(pf.grain_counts(df, {}).first()) == (5,)
    with pytest.raises(ValueError, match="grain"):
        pf.grain_counts(df, {"days": ["d"], "kinds": ["c"]})
    plan = _plan(catalog.QUERIES["row_counts"](spark, folder))
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1 and "Expand" not in plan


def test_spend_back_from_wide(spark):
    long = spark.createDataFrame(
        [(dt.date(2011, 1, 1), "tv", 1.0), (dt.date(2011, 1, 1), "tv", 2.0), (dt.date(2011, 1, 2), "web", 0.0)],
        "date DATE, channel STRING, spend DOUBLE",
    )
    back = pa.long_spend(pa.pivot_spend(long, ["tv", "web"]), ["tv", "web"])
    assert {tuple(r) for r in back.collect()} == {(dt.date(2011, 1, 1), "tv", 3.0), (dt.date(2011, 1, 2), "web", 0.0)}


def test_scenarios_read_the_lines_once(spark, folder):
    assert "l_orderkey" not in _plan(catalog.QUERIES["compare_scenarios"](spark, folder))
