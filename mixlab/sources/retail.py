"""Retail transactions, spend and hourly views over the provided tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlab.sources.layout import bucketed

# Product types of the part table, which stand in for media channels.
RETAIL_CHANNELS = ("economy", "large", "medium", "promo", "small", "standard")
EVENT_CHANNELS = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _from_lineitem() -> dict:
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    return {
        "StockCode": F.col("l_partkey"),
        "Quantity": (sign * F.col("l_quantity")).cast("int"),
        "spend": F.col("l_extendedprice").cast("decimal(12,2)")
        * F.col("l_discount").cast("decimal(4,2)"),
    }


def _from_orders() -> dict:
    return {
        "InvoiceNo": F.col("o_orderkey").cast("string"),
        "InvoiceDate": F.col("o_orderdate").cast("date"),
        "CustomerID": F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey")),
    }


def _from_part() -> dict:
    return {
        "Description": F.col("p_name"),
        "UnitPrice": F.col("p_retailprice").cast("decimal(10,2)"),
        "channel": F.lower("p_type"),
    }


RETAIL_COLUMNS = (
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
    "UnitPrice", "CustomerID", "Country", "channel", "spend",
)


def _on_days(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Orders from the start to the end day, as a comparison of the stored timestamp, so
    that the scan can skip row groups (a cast of the column would hide it)."""
    kind = dict(orders.dtypes)["o_orderdate"]
    first, after = F.lit(start).cast("date"), F.date_add(F.lit(end).cast("date"), 1)
    stored = F.col("o_orderdate")
    return orders.filter((stored >= first.cast(kind)) & (stored < after.cast(kind)))


def retail_view(
    spark: SparkSession,
    folder: str,
    columns: Iterable[str] = RETAIL_COLUMNS,
    between: tuple[str, str] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Invoice lines with the requested columns, ``between`` two days if given.

    ``tables`` gives frames to read in place of the folder's tables of those names, such as
    lines and orders bucketed by their order key (``order_layout``), which then meet where they are.

    Only the dimension tables those columns come from are joined (every line has
    one order, part, customer and nation), since Spark cannot drop an inner join
    by itself. Orders meet their customers before the lines, so the largest
    table is shuffled once per key. No side is broadcast by hint: table sizes
    grow with the data and adaptive execution decides from measured sizes,
    splitting hot part keys.
    """
    wanted = list(columns)
    unknown = set(wanted) - set(RETAIL_COLUMNS)
    if unknown:
        raise ValueError(f"unknown retail columns: {sorted(unknown)}")
    given = tables or {}

    def opened(name: str) -> DataFrame:
        return given[name] if name in given else table(spark, folder, name)

    line, order, part = _from_lineitem(), _from_orders(), _from_part()
    available = {**line, **order, **part, "Country": F.col("n_name")}

    lines = opened("lineitem")
    if between or "Country" in wanted or any(c in order for c in wanted):
        orders = opened("orders")
        if between:
            orders = _on_days(orders, *between)
        if "Country" in wanted:
            places = opened("customer").join(
                opened("nation"), F.col("c_nationkey") == F.col("n_nationkey")
            ).select("c_custkey", "n_name")
            orders = orders.join(places, F.col("o_custkey") == F.col("c_custkey"))
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if any(c in part for c in wanted):
        lines = lines.join(
            opened("part"), F.col("l_partkey") == F.col("p_partkey")
        )
    return lines.select(*[available[c].alias(c) for c in wanted])


def order_layout(spark: SparkSession, folder: str, buckets: int) -> dict[str, DataFrame]:
    """The lines and the orders, bucketed by their order key once for all later reports."""
    return {
        "lineitem": bucketed(table(spark, folder, "lineitem"), "l_orderkey", buckets, "lines"),
        "orders": bucketed(table(spark, folder, "orders"), "o_orderkey", buckets, "orders"),
    }


def spend_view(spark: SparkSession, folder: str, kind: str = "retail") -> DataFrame:
    """Long spend (date, channel, spend): sparse from the retail lines, dense from events."""
    if kind == "events":
        source = table(spark, folder, "events").select(
            F.col("ts").cast("date").alias("date"),
            F.col("event_type").alias("channel"),
            F.col("value").cast("decimal(12,2)").alias("spend"),
        )
    else:
        source = retail_view(spark, folder, ["InvoiceDate", "channel", "spend"])
        source = source.withColumnRenamed("InvoiceDate", "date")
    return source.groupBy("date", "channel").agg(F.sum("spend").cast("double").alias("spend"))


def hourly_view(spark: SparkSession, folder: str) -> DataFrame:
    """Events as transactions with a time of day: InvoiceNo, InvoiceTs, TotalAmount."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("InvoiceNo"),
        F.col("ts").alias("InvoiceTs"),
        F.col("value").cast("decimal(12,2)").alias("TotalAmount"),
    )
