"""Typed loaders for the CSV inputs, with the configured filters.

``scan=scan_csv_folder`` reads folders whose files have different headers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlab.config import MixConfig
from mixlab.operators.prep import date_range, exclude_returns, line_amount, parse_date
from mixlab.sources.files import EXTERNAL, MARKETING, SALES, TRANSACTIONS, external_or_empty, scan_csv

Scan = Callable[[SparkSession, str, str | None], DataFrame]


def load_sales(
    spark: SparkSession, path: str, config: MixConfig = MixConfig(), schema: str | None = SALES, scan: Scan = scan_csv
) -> DataFrame:
    """Daily sales (date, revenue, ...) inside the configured range."""
    return date_range(parse_date(scan(spark, path, schema), "date"), config.start_date, config.end_date)


def load_marketing(
    spark: SparkSession, path: str, config: MixConfig = MixConfig(), schema: str | None = MARKETING, scan: Scan = scan_csv
) -> DataFrame:
    """Long spend (date, channel, spend) inside the configured range."""
    return load_sales(spark, path, config, schema, scan)


def load_external(spark: SparkSession, path: str, schema: str = EXTERNAL) -> DataFrame:
    """External factors per date; empty when the file is missing."""
    return parse_date(external_or_empty(spark, path, schema), "date")


def load_retail(
    spark: SparkSession, path: str, config: MixConfig = MixConfig(), schema: str | None = TRANSACTIONS, scan: Scan = scan_csv
) -> DataFrame:
    """Invoice lines with their amount and day; ``InvoiceTs`` keeps the time of day.

    Returns leave when the configuration says so; the range applies to the day,
    so its last day counts in full.
    """
    raw = scan(spark, path, schema).withColumn("InvoiceTs", F.col("InvoiceDate"))
    dated = date_range(parse_date(raw, "InvoiceDate"), config.start_date, config.end_date, "InvoiceDate")
    return line_amount(exclude_returns(dated, config.include_returns))
