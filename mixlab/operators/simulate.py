"""Simulated spend, external factors and transactions over the calendar of the sales."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlab.functions.calendar import PROMO_DAYS, UK_HOLIDAYS, on_dates
from mixlab.functions.noise import normal, pick, uniform
from mixlab.operators.features import series_index

# Quarterly growth of the simulated economy.
QUARTERLY_GROWTH = (2.1, 2.3, 2.0, 1.9, 2.2, 2.4, 2.5, 2.3)


def _wave(value: Column, period: int) -> Column:
    return F.sin(F.lit(2 * math.pi) * value / F.lit(float(period)))


def channel_list(channels: Sequence[str]) -> Column:
    """The configured channels with their positions, as one literal array."""
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("channel")) for i, c in enumerate(channels)])


def simulate_spend(
    dates: DataFrame, channels: Sequence[str], noise: float = 0.1, seed: int = 42, id_cols: Sequence[str] = ()
) -> DataFrame:
    """(ids, date, channel, spend) with season, weekday, trend and +-``noise``.

    ``dates`` holds each date of a series once. The row number runs over that calendar, and
    each date is then expanded into its channels inside the task. Series draw their own noise.
    """
    rows = series_index(dates.select(*id_cols, "date"), id_cols).select(
        *id_cols, "date", "series_index", F.inline(channel_list(channels))
    )
    # Level, season, weekday and trend of the simulated series.
    i = F.col("i")
    base = F.lit(1000.0) * (i + 1)
    season = F.lit(0.3) * _wave(F.month("date") - i, 12) + 1
    weekday = F.lit(0.2) * _wave(F.weekday("date"), 7) + 1
    trend = F.lit(1.0) + F.lit(0.001) * (i % 3) * F.col("series_index")
    spend = base * season * weekday * trend
    if noise:
        draw = uniform(F.concat_ws("|", *id_cols, "date", "channel"), seed, "spend")
        spend = spend * (F.lit(1.0 - noise) + F.lit(2.0 * noise) * draw)
    return rows.select(*id_cols, "date", "channel", F.round(spend, 2).alias("spend"))


def simulate_external(dates: DataFrame, noise: float = 1.0, seed: int = 42) -> DataFrame:
    """Confidence, growth, unemployment and the dated flags per date; ``noise`` 0 removes the noise."""
    return dates.select("date", *external_columns(noise, seed))


def external_columns(noise: float = 1.0, seed: int = 42) -> list[Column]:
    """The simulated factors as expressions of ``date``, for frames that have the dates already."""

    def draw(scale: float, tag: str) -> Column:
        return F.lit(scale * noise) * normal(F.col("date"), seed, tag) if noise else F.lit(0.0)

    # Levels and swings of the simulated factors.
    season = _wave(F.dayofyear("date"), 365)
    growth = F.array(*[F.lit(g) for g in QUARTERLY_GROWTH])
    quarter = F.floor(F.month("date") / 3).cast("int") % len(QUARTERLY_GROWTH)
    return [
        (F.lit(100.0) + F.lit(5.0) * season + draw(1.0, "confidence")).alias("consumer_confidence"),
        (F.element_at(growth, quarter + 1) + draw(0.1, "growth")).alias("gdp_growth"),
        (F.lit(5.0) + F.lit(0.3) * season + draw(0.05, "unemployment")).alias("unemployment"),
        on_dates(F.col("date"), UK_HOLIDAYS).alias("is_holiday"),
        on_dates(F.col("date"), PROMO_DAYS).alias("is_promo_event"),
    ]


DEMO_CODES = ("cup", "lamp", "chair", "shelf")
DEMO_COUNTRIES = ("Norway", "Chile", "Kenya")


def demo_transactions(dates: DataFrame, per_day: int = 1, seed: int = 42) -> DataFrame:
    """Random invoice lines, ``per_day`` of them on each date, drawn from the line's own key."""
    lines = dates.select("date", F.explode(F.sequence(F.lit(0), F.lit(per_day - 1))).alias("n"))
    key = F.concat_ws("|", "date", "n")

    def whole(lo: int, hi: int, tag: str) -> Column:
        return (F.lit(lo) + F.floor(uniform(key, seed, tag) * (hi - lo))).cast("int")

    number = F.concat(F.date_format("date", "yyyyMMdd"), F.lit("-"), F.col("n").cast("string"))
    drawn = lines.select(
        F.col("date").alias("InvoiceDate"),
        F.concat(F.lit("demo-"), number).alias("InvoiceNo"),
        pick(key, seed, "stock", DEMO_CODES).alias("StockCode"),
        F.concat(F.lit("Item "), number).alias("Description"),
        whole(1, 10, "quantity").alias("Quantity"),
        (F.lit(10.0) + F.lit(90.0) * uniform(key, seed, "price")).alias("UnitPrice"),
        whole(10000, 99999, "customer").cast("long").alias("CustomerID"),
        pick(key, seed, "country", DEMO_COUNTRIES).alias("Country"),
    )
    return drawn.withColumn("TotalPrice", F.col("Quantity") * F.col("UnitPrice"))
