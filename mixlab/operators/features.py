"""Lag, rolling, index and calendar features.

The window operators take one row per id and date, so a partition of theirs is
one series and never longer than the calendar, however many invoice lines stand
behind a day: hot ids are flattened by the daily aggregation before them, which
combines on the map side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mixlab.config import DEFAULT_LAGS, DEFAULT_WINDOWS
from mixlab.functions.calendar import (
    FIXED_HOLIDAYS,
    PROMO_DAYS,
    SHORT_PI,
    UK_HOLIDAYS,
    calendar_columns,
    flag,
    on_dates,
)
from mixlab.operators.blocks import positions


def lag_features(
    df: DataFrame,
    cols: Sequence[str],
    periods: Sequence[int] = DEFAULT_LAGS,
    id_cols: Sequence[str] = (),
    date_col: str = "date",
) -> DataFrame:
    """``{col}_lag_{n}``: the value ``n`` rows earlier in the series."""
    w = W.partitionBy(*id_cols).orderBy(date_col)
    return df.withColumns({f"{c}_lag_{n}": F.lag(c, n).over(w) for c in cols for n in periods})


def rolling_features(
    df: DataFrame,
    cols: Sequence[str],
    windows: Sequence[int] = DEFAULT_WINDOWS,
    id_cols: Sequence[str] = (),
    frame: str = "w+1",
    date_col: str = "date",
) -> DataFrame:
    """``{col}_avg|sum|max_{w}d`` over the last rows of the series.

    ``frame`` "w+1": the row and the w before it; "w": w rows with the row
    itself; "days": the last w calendar days.
    """
    out = {}
    for size in windows:
        if frame == "days":
            w = W.partitionBy(*id_cols).orderBy(F.unix_date(date_col)).rangeBetween(-(size - 1), 0)
        else:
            back = size if frame == "w+1" else size - 1
            w = W.partitionBy(*id_cols).orderBy(date_col).rowsBetween(-back, 0)
        for c in cols:
            out[f"{c}_avg_{size}d"] = F.avg(c).over(w)
            out[f"{c}_sum_{size}d"] = F.sum(c).over(w)
            out[f"{c}_max_{size}d"] = F.max(c).over(w)
    return df.withColumns(out)


def series_index(df: DataFrame, id_cols: Sequence[str] = (), date_col: str = "date") -> DataFrame:
    """0-based position of the row in its series, by counted offsets: no task sorts a whole series."""
    return positions(df, "_at", id_cols, [date_col]).withColumn("series_index", F.col("_at").cast("int")).drop("_at")


def seasonality(df: DataFrame, pi: str = "short", date_col: str = "date") -> DataFrame:
    """Calendar parts, weekend flag and cyclic pairs."""
    value = SHORT_PI if pi == "short" else math.pi
    return df.withColumns(calendar_columns(F.col(date_col), value))


def panel_calendar(df: DataFrame, date_col: str = "date") -> DataFrame:
    """The model's own calendar set: weekday, month, weekend flag and cyclic pairs."""
    return df.withColumns(calendar_columns(F.col(date_col), full=False))


def holidays(df: DataFrame, country: str = "FR", date_col: str = "date") -> DataFrame:
    """One flag per fixed-date holiday of the country, and ``is_holiday`` for any of them."""
    month, day = F.month(date_col), F.dayofmonth(date_col)
    hits = {name: (month == m) & (day == d) for m, d, name in FIXED_HOLIDAYS[country]}
    anything = F.lit(False)
    for hit in hits.values():
        anything = anything | hit
    return df.withColumns({**{n: flag(h) for n, h in hits.items()}, "is_holiday": flag(anything)})


def flag_dates(df: DataFrame, dates: Sequence[str], name: str, date_col: str = "date") -> DataFrame:
    return df.withColumn(name, on_dates(F.col(date_col), tuple(dates)))


def holiday_calendar(df: DataFrame, dates: Sequence[str] = UK_HOLIDAYS) -> DataFrame:
    return flag_dates(df, dates, "is_holiday")


def promo_calendar(df: DataFrame, dates: Sequence[str] = PROMO_DAYS) -> DataFrame:
    return flag_dates(df, dates, "is_promo_event")
